"""Classifiers, search, evaluation and the run summary (survey family I, J15-J17).

Spark ML replaces the reference's single-machine learners:

* I1 encoding, forest: ``StringIndexer(handleInvalid='keep')`` + ``OneHotEncoder``
  for categoricals, ``VectorAssembler`` + ``StandardScaler(withMean)`` for
  numerics; unknown categories map to the extra "keep" slot.
* I1 encoding, boosting: raw categories by ordered target statistics
  (``nextbuy.functions.target_stats``), two-valued ones as a 0/1 flag.
* I2 selection: ``ImportanceSelector``, a stage of the forest's pipeline.
* I3 balanced class weights n / (k * n_c) as a weight column (one grouped
  count, broadcast back: one row per class).
* I4 boosting: ``OneVsRest(GBTClassifier)``, arms side by side; arm margins ->
  sigmoid(2m), normalized per row.
* I5/I6 search: Parzen-sampled trials of both kinds (``plans.search``) on the
  folds of the skew-safe stratified assignment (E4), the whole pipeline fitted
  per fold (encoders and selection once a study), scored by the exact macro ROC-AUC of ``nextbuy.functions.ranking``;
  a plain grid with ``CrossValidator`` is kept beside it.
* I10 scoring: probabilities -> top classes in-row (``array_sort``), no shuffle.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import (OneHotEncoder, StandardScaler, StringIndexer,
                                VectorAssembler, VectorSlicer)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ranking as R
from ..functions import target_stats as TS
from ..operators import splits as S
from ..plans.datasets import small_list
from ..session import materialize, spread
from . import search as HS
from .selection import ImportanceSelector, slot_names

IDS = ["ncodpers", "q"]
SELECTION_SEED = 0


@dataclass
class FeatureSpec:
    numeric: list[str]
    categorical: list[str]


def label_index(classes: list[int], label: str = "purchase"):
    """0-based position of the label in the model's class list (NULL if unknown)."""
    pos = F.array_position(F.array(*[F.lit(int(c)) for c in classes]), F.col(label))
    return F.when(pos > 0, (pos - 1).cast("double"))


def class_weights(train: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight n / (k * n_c) per class (one row per class)."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    tot = Window.partitionBy()  # one row per class
    return counts.select(label, "n_c", (F.sum("n_c").over(tot) /
                                        (F.count(F.lit(1)).over(tot) * F.col("n_c"))).alias("weight"))


def with_weights(train: DataFrame, label: str = "label") -> DataFrame:
    w = class_weights(train, label)
    return train.join(F.broadcast(w.select(label, "weight")), label)


def encoder_stages(spec: FeatureSpec, scale: bool = True) -> list:
    """Index + one-hot categoricals, assemble + scale numerics, assemble all."""
    idx = [f"{c}__idx" for c in spec.categorical]
    ohe = [f"{c}__ohe" for c in spec.categorical]
    stages = []
    if spec.categorical:
        stages.append(StringIndexer(inputCols=spec.categorical, outputCols=idx,
                                    handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, handleInvalid="keep",
                                    dropLast=False))
    parts = list(ohe)
    if spec.numeric:
        stages.append(VectorAssembler(inputCols=spec.numeric, outputCol="_num",
                                      handleInvalid="keep"))
        if scale:
            stages.append(StandardScaler(inputCol="_num", outputCol="_num_s", withMean=True,
                                         withStd=True))
            parts.append("_num_s")
        else:
            parts.append("_num")
    stages.append(VectorAssembler(inputCols=parts, outputCol="features", handleInvalid="keep"))
    return stages


def forest(num_trees: int = 50, max_depth: int = 10, min_instances: int = 2,
           seed: int = 0, features: str = "features") -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol=features, labelCol="label", weightCol="weight",
                                  numTrees=num_trees, maxDepth=max_depth,
                                  minInstancesPerNode=min_instances, seed=seed)


def boosted(max_iter: int = 20, max_depth: int = 5, step: float = 0.1, seed: int = 0,
            min_instances: int = 1, parallelism: int = 4) -> OneVsRest:
    """I4: one-vs-rest gradient-boosted trees, ``parallelism`` classes at a time."""
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxIter=max_iter,
                        maxDepth=max_depth, stepSize=step, minInstancesPerNode=min_instances, seed=seed)
    return OneVsRest(classifier=gbt, featuresCol="features", labelCol="label",
                     predictionCol="prediction", rawPredictionCol="rawPrediction", parallelism=parallelism)


@dataclass
class BoostedModel:
    """I4's fitted pipeline: raw categories to target statistics and flags, then the classes' trees."""

    stats: TS.TargetStats
    flags: dict[str, str]
    numeric: list[str]
    classifier: object = None

    @property
    def stages(self) -> list:
        return [self.stats, self.classifier]

    def names(self) -> list[str]:
        """The inputs' names: numbers, flags, then a statistic per class of each other category."""
        return [*self.numeric, *self.flags, *(f"{c}__{i}" for c in self.stats.columns for i in range(len(self.stats.prior)))]

    def assemble(self, df: DataFrame) -> DataFrame:
        """``features`` of rows that have their ``__ts`` columns."""
        single = F.array(*[F.col(c).cast("double") for c in self.numeric],
                         *[F.when(F.coalesce(F.col(c).cast("string"), F.lit(TS.MISSING)) == v, 1.0).otherwise(0.0)
                           for c, v in self.flags.items()]).cast("array<double>")
        every = F.concat(single, *[F.col(f"{c}__ts") for c in self.stats.columns])
        return df.withColumn("features", array_to_vector(every)).drop(*(f"{c}__ts" for c in self.stats.columns))

    def transform(self, df: DataFrame) -> DataFrame:
        return self.classifier.transform(self.assemble(self.stats.encode(df)))


def boosted_inputs(train: DataFrame, spec: FeatureSpec, seed: int = 0) -> tuple[BoostedModel, DataFrame]:
    """The statistics of a boosting arm and its training rows, encoded in permutation order; no one-hot slot."""
    classes = int(train.agg(F.max("label")).first()[0]) + 1
    every = TS.fit(train, spec.categorical, classes)
    sizes = every.table.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("v")).collect()
    flags = {r["feature"]: r["v"] for r in sizes if r["n"] <= 2}
    wide = [c for c in spec.categorical if c not in flags]
    stats = TS.TargetStats(wide, every.prior, every.table.filter(F.col("feature").isin(wide)), every.smoothing)
    model = BoostedModel(stats, {c: flags[c] for c in spec.categorical if c in flags}, list(spec.numeric))
    return model, model.assemble(TS.encode_ordered(train, stats, IDS, seed=seed))


@dataclass
class BoostedRows:
    """What a boosting arm starts from whatever its parameters: the statistics and the training rows encoded by them, written once."""

    unfitted: BoostedModel
    rows: DataFrame

    def fit(self, params: dict, seed: int = 0):
        rows = self.rows.persist(StorageLevel.DISK_ONLY)
        clf = boosted(params.get("maxIter", 20), params.get("maxDepth", 5), params.get("stepSize", 0.1), seed,
                      params.get("minInstancesPerNode", 1), arms_at_once(rows.count()))
        try:  # one-vs-rest would keep rows without a storage level in memory, beside the arms' own binned copies
            return clf.fit(rows)
        finally:
            rows.unpersist()

    def encode(self, df: DataFrame) -> DataFrame:
        return self.unfitted.assemble(self.unfitted.stats.encode(df))

    def model(self, classifier) -> BoostedModel:
        return replace(self.unfitted, classifier=classifier)


def boosted_rows(train: DataFrame, spec: FeatureSpec, seed: int = 0) -> BoostedRows:
    model, rows = boosted_inputs(train, spec, seed)
    return BoostedRows(model, materialize(rows.select("label", "features"), "boosting-rows"))


def fit_boosted(train: DataFrame, spec: FeatureSpec, params: dict, seed: int = 0) -> BoostedModel:
    start = boosted_rows(train, spec, seed)
    return start.model(start.fit(params, seed))


#: Rows that the arms fitted at the same time hold in memory, binned, between them.
ARM_ROWS = 1 << 22


def arms_at_once(rows: int, most: int = 4) -> int:
    """As many one-vs-rest arms side by side as keep within ``ARM_ROWS``; from that size on one arm fills the cluster by itself."""
    return max(1, min(most, ARM_ROWS // max(1, rows)))


def probability_array(df: DataFrame, kind: str) -> DataFrame:
    """Per-row probabilities as array<double> aligned with the class list."""
    if kind == "forest":
        return df.withColumn("scores", vector_to_array("probability"))
    raw = F.transform(vector_to_array("rawPrediction"),
                      lambda m: 1.0 / (1.0 + F.exp(-2.0 * m)))
    total = F.aggregate(raw, F.lit(0.0), lambda a, x: a + x)
    return df.withColumn("scores", F.transform(raw, lambda x: x / F.when(total == 0, 1.0)
                                                .otherwise(total)))


class MacroAucEvaluator(Evaluator):
    """Exact macro one-vs-rest ROC-AUC (J1) as a Spark ML evaluator."""

    def __init__(self, classes: list[int], kind: str = "forest"):
        super().__init__()
        self.classes = classes
        self.kind = kind

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = probability_array(dataset, self.kind).select(
            F.element_at(F.array(*[F.lit(int(c)) for c in self.classes]),
                         F.col("label").cast("int") + 1).alias("purchase"), "scores")
        scored = materialize(scored, "fold-scores")  # the curves read it more than once
        row = R.macro_roc_auc(scored, "purchase", "scores", self.classes).collect()[0]
        return float(row[0]) if row[0] is not None else float("nan")

    def isLargerBetter(self) -> bool:
        return True


def prepare(train: DataFrame, test: DataFrame, classes: list[int]):
    return (train.withColumn("label", label_index(classes)).filter(F.col("label").isNotNull()),
            test.withColumn("label", label_index(classes)))


def search(train: DataFrame, spec: FeatureSpec, classes: list[int], kind: str = "forest",
           folds: int = 2, seed: int = 42, grid: list[dict] | None = None):
    """Grid search with CV on stratified folds; returns (best params, mean, std, all)."""
    enc = Pipeline(stages=encoder_stages(spec, scale=(kind == "forest"))).fit(train)
    if kind == "forest":
        data = encoded_rows(enc, with_weights(train))
        est = forest(seed=seed)
        grid = grid or [{"numTrees": 20, "maxDepth": 5}, {"numTrees": 40, "maxDepth": 10}]
        maps = [{est.getParam(k): v for k, v in g.items()} for g in grid]
    else:
        data = enc.transform(train)
        est = boosted(seed=seed)
        grid = grid or [{"maxIter": 10, "maxDepth": 3}, {"maxIter": 20, "maxDepth": 5}]
        base = est.getClassifier()
        # OneVsRest wraps the tunable classifier: one configured copy per grid point
        maps = [{est.classifier: base.copy({base.getParam(k): v for k, v in g.items()})}
                for g in grid]
    foldable = materialize(S.stratified_folds(data, "label", ["ncodpers", "q"], folds, seed).withColumn(
        "fold", F.col("fold").cast("int")), "search-rows")
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps,
                        evaluator=MacroAucEvaluator(classes, kind), foldCol="fold", numFolds=folds,
                        parallelism=1, seed=seed)
    model = cv.fit(foldable)
    best = max(range(len(maps)), key=lambda i: model.avgMetrics[i])
    return grid[best], model.avgMetrics, list(getattr(model, "stdMetrics", []) or []), enc


def fit_final(train: DataFrame, spec: FeatureSpec, kind: str, params: dict,
              seed: int = 0, select: bool = True):
    """Refit on all given rows: encoder, selection (forest) and classifier.

    A forest is a ``PipelineModel``; boosting a ``BoostedModel``, whose training
    rows are encoded otherwise than the rows it scores.
    """
    start = fit_rows(train, spec, kind, seed, select)
    return start.model(start.fit(params, seed))


@dataclass
class ForestRows:
    """What a forest starts from whatever its parameters: encoder and selection, fitted, and the training rows that they give."""

    stages: list
    rows: DataFrame
    column: str

    def fit(self, params: dict, seed: int = 0):
        return forest(params.get("numTrees", 50), params.get("maxDepth", 10), params.get("minInstancesPerNode", 2), seed, self.column).fit(self.rows)

    def encode(self, df: DataFrame) -> DataFrame:
        return PipelineModel(self.stages).transform(df)

    def model(self, classifier) -> PipelineModel:
        return PipelineModel([*self.stages, classifier])


def fit_rows(train: DataFrame, spec: FeatureSpec, kind: str, seed: int = 0, select: bool = True) -> ForestRows | BoostedRows:
    if kind != "forest":
        return boosted_rows(train, spec, seed)
    encoder = Pipeline(stages=encoder_stages(spec)).fit(train)
    rows = encoded_rows(encoder, with_weights(train))
    stages = list(encoder.stages)
    if select:
        stages.append(ImportanceSelector(seed=SELECTION_SEED).fit(rows))
        rows = stages[-1].transform(rows)
    return ForestRows(stages, rows, "features_sel" if select else "features")


#: Values that a 0/1 slot is declared with.  Above 5 (for 32 bins) trees count a categorical feature by value instead of testing
#: each of its splits row by row; the values that never occur add no split, so the candidates are the same.
SLOT_VALUES = 6


def ordered_slots(df: DataFrame, column: str = "features") -> DataFrame:
    """``df`` with the 0/1 slots of a vector column declared as ordered categories, names kept."""
    meta = df.schema[column].metadata
    groups = dict(meta.get("ml_attr", {}).get("attrs", {}))
    binary = groups.pop("binary", [])
    if not binary:
        return df
    groups["nominal"] = [*groups.get("nominal", []), *({"idx": a["idx"], "num_vals": SLOT_VALUES} | {k: a[k] for k in ("name",) if k in a} for a in binary)]
    return df.withMetadata(column, meta | {"ml_attr": meta["ml_attr"] | {"attrs": groups}})


def encoded_rows(encoder: PipelineModel, rows: DataFrame) -> DataFrame:
    """Ids, label, weight and vector of the rows that forests are fitted on, encoded and written once: every fit reads its input several
    times.  Bootstrap samples follow the rows' places, so places are set by the ids."""
    ids = [c for c in IDS if c in rows.columns]
    dealt = spread(rows, *ids)
    if ids:
        dealt = dealt.sortWithinPartitions(*ids)
    return materialize(ordered_slots(encoder.transform(dealt).select(*ids, "label", "weight", "features")), "forest-rows")


class Folds:
    """The folds (E4, skew-safe positions) of training rows, and what the fits on them start from.

    Encoders, statistics and selection are fitted on a fold's training part, by
    kind; they do not depend on a trial's parameters, so that all trials share them.
    """

    def __init__(self, train: DataFrame, spec: FeatureSpec, folds: int = 2, seed: int = 42):
        self.spec, self.folds, self.seed = spec, folds, seed
        self.rows = materialize(S.stratified_folds(train, "label", ["ncodpers", "q"], folds, seed).withColumn(
            "fold", F.col("fold").cast("int")), "fold-rows")
        self._starts: dict[tuple, tuple] = {}
        self._lock = threading.Lock()

    def start(self, kind: str, fold: int) -> tuple[ForestRows | BoostedRows, DataFrame]:
        """The fits' start on the other folds, and the fold's own rows, encoded."""
        with self._lock:
            if (kind, fold) not in self._starts:
                start = fit_rows(self.rows.filter(F.col("fold") != fold).drop("fold"), self.spec, kind, self.seed)
                held = start.encode(self.rows.filter(F.col("fold") == fold))
                vector = "features" if kind != "forest" else start.column
                self._starts[kind, fold] = start, materialize(held.select("label", vector), "fold-held")
            return self._starts[kind, fold]


def out_of_fold(train: DataFrame, spec: FeatureSpec, classes: list[int], kind: str,
                params: dict, folds: int = 2, seed: int = 42, shared: Folds | None = None) -> list[tuple[int, float]]:
    """Per fold, fit on the other folds and score the exact macro ROC-AUC on it; ``shared`` are the folds of ``train`` if made already."""
    shared = shared or Folds(train, spec, folds, seed)
    ev = MacroAucEvaluator(classes, kind)
    out = []
    for f in range(folds):
        start, held = shared.start(kind, f)
        out.append((f, float(ev.evaluate(start.fit(params, seed).transform(held)))))
    return out


def study(train: DataFrame, spec: FeatureSpec, classes: list[int], spaces: dict, trials: int = 20, timeout: float = 900.0,
          folds: int = 2, seed: int = 42, workers: int = 2) -> list[HS.Trial]:
    """A search over kinds on the same folds as ``out_of_fold``, whose values a trial's fold values are."""
    shared = Folds(train, spec, folds, seed)

    def evaluate(kind: str, params: dict) -> list[float]:
        return [v for _, v in out_of_fold(train, spec, classes, kind, params, folds, seed, shared)]

    return HS.run_study(evaluate, spaces, trials, timeout, seed, workers)


def trial_table(spark, trials: list[HS.Trial]) -> DataFrame:
    """A row per trial: number, kind, params, cv_mean, cv_std."""
    rows = [(t.number, t.kind, ", ".join(f"{k}={v:.6g}" if isinstance(v, float) else f"{k}={v}" for k, v in sorted(t.params.items())), t.value, t.std)
            for t in trials]
    return spark.createDataFrame(rows, "trial int, kind string, params string, cv_mean double, cv_std double")


def importances(model: PipelineModel, scored: DataFrame) -> DataFrame:
    """(feature, importance) of the forest's inputs, most important first, named by the vector's metadata."""
    clf = model.stages[-1]
    column = clf.getFeaturesCol()
    imp = clf.featureImportances.toArray()
    rows = sorted(zip(slot_names(scored, column, len(imp)), map(float, imp), strict=True), key=lambda r: (-r[1], r[0]))
    return scored.sparkSession.createDataFrame(rows, "feature string, importance double")


def scoring(scored: DataFrame, classes: list[int], k: int = 3) -> DataFrame:
    """Best class, its name, confidence and the top-k (code, probability),
    classes sorted by probability with ties in class order."""
    from ..operators.panel import class_name
    items = F.array(*[F.struct((-F.col("scores")[i]).alias("neg"), F.lit(i).alias("pos"),
                               F.lit(int(c)).alias("code"))
                      for i, c in enumerate(classes)])
    ranked = F.array_sort(items)
    scored = scored.drop("prediction", "product", "confidence", "top_k")
    top = F.transform(F.slice(ranked, 1, k),
                      lambda e: F.struct(e["code"].alias("code"),
                                         (-e["neg"]).alias("probability")))
    return scored.select("*", ranked[0]["code"].alias("prediction"),
                         class_name(ranked[0]["code"]).alias("product"),
                         (-ranked[0]["neg"]).alias("confidence"), top.alias("top_k"))


def evaluate(scored: DataFrame, classes: list[int], candidates: list[int], train: DataFrame):
    """J2-J12 on model scores: returns (summary row, top-K report)."""
    used, _ = R.available_candidates(classes, candidates)
    stats = R.ranking_stats(scored, "purchase", "scores", classes, candidates)
    pred = scored.select("*", R.predicted_class(F.col("scores"), classes).alias("pred"))
    report = R.per_class_report(R.confusion(pred, "purchase", "pred"))
    summary = R.classification_summary(report)
    auc = R.macro_roc_auc(scored, "purchase", "scores", classes)
    per_class = R.per_class_curves(scored, "purchase", "scores", classes)
    pr = per_class.agg(F.avg("pr_auc").alias("pr_auc_macro"))
    pop = R.popularity_stats(stats.drop("rank", "relevant", "purchased"), "purchase",
                             R.popularity_order(train, "purchase", used))
    topk = R.top_k_report(stats, len(used), pop)
    at5 = topk.filter(F.col("k") == 5).agg(*[
        F.max(F.when(F.col("scope") == s, F.col(m))).alias(f"{s}_{m}")
        for s in R.SCOPES for m in ("precision_at_k", "recall_at_k", "ndcg_at_k", "hit_rate_at_k")])
    row = (summary.unionByName(auc, allowMissingColumns=True)
           .unionByName(pr, allowMissingColumns=True)
           .unionByName(at5, allowMissingColumns=True))
    cols = [c for c in row.columns]
    return row.agg(*[F.max(c).alias(c) for c in cols]), topk


def variant_table(rows: list[DataFrame]) -> DataFrame:
    """One row per variant (name column added by the caller)."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out


def winner(table: DataFrame, metric: str = "cv_score") -> DataFrame:
    """The variant with the best CV value; of equal ones the first by name."""
    best = F.min(F.struct((-F.col(metric)).alias("_m"), "variant"))
    return table.filter(F.col(metric).isNotNull()).agg(best["variant"].alias("winner"), F.max(metric).alias(metric))


__all__ = ["FeatureSpec", "class_weights", "encoder_stages", "evaluate", "fit_final",
           "importances", "prepare", "probability_array", "scoring", "search", "small_list",
           "variant_table", "winner"]
