"""The training run end to end (survey lifecycle L1) as Spark jobs.

panel -> events -> target panel -> fold classes -> calendar split -> fit
preprocessing on train -> apply to both parts -> derived features -> feature
typing -> search + refit -> score test -> metrics.  Each registered model
query calls ``build_matrices`` and the piece it reports on.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import features as H
from ..functions import prep as G
from ..operators import cf
from ..operators import splits as S
from ..products import PRODUCTS
from ..session import ensure_checkpoint_dir, materialize
from . import datasets as D
from . import models as M

BASE_CATEGORICAL = ["pais_residencia", "canal_entrada", "segmento", "age_interval",
                    "fecha_alta", "total_products", *PRODUCTS]
GROUP_FEATURES = ["mean_renta_by_pais_residencia", "median_antiguedad_by_pais_residencia",
                  "mean_renta_by_segmento", "median_antiguedad_by_segmento"]


def class_label(code: int) -> str:
    return {0: "no_purchase", 99: "other"}.get(code, f"prod_{code:02d}")


@dataclass
class Matrices:
    train: DataFrame
    test: DataFrame
    spec: M.FeatureSpec
    classes: list[int]
    candidates: list[int]
    params: G.PrepParams


_MATRICES: dict[tuple, Matrices] = {}


def build_matrices(spark: SparkSession, sf_dir: str, with_als: bool = False, cohort: bool = False) -> Matrices:
    """The encoded parts, written once per session like the panel: every fit and fold scans them."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), ensure_checkpoint_dir(spark), with_als, cohort)
    if key not in _MATRICES:
        mx = _matrices(spark, sf_dir, with_als, cohort)
        _MATRICES[key] = replace(mx, train=materialize(mx.train, "matrix-train"), test=materialize(mx.test, "matrix-test"))
    return _MATRICES[key]


def cohort_frame(frame: DataFrame, test_size: float = 0.3) -> tuple[DataFrame, str]:
    """The second protocol: the labelled rows split by the clients' joining date; returns the cutoff too."""
    flagged, cutoff = S.temporal_split(frame, "fecha_alta", test_size)
    return flagged.withColumn("split", F.col("part")).drop("part"), cutoff.isoformat()


def _matrices(spark: SparkSession, sf_dir: str, with_als: bool, cohort: bool) -> Matrices:
    """Parameters and statistics are fitted on the train part of the protocol: by calendar, or by cohort."""
    frame, sl = D.modelling_frame(spark, sf_dir)
    if cohort:
        frame, _ = cohort_frame(frame)
    keep = ["ncodpers", "q", "snapshot_date", "purchase", "split"]
    train_raw = frame.filter(F.col("split") == "train")
    test_raw = frame.filter(F.col("split") == "test")
    params = G.fit_params(train_raw.drop(*D.FIT_DROP))
    train_p = G.apply_params(train_raw, params)
    test_p = G.apply_params(test_raw, params)
    aggs = H.fit_group_stats(train_p)
    train_f = H.add_features(train_p, aggs)
    test_f = H.add_features(test_p, aggs)
    categorical = list(BASE_CATEGORICAL)
    if with_als:
        lookup = D.als_lookup(spark, sf_dir)
        train_f = cf.attach_feature(train_f, lookup)
        test_f = cf.attach_feature(test_f, lookup)
        categorical.append(cf.FEATURE)
    # H7: numeric candidates with < 25 distinct train values become categorical
    numeric_candidates = H.NUMERIC_FEATURES + GROUP_FEATURES
    types = H.feature_kinds(train_f, numeric_candidates)
    numeric = [c for c in numeric_candidates if types[c] == "numeric"]
    categorical += [c for c in numeric_candidates if types[c] == "categorical"]
    cast = [F.col(c).cast("string").alias(c) for c in categorical]
    train_m = train_f.select(*keep, *numeric, *cast)
    test_m = test_f.select(*keep, *numeric, *cast)
    classes = D.small_list(train_raw, "purchase")
    candidates = [c for c in D.small_list(sl, "code") if c in set(classes)]
    train_m, test_m = M.prepare(train_m, test_m, classes)
    params = replace(params, aggregates=aggs.as_dict(), label_map={c: class_label(c) for c in classes},
                     feature_columns={"numeric": numeric, "categorical": categorical})
    return Matrices(train_m, test_m, M.FeatureSpec(numeric, categorical), classes, candidates,
                    params)


def run_variant(mx: Matrices, kind: str, params: dict, drop: list[str] | None = None,
                seed: int = 0):
    """Fit one variant on all train rows and score the test rows."""
    spec = mx.spec
    if drop:
        missing = [c for c in drop if c not in spec.numeric + spec.categorical]
        if missing:
            raise ValueError(f"cannot drop absent features {missing}")
        spec = M.FeatureSpec([c for c in spec.numeric if c not in drop],
                             [c for c in spec.categorical if c not in drop])
    model = M.fit_final(mx.train, spec, kind, params, seed)
    scored = M.probability_array(model.transform(mx.test), kind)
    return model, scored
