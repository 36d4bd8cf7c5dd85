"""Selection stage, Parzen search and the boosting arm's inputs."""
import functools
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from nextbuy.plans import models as M
from nextbuy.plans import search as S
from nextbuy.plans.selection import ImportanceSelector


def frame(spark, n=600, seed=5):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        kind = r.choice("abc")
        label = {"a": 0, "b": 1, "c": 2}[kind] if r.random() < 0.8 else r.randint(0, 2)
        rows.append((i, i % 4, kind, r.choice(["0", "1"]), r.choice(["x", None, "y"]), label * 2.0 + r.random(), r.random(), float(label)))
    return spark.createDataFrame(rows, "ncodpers long, q int, kind string, flag string, other string, good double, noise double, label double").withColumn(
        "purchase", F.element_at(F.array(F.lit(0), F.lit(7), F.lit(99)), F.col("label").cast("int") + 1))


SPEC = M.FeatureSpec(["good", "noise"], ["kind", "flag", "other"])


def test_selector_in_a_pipeline(spark, tmp_path):
    df = M.with_weights(frame(spark))
    stages = [VectorAssembler(inputCols=["good", "noise"], outputCol="features"), ImportanceSelector(numTrees=10, maxDepth=4, seed=1),
              M.forest(5, 3, features="features_sel")]
    model = Pipeline(stages=stages).fit(df)
    assert [x[1] for x in model.stages[1].selected()] == ["good"] and model.stages[1].selected()[0][2] > 0.5
    model.write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    assert back.stages[1].selected() == model.stages[1].selected()
    one, two = (m.transform(df).select("ncodpers", "prediction").orderBy("ncodpers").collect() for m in (model, back))
    assert one == two
    assert model.transform(df).select("features_sel").first()[0].size == 1


def test_forest_pipeline_selects(spark):
    model = M.fit_final(frame(spark), SPEC, "forest", {"numTrees": 5, "maxDepth": 4})
    kept = [n for _, n, _ in model.stages[-2].selected()]
    assert "_num_s_0" in kept and 0 < len(kept) < 9
    assert model.stages[-1].numFeatures == len(kept)


def test_boosting_takes_raw_categories(spark):
    df = frame(spark)
    model, rows = M.boosted_inputs(df, SPEC)
    names = model.names()
    assert names == ["good", "noise", "flag", *(f"{c}__{i}" for c in ("kind", "other") for i in range(3))]
    assert rows.count() == df.count()
    got = {r["ncodpers"]: r["features"].toArray() for r in rows.collect()}
    raw = {r["ncodpers"]: r for r in df.collect()}
    for k, v in got.items():
        assert len(v) == len(names) and v[0] == raw[k]["good"] and v[2] == float(raw[k]["flag"] == "1")
        assert v[3:6].sum() == pytest.approx(1) and v[6:].sum() == pytest.approx(1)
    fitted = M.fit_final(df, SPEC, "boosting", {"maxIter": 2, "maxDepth": 2})
    scored = M.probability_array(fitted.transform(df), "boosting")
    assert scored.filter(F.abs(F.aggregate("scores", F.lit(0.0), lambda a, x: a + x) - 1) > 1e-9).count() == 0
    assert M.MacroAucEvaluator([0, 7, 99], "boosting").evaluate(fitted.transform(df)) > 0.8


def test_trial_value_is_out_of_fold(spark, monkeypatch):
    monkeypatch.setattr(M, "ImportanceSelector", functools.partial(ImportanceSelector, numTrees=4, maxDepth=3))
    df = frame(spark, 200).persist()
    spaces = {"forest": {"numTrees": S.IntRange(3, 5), "maxDepth": S.Choice((2, 3)), "minInstancesPerNode": S.IntRange(2, 4)},
              "boosting": {"maxIter": S.IntRange(1, 2), "maxDepth": S.IntRange(2, 2), "stepSize": S.FloatRange(0.1, 0.3, log=True)}}
    trials = M.study(df, SPEC, [0, 7, 99], spaces, trials=2, timeout=600, workers=2)
    assert [t.kind for t in trials] == ["forest", "boosting"]
    for t in trials:
        folds = [v for _, v in M.out_of_fold(df, SPEC, [0, 7, 99], t.kind, t.params, 2, 42)]
        assert t.folds == pytest.approx(folds) and t.value == pytest.approx(np.mean(folds)) and t.std == pytest.approx(np.std(folds))
    table = M.trial_table(spark, trials).collect()
    assert [r.trial for r in table] == [0, 1] and all(0.5 < r.cv_mean <= 1 for r in table)


def peak(kind, params):
    return [-((np.log(params["x"]) - np.log(0.1)) ** 2) - abs(params["n"] - 37) / 40 - (0 if params["c"] == "b" else 0.5)]


SPACE = {"x": S.FloatRange(0.01, 1.0, log=True), "n": S.IntRange(1, 60), "c": S.Choice(("a", "b", None))}


def test_search_is_seeded_and_learns():
    one = S.run_study(peak, {"k": SPACE}, 60, 1e9, seed=3, workers=3)
    two = S.run_study(peak, {"k": SPACE}, 60, 1e9, seed=3, workers=3)
    assert [t.params for t in one] == [t.params for t in two] and [t.number for t in one] == list(range(60))
    early, late = [t.value for t in one[:15]], [t.value for t in one[-15:]]
    assert np.mean(late) > np.mean(early) + 0.5
    # later proposals are better than random draws, over several seeds
    wins = 0
    for seed in range(8):
        searched, drawn = (np.mean([t.value for t in S.run_study(peak, {"k": SPACE}, 40, 1e9, seed=seed, workers=2, startup=n)[20:]]) for n in (S.STARTUP, 10**6))
        wins += searched > drawn
    assert wins >= 7


def test_proposals_stay_inside():
    for t in S.run_study(peak, {"k": SPACE}, 50, 1e9, seed=9):
        assert 0.01 <= t.params["x"] <= 1 and 1 <= t.params["n"] <= 60 and isinstance(t.params["n"], int) and t.params["c"] in ("a", "b", None)


def test_shared_budget_and_failures():
    seen = []

    def evaluate(kind, params):
        seen.append(kind)
        return [float("nan")] if kind == "bad" else [0.5, float("nan")]

    trials = S.run_study(evaluate, {"bad": SPACE, "good": SPACE}, 7, 1e9, workers=2)
    assert len(trials) == 7 and seen.count("bad") == 4
    assert S.best(trials).kind == "good" and S.best(trials, "bad") is None and S.best(trials).number == 1
    with pytest.raises(ValueError, match="no trial"):
        S.run_study(lambda k, p: [float("nan")], {"k": SPACE}, 3, 1e9)
    # no round after the timeout, but at least one
    assert len(S.run_study(peak, {"k": SPACE}, 50, -1.0, workers=2)) == 2


def test_ordered_slots_give_the_same_tree(spark):
    df = M.with_weights(frame(spark))
    enc = Pipeline(stages=M.encoder_stages(M.FeatureSpec(["noise"], SPEC.categorical))).fit(df)  # "good" has equally good splits
    rows = enc.transform(df)
    ordered = M.ordered_slots(rows)
    plain, groups = (x.schema["features"].metadata["ml_attr"]["attrs"] for x in (rows, ordered))
    assert "binary" not in groups and {(a["idx"], a["name"]) for a in groups["nominal"]} == {(a["idx"], a["name"]) for a in plain["binary"]}
    assert groups["numeric"] == plain["numeric"]
    tree = M.forest(1, 4, 1).setFeatureSubsetStrategy("all").setBootstrap(False)
    one, two = (tree.fit(x) for x in (rows, ordered))
    got = [np.array([r["probability"].toArray() for r in m.transform(rows).orderBy("ncodpers").collect()]) for m in (one, two)]
    assert np.allclose(*got) and len(np.unique(got[0], axis=0)) > 3


def test_forest_rows_are_encoded_once_and_placed_by_id(spark, monkeypatch):
    written = []
    real = M.materialize
    monkeypatch.setattr(M, "materialize", lambda df, name, *a: written.append(name) or real(df, name, *a))
    params = {"numTrees": 5, "maxDepth": 4}
    one = M.fit_final(frame(spark), SPEC, "forest", params)
    two = M.fit_final(frame(spark).repartition(7, "noise"), SPEC, "forest", params)
    assert written == ["forest-rows"] * 2
    assert one.stages[-2].selected() == two.stages[-2].selected()


def test_boosting_arms_share_memory_by_rows(spark):
    assert [M.arms_at_once(n) for n in (0, 1000, 1 << 20, 1 << 21, 1 << 22, 13_000_000)] == [4, 4, 4, 2, 1, 1]
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    levels = []

    class Clf:
        def fit(self, rows):
            levels.append(rows.storageLevel)
            return "fitted"

    import unittest.mock as um
    with um.patch.object(M, "boosted", lambda *a: Clf()):
        assert M.fit_boosted(frame(spark), SPEC, {}).classifier == "fitted"
    assert levels[0].useDisk and not levels[0].useMemory
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept


def test_trials_share_what_does_not_depend_on_them(spark, monkeypatch):
    monkeypatch.setattr(M, "ImportanceSelector", functools.partial(ImportanceSelector, numTrees=3, maxDepth=2))
    written = []
    real = M.materialize
    monkeypatch.setattr(M, "materialize", lambda df, name, *a: written.append(name) or real(df, name, *a))
    spaces = {"forest": {"numTrees": S.IntRange(2, 4), "maxDepth": S.Choice((2,))},
              "boosting": {"maxIter": S.IntRange(1, 1), "maxDepth": S.IntRange(2, 2)}}
    trials = M.study(frame(spark, 150), SPEC, [0, 7, 99], spaces, trials=6, timeout=600, workers=2)
    assert len(trials) == 6 and all(len(t.folds) == 2 for t in trials)
    # two folds: their rows, the rows of each kind's fits and the held rows are written once, the scores by every fit
    assert [written.count(x) for x in ("fold-rows", "forest-rows", "boosting-rows", "fold-held", "fold-scores")] == [1, 2, 2, 4, 12]
