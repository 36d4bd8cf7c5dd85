"""The training run's own steps on rows of its own."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from nextbuy.functions import features as H
from nextbuy.plans import catalog as C
from nextbuy.plans import datasets as D
from nextbuy.plans import search as HS
from nextbuy.plans import train_run as T
from nextbuy.products import PRODUCTS


@pytest.fixture
def frame(spark, monkeypatch):
    """60 clients in four snapshots: three countries, two segments, one of them only in test."""
    i = F.col("id")
    rows = spark.range(240).select(
        (i % 60).alias("ncodpers"), (i / 60).cast("int").alias("q"), F.make_date(F.lit(2015), (i / 60).cast("int") + 1, F.lit(1)).alias("snapshot_date"),
        F.element_at(F.array(F.lit(0), F.lit(3), F.lit(99)), (i % 3 + 1).cast("int")).alias("purchase"),
        F.when(i < 180, "train").otherwise("test").alias("split"), F.array(F.lit(1)).alias("owned"),
        (i % 50 + 20).cast("double").alias("age"), F.date_add(F.lit(dt.date(2010, 1, 1)), (i % 40).cast("int")).alias("fecha_alta"),
        (i % 37).cast("double").alias("antiguedad"), (i * 10 + 1).cast("double").alias("renta"),
        F.when(i >= 180, "Z").otherwise(F.concat(F.lit("S"), i % 2)).alias("segmento"), F.concat(F.lit("c"), i % 3).alias("pais_residencia"),
        F.lit("K").alias("canal_entrada"), *[(i % 2).cast("int").alias(p) for p in PRODUCTS])
    shortlist = spark.createDataFrame([(3,)], "code int")
    monkeypatch.setattr(D, "modelling_frame", lambda *a, **k: (rows, shortlist))
    monkeypatch.setattr(T, "_MATRICES", {})
    return rows


def test_written_parameters_have_the_group_statistics(spark, frame):
    sections = {r["section"]: r["entries"] for r in C.a6_params_write(spark, "nowhere").collect()}
    assert sections["aggregates"] == 2 * (3 + 1) + 2 * (2 + 1)  # a value a category and one for unseen ones, mean and median
    mx = T.build_matrices(spark, "nowhere")
    names = [n for c in H.GROUP_COLUMNS for n in H.GroupStats().names(c)]
    assert list(mx.params.aggregates) == names
    # what is saved gives the same columns as the statistics that the matrices were made with
    train = T.G.apply_params(frame.filter("split = 'train'"), mx.params)
    test = T.G.apply_params(frame.filter("split = 'test'"), mx.params)
    for part in (train, test):
        saved = H.add_features(part, mx.params.aggregates).select("ncodpers", "q", *names)
        fitted = H.add_features(part, H.fit_group_stats(train)).select("ncodpers", "q", *names)
        assert sorted(saved.collect()) == sorted(fitted.collect())


def test_the_search_is_the_whole_one(spark, frame, monkeypatch):
    """The report queries search the library's whole spaces, 20 trials of each kind, without an end by the clock."""
    asked = []

    def study(rows, spec, classes, spaces, trials, timeout, *more):
        asked.append((rows.count(), spaces, trials, timeout))

        def evaluate(kind, params):
            return [params["maxDepth"] / 100]

        return HS.run_study(evaluate, spaces, trials, timeout)

    monkeypatch.setattr(C.M, "study", study)
    monkeypatch.setattr(C, "_STUDIES", {})
    trials = C.i5_parzen_search(spark, "nowhere").collect()
    (rows, spaces, n, timeout), = asked
    assert n == len(trials) == 40 and {k: sum(t.kind == k for t in trials) for k in spaces} == {"forest": 20, "boosting": 20}
    assert spaces == {"forest": HS.FOREST_SPACE, "boosting": HS.BOOST_SPACE} and timeout == float("inf")
    assert rows == 150  # of each class the larger of 15 % and 50 rows
    assert C.j17_winner(spark, "nowhere").count() == 1 and len(asked) == 1
