"""Preprocessing fit/apply on the reference's hand-made cases (F, G, H, E2)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from nextbuy.functions import features as H
from nextbuy.functions import prep as G
from nextbuy.operators import splits as S
from nextbuy.products import PRODUCTS

SPEC = {"mode": "intervals", "base_date": "2020-01-01", "closed": "right", "missing_label": "nan",
        "intervals": [{"left_days": -1, "right_days": 10, "label": "first"},
                      {"left_days": 10, "right_days": 20, "label": "second"}]}


def test_date_cohort_intervals(spark):
    df = spark.createDataFrame([("2020-01-01",), ("2020-01-11",), ("2020-01-12",),
                                ("2021-06-01",), (None,)], "d string")
    got = [r[0] for r in df.select(G.date_cohort_expr(F.col("d"), SPEC)).collect()]
    assert got == ["first", "first", "second", "unknown", "nan"]


def test_date_cohort_raw(spark):
    df = spark.createDataFrame([("2020-03-05",), (None,)], "d string")
    got = [r[0] for r in df.select(G.date_cohort_expr(F.col("d"), {"mode": "raw"})).collect()]
    assert got == ["2020-03-05", "unknown"]


def test_fixed_intervals(spark):
    ivs = ["2008-09-30 – 2011-09-01", "2011-09-01 – 2012-07-23"]
    df = spark.createDataFrame([("2010-05-17",), ("1900-01-01",), (None,), ("not-a-date",)],
                               "d string")
    got = [r[0] for r in df.select(G.fixed_interval_expr(F.col("d"), ivs)).collect()]
    assert got == [ivs[0], None, None, None]


def test_age_interval_default_bins(spark):
    df = spark.createDataFrame([(1.0,), (45.0,), (200.0,), (24.0,)], "age double")
    got = [r[0] for r in df.select(
        G.age_interval_expr(F.col("age"), G.LEGACY_AGE_INTERVALS)).collect()]
    assert got == ["2-23", "42-45", "64-164", "2-23"]


def test_rare_folding_string_domain(spark):
    df = spark.createDataFrame([("ES",), ("ES",), ("XX",)], "c string")
    got = [r[0] for r in df.select(G.fold_rare_expr("c", {"XX": "other"})).collect()]
    assert got == ["ES", "ES", "other"]
    nums = spark.createDataFrame([(28.0,), (8.0,), (None,)], "c double")
    got = [r[0] for r in nums.select(G.fold_rare_expr("c", {"28.0": "other"})).collect()]
    assert got == ["other", "8.0", None]


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("bad", -999999.0, None), ("30", 10.0, 1.0)],
                               "age string, antiguedad double, renta double")
    rows = G.coerce_numeric(df).collect()
    assert (rows[0].age, rows[0].antiguedad) == (None, None)
    assert (rows[1].age, rows[1].antiguedad) == (30.0, 10.0)


def test_clip(spark):
    df = spark.createDataFrame([(0.0, -5.0), (1e9, 1e6), (None, None)], "renta double, antiguedad double")
    b = G.LEGACY_CLIP_BOUNDS
    rows = df.select(G.clip_expr("renta", *b["renta"]).alias("r"),
                     G.clip_expr("antiguedad", *b["antiguedad"]).alias("t")).collect()
    assert (rows[0].r, rows[0].t) == (26449.65, 1.0)
    assert (rows[1].r, rows[1].t) == (337117.17, 207.0)
    assert (rows[2].r, rows[2].t) == (None, None)


def test_total_products(spark):
    zero = {p: 0 for p in PRODUCTS}
    zero["prod_03"] = 1
    ones = {p: 1 for p in PRODUCTS}
    df = spark.createDataFrame([zero, ones])
    got = [r[0] for r in df.select(G.total_products()).collect()]
    assert got == [1.0, float(len(PRODUCTS))]


def test_group_stats_fit_and_unseen(spark):
    df = spark.createDataFrame([("ES", "A", 100.0, 10.0), ("ES", "A", 200.0, 30.0),
                                ("FR", "B", 300.0, 20.0)],
                               "pais_residencia string, segmento string, renta double, antiguedad double")
    stats = H.fit_group_stats(df)
    aggs = stats.as_dict()
    m = aggs["mean_renta_by_pais_residencia"]
    assert m["ES"] == 150.0 and m["FR"] == 300.0 and m["__default__"] == 200.0
    new = spark.createDataFrame([("XX", "ZZ", 50.0, 5.0)],
                                "pais_residencia string, segmento string, renta double, antiguedad double")
    assert H.add_features(new, aggs).collect() == H.add_features(new, stats).collect()
    r = H.add_features(new, stats).collect()[0]
    assert r.mean_renta_by_pais_residencia == 200.0
    assert r.median_antiguedad_by_segmento == 20.0
    # legacy parameters without a default fall back to the mean of the stored values
    legacy = {k: {kk: vv for kk, vv in v.items() if kk != "__default__"} for k, v in aggs.items()}
    r2 = H.add_features(new, legacy).collect()[0]
    assert r2.mean_renta_by_pais_residencia == pytest.approx(225.0)


def test_sanitize_edge_cases(spark):
    df = spark.createDataFrame([(0.0, 0.0, "ES", "A"), (-1.0, -5.0, "ES", "A")],
                               "antiguedad double, renta double, pais_residencia string, segmento string")
    out = H.add_features(df, H.fit_group_stats(df))
    bad = H.quality_check(out, H.NUMERIC_FEATURES).collect()[0]
    assert all(v == 0 for v in bad)


def test_temporal_split(spark):
    dates = [dt.date(2020, 1, 1)] * 10 + [dt.date(2020, 2, 1)] * 10 + [dt.date(2020, 3, 1)] * 10
    df = spark.createDataFrame([(d,) for d in dates], "fecha_alta date")
    flagged, cutoff = S.temporal_split(df, "fecha_alta", 0.3)
    train = [r[0] for r in flagged.filter("part = 'train'").select("fecha_alta").collect()]
    test = [r[0] for r in flagged.filter("part = 'test'").select("fecha_alta").collect()]
    assert train and test and max(train) <= cutoff < min(test)
    assert len(train) + len(test) == 30
    one = spark.createDataFrame([(dt.date(2020, 1, 1),)] * 5, "fecha_alta date")
    with pytest.raises(ValueError):
        S.temporal_split(one, "fecha_alta", 0.3)


def test_drift_reference_deciles(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)], "age double")
    ref = G.drift_reference(df, ("age",), 10)["age"]
    assert len(ref["edges"]) == 11
    assert ref["edges"][0] == float("-inf") and ref["edges"][-1] == float("inf")
    assert ref["shares"] == pytest.approx([0.1] * 10)


def test_stratified_sample_exact_counts(spark):
    rows = [(i, 0) for i in range(1000)] + [(1000 + i, 3) for i in range(30)] + \
        [(2000 + i, 5) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, label int")
    s = S.stratified_sample(df, "label", ["id"], 0.15, seed=1)
    counts = {r.label: r["count"] for r in s.groupBy("label").count().collect()}
    assert counts == {0: 150, 3: 30, 5: 60}
    again = S.stratified_sample(df, "label", ["id"], 0.15, seed=1)
    assert sorted(r.id for r in s.collect()) == sorted(r.id for r in again.collect())
    folds = S.stratified_folds(df, "label", ["id"], 3, seed=0)
    per = {(r.label, r.fold): r["count"] for r in folds.groupBy("label", "fold").count().collect()}
    assert per[(3, 0)] == per[(3, 1)] == per[(3, 2)] == 10


def test_fit_apply_parity(spark):
    """Apply(fit) leaves no NULL in the fitted columns and matches on train."""
    from nextbuy.plans import datasets as D
    train, test = D.prep_frames(spark, "/root/testdata/sf0.001")
    train = train.drop(*D.FIT_DROP)
    p = G.fit_params(train)
    out = G.apply_params(train, p)
    nulls = out.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in
                      ("age", "antiguedad", "renta", "age_interval", "fecha_alta")]).collect()[0]
    assert all(v == 0 for v in nulls)
    assert len(p.age_intervals) == 9 and p.date_cohorts["fecha_alta"]["mode"] == "intervals"


def test_rare_fold_join_equals_literal_map(spark):
    rows = [(i, f"v{i % 7}" if i % 50 else "rare_a", float(i % 3) if i % 40 else 28.0)
            for i in range(400)]
    df = spark.createDataFrame(rows, "id int, cat string, num double")
    rare = G.rare_values(df, ["cat", "num"], 0.04)
    mapping = {}
    for r in rare.collect():
        mapping.setdefault(r["column"], {})[r["value"]] = "other"
    assert mapping["cat"] == {"rare_a": "other"} and mapping["num"] == {"28.0": "other"}
    by_map = df.select("id", *[G.fold_rare_expr(c, mapping[c]).alias(c) for c in ("cat", "num")])
    by_join = G.fold_rare_join(df, rare, ["cat", "num"]).select("id", "cat", "num")
    assert sorted(by_map.collect()) == sorted(by_join.collect())


def test_many_categories_and_rare_values(spark, tmp_path):
    """20,001 categories through fit, save, load and apply; the median of a category that holds most rows is exact."""
    from nextbuy.sources import io as A
    n = 20_001
    rows = spark.range(n * 2).select(
        F.concat(F.lit("c"), F.col("id") % n).alias("pais_residencia"), F.lit("A").alias("segmento"), F.col("id").cast("double").alias("renta"),
        (F.col("id") * 7 % 1000).cast("double").alias("antiguedad"), (F.col("id") % 60 + 20).cast("double").alias("age"), F.lit("K").alias("canal_entrada"),
        F.lit(dt.date(2015, 1, 1)).alias("fecha_alta"), *[F.lit(0).cast("byte").alias(p) for p in PRODUCTS], F.lit(0).alias("purchase"))
    p = G.fit_params(rows)
    assert p.rare.count() == n and p.rare_columns == ["pais_residencia"]
    A.write_params(spark, p, str(tmp_path / "params"))
    back, _ = A.read_params(spark, str(tmp_path / "params"))
    out = G.apply_params(rows, back)
    assert [r[0] for r in out.select("pais_residencia").distinct().collect()] == ["other"]
    stats = H.fit_group_stats(rows)
    assert stats.tables["pais_residencia"].count() == n
    got = H.add_features(rows, stats).filter("pais_residencia = 'c7'").first()
    assert got.mean_renta_by_pais_residencia == (7 + 7 + n) / 2
    assert got.median_antiguedad_by_pais_residencia == (49 + (7 + n) * 7 % 1000) / 2


def test_grouped_quantile_is_exact(spark):
    import random
    from nextbuy.functions.quantiles import grouped_quantile
    r = random.Random(4)
    rows = [(r.choice(["big"] * 9 + ["b", "c", None]), r.choice([r.gauss(0, 1e6), r.gauss(0, 1e-6), 5.0, float("nan"), None])) for _ in range(3000)]
    rows += [("one", 3.0), ("two", 1.0), ("two", 2.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    for q in (0.5, 0.1, 1.0):
        got = {x["g"]: x["value"] for x in grouped_quantile(df, "g", "x", q).collect()}
        want = {x["g"]: x["v"] for x in df.filter("g is not null and x is not null and not isnan(x)").groupBy("g").agg(F.percentile("x", q).alias("v")).collect()}
        assert got == want


def test_modes_as_spark_has_them(spark):
    rows = [(1, "b", 2.5, None, dt.date(2020, 1, 2)), (1, "a", 1.5, None, dt.date(2020, 1, 1)), (2, "a", 2.5, None, dt.date(2020, 1, 1)), (10, "b", 1.5, None, None)] * 3
    df = spark.createDataFrame(rows, "i int, s string, x double, e string, d date")
    want = df.agg(*[F.mode(c, True).alias(c) for c in df.columns]).first().asDict()
    want = {c: v.isoformat() if isinstance(v, dt.date) else v for c, v in want.items() if v is not None}
    assert G.column_modes(df, df.columns) == want


def test_cohort_of_a_date_is_found_once(spark):
    """The date is parsed once a row, not once for every interval of the spec."""
    rows = [(dt.date(2001, 1, 1) + dt.timedelta(days=i),) for i in range(40)] + [(None,)]
    df = spark.createDataFrame(rows, "d date")
    spec = G.date_cohort_spec(df, "d", 12)
    for made in (G.date_cohort_expr(F.col("d"), spec), G.fit_cohort_expr(F.col("d"), spec)):
        plan = df.select(made.alias("c"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.lower().count("datediff(") == 1
    assert G.cohort_mismatches(df, "d", spec).first()["mismatches"] == 0


def test_quantiles_keep_no_sketches(spark, monkeypatch):
    from nextbuy.functions import quantiles as Q
    monkeypatch.delattr(Q.F, "approx_count_distinct")
    df = spark.range(101).select(F.col("id").cast("double").alias("x"))
    assert Q.exact_quantiles(df, "x", [0.0, 0.5, 1.0]) == [0.0, 50.0, 100.0]


def test_kinds_equal_the_exact_numbers(spark):
    from nextbuy.functions import features as H
    df = spark.range(60).select(
        "id", (F.col("id") % 24).cast("double").alias("few"), (F.col("id") % 25).cast("int").alias("enough"),
        F.when(F.col("id") % 25 > 0, F.col("id") % 25).alias("holes"), F.lit(None).cast("double").alias("none"), F.col("id").cast("string").alias("text")).repartition(7)
    exact = {r["feature"]: r["kind"] for r in H.feature_types(df, df.columns).collect()}
    assert H.feature_kinds(df, df.columns) == exact
    assert exact["few"] == exact["holes"] == "categorical" and exact["enough"] == "numeric"
