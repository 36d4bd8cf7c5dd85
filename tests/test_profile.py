"""Box and Q-Q tables, close matches, raw CSV ingest, last-N cut: against plain versions."""
import datetime as dt
import random
from difflib import get_close_matches
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from nextbuy.functions import drift as K
from nextbuy.operators import profile as B
from nextbuy.products import PRODUCTS
from nextbuy.sources import io as A


def values(seed=1):
    r = random.Random(seed)
    return [r.gauss(10, 2) for _ in range(400)] + [100.0, -80.0, 95.5] + [10.0] * 250 + [None, float("nan")]


def test_box(spark):
    got = B.box_summary(spark.createDataFrame([(v,) for v in values()], "x double").repartition(5), ["x"]).first()
    x = np.array([v for v in values() if v is not None and v == v])
    q1, q2, q3 = np.quantile(x, [0.25, 0.5, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = x[(x >= low) & (x <= high)]
    assert (got.q1, got.median, got.q3) == pytest.approx((q1, q2, q3), abs=1e-6)
    assert (got.whisker_lo, got.whisker_hi) == pytest.approx((inside.min(), inside.max()), abs=1e-6)
    assert got.outliers_lo == (x < low).sum() and got.outliers_hi == (x > high).sum() and got.outliers_lo > 0
    assert B.box_summary(spark.createDataFrame([(None,)], "x double"), ["x"]).collect() == []


def test_inverse_normal(spark):
    p = [1e-9, 1e-4, 0.01, 0.02425, 0.1, 0.5, 0.77, 0.97575, 0.999, 1 - 1e-7]
    got = spark.createDataFrame([(v,) for v in [*p, 0.0, 1.0, None]], "p double").select(B.inverse_normal(F.col("p"))).collect()
    assert [r[0] for r in got[:-3]] == pytest.approx([NormalDist().inv_cdf(v) for v in p], rel=2e-9, abs=1e-9)
    assert [r[0] for r in got[-3:]] == [None, None, None]


def test_qq(spark):
    x = [v for v in values() if v is not None and v == v]
    df = spark.createDataFrame([(v,) for v in values()], "x double")
    points = B.qq_points(df, "x", 19)
    rows = points.orderBy("p").collect()
    at = [(i + 1) / 20 for i in range(19)]
    assert [r.sample for r in rows] == pytest.approx(list(np.quantile(x, at)), abs=1e-6)
    z = [NormalDist().inv_cdf(v) for v in at]
    assert [r.theoretical for r in rows] == pytest.approx(z, abs=1e-6)
    slope, intercept = np.polyfit(z, [r.sample for r in rows], 1)
    fit = B.qq_fit(points).first()
    assert (fit.slope, fit.intercept, fit.r) == pytest.approx((slope, intercept, np.corrcoef(z, [r.sample for r in rows])[0, 1]), abs=1e-4)


@pytest.mark.parametrize("threshold,n", [(0.8, 2), (0.7, 3), (0.9, 2)])
def test_close_matches(spark, threshold, n):
    r = random.Random(3)
    words = ["".join(r.choice("abcd") for _ in range(r.randint(1, 12))) for _ in range(120)]
    words += [w[:k] + r.choice("abcdxyz") + w[k + 1:] for w in words[:60] for k in [r.randint(0, len(w))]] + ["KHE", "KHF", "", "é", "éé"]
    distinct = sorted(set(words))
    want = {}
    for w in distinct:
        found = get_close_matches(w, distinct, n=n, cutoff=threshold) if w else []
        if len(found) > 1:
            want[w] = found
    got = {}
    for x in B.close_matches(spark.createDataFrame([(w,) for w in words] + [(None,)], "v string"), "v", threshold, n).orderBy("value", "rank").collect():
        got.setdefault(x["value"], []).append(x["match"])
    assert got == want and len(want) > 1


def test_raw_csv(spark, tmp_path):
    """Short, long and unparsable records, and records without a client, are set aside as they stand; the rest is the panel."""
    names = [f.name for f in A.PANEL_SCHEMA.fields]
    good = [[str(c), f"2015-0{1 + c % 3}-28", "1", "33", "2010-01-01", "5", "1000.5", "A", "ES", "KHE", *["1"] * len(PRODUCTS)] for c in range(1, 40)]
    bad = [",".join(good[0][:6]), ",".join([*good[1], "extra", "more"]), ",".join(["x12", *good[2][1:]]), ",".join([good[3][0], "31.12.2015", *good[3][2:]])]
    orphan = ",".join(["", *good[4][1:]])
    folder = tmp_path / "raw"
    folder.mkdir()
    for k in range(3):
        (folder / f"p{k}.csv").write_text("\n".join([",".join(names), *[",".join(g) for g in good[k::3]], *(bad + [orphan] if k == 1 else [])]) + "\n")
    counts = A.ingest_panel_csv(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "bad")).first()
    assert (counts.good, counts.bad) == (39, 5)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.ncodpers for r in out.collect()) == list(range(1, 40)) and out.filter("renta <> '1000.5'").count() == 0
    plan = out.filter(F.col("fecha_dato") == dt.date(2015, 1, 28))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fecha_dato" in plan
    aside = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert sorted(r.record for r in aside if r.reason == "malformed") == sorted(bad)
    assert [r.reason for r in aside if r.reason != "malformed"] == ["no client"] and {r.source for r in aside} == {"p1.csv"}


@pytest.mark.parametrize("n", [1, 5, 40, 10_000])
def test_last_n(spark, n):
    """Ties in time, a minute that holds most rows, and fewer rows than wanted."""
    r = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(900):
        minute = 30 if r.random() < 0.7 else r.randint(0, 40)
        rows.append((i, t0 + dt.timedelta(minutes=minute, microseconds=r.choice([0, 0, 0, r.randint(0, 59_999_999)])), r.choice(["a"] * 9 + ["b"]), float(i)))
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, feature string, value double").repartition(6)
    got = {(x["feature"], x["event_id"]) for x in K.last_n(df, n).collect()}
    want = set()
    for f in "ab":
        want |= {(f, x[0]) for x in sorted((x for x in rows if x[2] == f), key=lambda x: (x[1], x[0]))[-n:]}
    assert got == want
    plan = K.last_n(df, n)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("RowNumber") + plan.count("row_number") >= 1
