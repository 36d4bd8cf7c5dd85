"""Skew-safe building blocks agree with the plain (single-task) forms."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from nextbuy.functions import drift as K
from nextbuy.functions import quantiles as Q
from nextbuy.functions import ranking as R
from nextbuy.operators import profile as B


def test_exact_quantiles_match_percentile(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(0, 1, 5000), np.full(2000, 2.5), rng.exponential(1e-6, 500)])
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,), (float("nan"),)], "x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.96, 1.0]
    want = df.agg(F.percentile(F.when(~F.isnan("x"), F.col("x")), probs)).collect()[0][0]
    assert Q.exact_quantiles(df, "x", probs) == want
    monkeypatch.setattr(Q, "MAX_VALUES", 5)  # force the refinement path
    assert Q.exact_quantiles(df, "x", probs) == want


def test_exact_quantiles_many_match_percentile(spark, monkeypatch):
    rng = np.random.default_rng(4)
    n = 4000
    a = rng.normal(0, 1, n)
    b = np.round(rng.exponential(3, n), 1)
    rows = [(float(a[i]), float(b[i]), 7.0, None) for i in range(n)] + [(None, float("nan"), 7.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    specs = {"a": ("a", [0.0, 0.5, 0.99]), "b": ("b", [0.1, 0.5, 0.9, 1.0]),
             "c": ("c", [0.5]), "d": ("d", [0.5]), "a2": (F.col("a") * 2, [0.25])}
    want = {k: df.agg(F.percentile(F.when(~F.isnan(col if not isinstance(col, str) else F.col(col)),
                                          col if not isinstance(col, str) else F.col(col)),
                                   probs)).collect()[0][0]
            for k, (col, probs) in specs.items()}
    want["d"] = [None]
    assert Q.exact_quantiles_many(df, specs) == want
    monkeypatch.setattr(Q, "MAX_VALUES", 5)  # force the refinement path
    assert Q.exact_quantiles_many(df, specs) == want


def test_curves_with_scores_outside_unit_range(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 3000)
    s = y * 0.8 + rng.normal(0, 1, 3000) * 3  # far outside [0, 1]
    df = spark.createDataFrame([(int(a), [float(b)]) for a, b in zip(y, s)],
                               "purchase int, scores array<double>")
    got = R.binary_curves(R.one_vs_rest_long(df, "purchase", "scores", [1])).collect()[0]
    pos, neg = s[y == 1], s[y == 0]
    auc = (np.sum(pos[:, None] > neg[None, :]) + 0.5 * np.sum(pos[:, None] == neg[None, :])) / (
        len(pos) * len(neg))
    assert got.roc_auc == pytest.approx(auc, abs=1e-12)


def test_near_duplicates_against_brute_force(spark):
    words = ["KHE", "KHF", "KAT", "Brand#1", "Brand#12", "Brand#13", "STANDARD TIN",
             "STANDARD TINS", "LARGE BRUSHED TIN", "LARGE BURNISHED TIN", "abcdefghij"]
    df = spark.createDataFrame([(w,) for w in words], "v string")
    got = {(r.value, r.match) for r in B.near_duplicates(df, "v").collect()}

    def lev(a, b):
        d = list(range(len(b) + 1))
        for i, ca in enumerate(a, 1):
            prev, d[0] = d[0], i
            for j, cb in enumerate(b, 1):
                prev, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, prev + (ca != cb))
        return d[-1]

    want = set()
    for a in words:
        best = sorted(((1 - lev(a, b) / max(len(a), len(b)), b) for b in words if b != a),
                      reverse=True)
        if best and best[0][0] >= 0.8:
            want.add((a, best[0][1]))
    assert got == want


def test_last_n_plans_a_group_limit(spark):
    import datetime as dt
    obs = spark.createDataFrame([(i, dt.datetime(2024, 1, 1), "x", float(i)) for i in range(50)],
                                "event_id long, ts timestamp_ntz, feature string, value double")
    plan = K.last_n(obs, 10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert K.last_n(obs, 10).count() == 10
