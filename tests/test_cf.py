"""ALS scoring (top-1 with owned products masked, top-k lists) against brute force."""

import numpy as np
from pyspark.sql import functions as F

from nextbuy.operators import cf
from nextbuy.operators import panel as P
from nextbuy.plans import datasets as D

from .conftest import SMALL


def _brute_scores(user_vec, items, exclude):
    """{code: score} of the items not excluded, summed element by element."""
    out = {}
    for code, vec in sorted(items.items()):
        if code in exclude:
            continue
        score = 0.0
        for a, b in zip(user_vec, vec):
            score = score + float(np.float32(a)) * b
        out[code] = score
    return out


def _assert_ranked(names, scores, k):
    """``names`` are the k best of ``scores`` (ties within 1e-9 may swap)."""
    best = sorted(scores.items(), key=lambda t: (-t[1], t[0]))[:k]
    assert len(names) == len(best)
    got = [int(n[len("prod_"):]) for n in names]
    for g, (code, s) in zip(got, best):
        assert abs(scores[g] - s) <= 1e-9 * max(1.0, abs(s))


def _fixture(spark):
    pnl = D.panel(spark, SMALL)
    ev = P.purchase_events(pnl)
    codes = cf.dense_codes(pnl.select("ncodpers"))
    model = cf.fit_als(cf.interactions(ev, codes), rank=4, max_iter=3)
    return pnl, ev, codes, model


def test_top1_and_topk_match_brute_force(spark):
    pnl, ev, codes, model = _fixture(spark)
    items = cf.item_vectors(model)
    users = {r["id"]: list(r["features"]) for r in model.userFactors.collect()}

    rows = pnl.join(codes, "ncodpers").select("ncodpers", "fecha_dato", "user_code", "owned")
    got = cf.top1(rows, model).collect()
    assert got
    for r in got:
        if r["user_code"] not in users:
            assert r[cf.FEATURE] is None
            continue
        scores = _brute_scores(users[r["user_code"]], items, set(r["owned"] or []))
        if not scores:
            assert r[cf.FEATURE] is None
            continue
        _assert_ranked([r[cf.FEATURE]], scores, 1)
        assert abs(r["recommended_score"] - scores[int(r[cf.FEATURE][5:])]) <= 1e-9

    inter = cf.interactions(ev, codes).select("user_code", "item")
    hist = {}
    for r in inter.collect():
        hist.setdefault(r["user_code"], set()).add(r["item"])
    lists = cf.topk_lists(codes.select("ncodpers", "user_code"), model, inter, 5).collect()
    assert lists
    for r in lists:
        scores = _brute_scores(users[r["user_code"]], items, hist.get(r["user_code"], set()))
        _assert_ranked(list(r["recommended"]), scores, 5)


def test_scoring_plan_has_no_cross_join(spark):
    pnl, _, codes, model = _fixture(spark)
    rows = pnl.join(codes, "ncodpers").select("ncodpers", "fecha_dato", "user_code", "owned")
    plan = cf.top1(rows, model)._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_all_products_owned_gives_null(spark):
    _, _, _, model = _fixture(spark)
    items = cf.item_vectors(model)
    uf = model.userFactors.limit(1).select(F.col("id").alias("user_code"))
    rows = uf.select("user_code", F.array(*[F.lit(c) for c in items]).alias("owned"))
    r = cf.top1(rows, model).collect()[0]
    assert r[cf.FEATURE] is None and r["recommended_score"] is None
