"""ALS for small catalogues: against the textbook solver, its ranking, and no look-ahead in the walk-forward feature."""
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from nextbuy.operators import als, cf

DAY = [dt.date(2020, m, 1) for m in range(1, 8)]


def plain_als(counts, y, reg, iterations):
    """Alternating least squares with the full systems in factor space; returns user and item factors."""
    n, m = counts.shape
    rank = y.shape[1]

    def half(c, other):
        out = np.zeros((len(c), rank))
        gram = other.T @ other + reg * np.eye(rank)
        for u, row in enumerate(c):
            a, b = gram.copy(), np.zeros(rank)
            for i in np.flatnonzero(row):
                a += (row[i] - 1) * np.outer(other[i], other[i])
                b += row[i] * other[i]
            out[u] = np.linalg.solve(a, b)
        return out

    for _ in range(iterations):
        x = half(counts, y)
        y = half(counts.T, x)
    return half(counts, y), y


def purchases(seed=1, clients=60):
    r = random.Random(seed)
    return [(c, r.choice(DAY[:6]), r.choice([1, 1, 1, 2, 3, 5, 9])) for c in range(clients) for _ in range(r.randint(1, 7))]


def frame(spark, rows):
    return spark.createDataFrame(rows, "ncodpers long, fecha_dato date, purchase int").repartition(5)


def matrix(rows, items, keep):
    clients = sorted({c for c, d, _ in rows if keep(d)})
    out = np.zeros((len(clients), len(items)))
    for c, d, p in rows:
        if keep(d):
            out[clients.index(c), items.index(p)] += 1
    return clients, out


def test_histories(spark):
    rows = purchases()
    items = [1, 2, 3, 5, 9]
    got = {(r["seg"], r["ncodpers"]): list(r["counts"]) for r in als.histories(frame(spark, rows), DAY[2:5], items).collect()}
    for s, start in enumerate(DAY[2:5]):
        clients, counts = matrix(rows, items, lambda d, start=start: d < start)
        assert {c for k, c in got if k == s} == set(clients)
        for c, row in zip(clients, counts, strict=True):
            assert got[(s, c)] == row.tolist()


@pytest.mark.parametrize("rank", [2, 8])
def test_fit_equals_the_full_systems(spark, rank):
    rows, items = purchases(), [1, 2, 3, 5, 9]
    df = frame(spark, rows)
    assert cf.catalogue(df) == items
    found = als.fit(als.written(als.histories(df, DAY[3:5], items)), 2, items, rank=rank, iterations=4)
    start = als.start(items, rank, 0)
    for s, day in enumerate(DAY[3:5]):
        _, counts = matrix(rows, items, lambda d, day=day: d < day)
        x, y = plain_als(counts, start, als.REG, 4)
        assert np.allclose(found.y[s], y, rtol=1e-6, atol=1e-9)
        z = als.user_weights(y @ y.T, counts, als.REG)
        assert np.allclose(z @ y, x, rtol=1e-6, atol=1e-9)


def test_ranking(spark):
    rows, items = purchases(), [1, 2, 3, 5, 9]
    history = als.written(als.histories(frame(spark, rows), [DAY[6]], items))
    factors = als.fit(history, 1, items, rank=4, iterations=3)
    r = random.Random(2)
    asked = [(c, r.sample([1, 2, 3, 5, 9, 77, -4, 0], r.randint(0, 7))) for c in range(70)] + [(3, None), (4, items)]
    df = spark.createDataFrame(asked, "ncodpers long, owned array<int>").join(history, "ncodpers", "left").withColumn("seg", F.lit(0))
    clients, counts = matrix(rows, items, lambda d: True)
    scores = als.user_weights(factors.grams()[0], counts, als.REG) @ factors.grams()[0]
    for row in als.rank_items(df, factors, "owned", 3).collect():
        if row["ncodpers"] not in clients:
            assert row["ranked"] is None
            continue
        mine = scores[clients.index(row["ncodpers"])]
        left = sorted(((-mine[i], c) for i, c in enumerate(items) if c not in (row["owned"] or [])))[:3]
        assert [x["code"] for x in row["ranked"]] == [c for _, c in left]
        assert [x["score"] for x in row["ranked"]] == pytest.approx([-s for s, _ in left], abs=1e-9)


def panel(spark, rows):
    owned = [(c, d, [1] if c % 2 else []) for c in range(60) for d in DAY]
    return spark.createDataFrame(owned, "ncodpers long, fecha_dato date, owned array<int>")


def looked_up(lookup):
    return {(r["ncodpers"], r["snapshot_date"]): (r[cf.FEATURE], r["recommended_score"]) for r in lookup.collect()}


@pytest.mark.parametrize("refit", [1, 3])
def test_no_look_ahead(spark, refit):
    """What happens at or after a snapshot changes nothing at it."""
    rows = purchases()
    cut = DAY[4]
    other = {1: 9, 9: 3, 3: 5, 5: 2, 2: 1}
    changed = [(c, d, p if d < cut else other[p]) for c, d, p in rows] + [(c, DAY[5], 5) for c in range(60)]
    settings = {"refit_every": refit, "rank": 4, "max_iter": 3}
    one = looked_up(cf.walk_forward(panel(spark, rows), frame(spark, rows), **settings))
    # the same catalogue on both sides
    two = looked_up(cf.walk_forward(panel(spark, rows), frame(spark, [*changed, *[(99, DAY[6], p) for p in (1, 2, 3, 5, 9)]]), **settings))
    before = {k for k in one if k[1] <= cut}
    assert before and all(one[k][0] == two[k][0] for k in before)
    assert all((one[k][1] or 0) == pytest.approx(two[k][1] or 0, abs=1e-9) for k in before)
    assert any(one[k] != two[k] for k in one if k[1] > cut) or refit == 3
    assert min(k[1] for k in one) == DAY[1]


def test_no_events_give_no_rows(spark):
    assert cf.walk_forward(panel(spark, []), frame(spark, purchases()).limit(0)).collect() == []


def test_large_catalogue_is_refused(spark):
    with pytest.raises(ValueError, match="catalogues up to"):
        als.histories(frame(spark, purchases()), [DAY[3]], list(range(1000)))


def test_weights_by_common_inverse():
    rng = np.random.default_rng(4)
    y = rng.random((9, 12))
    gram, counts = y @ y.T, rng.poisson(1.2, (als.SLICE + 37, 9)).astype(float)
    counts[0], counts[1], counts[2] = 0, 1, 500
    plain = np.array([np.linalg.solve(gram + np.diag(0.05 / np.where(c > 0, c, 1)), c > 0) for c in counts])
    assert np.allclose(als.user_weights(gram, counts, 0.05), plain, rtol=1e-9, atol=1e-12)
    assert np.allclose(als._cross(counts, plain), counts.T @ plain)


def test_histories_shuffle_a_purchase_once(spark):
    """Purchases are not repeated for the later segments before the exchange."""
    plan = als.histories(frame(spark, purchases()), DAY[2:6], [1, 2, 3, 5, 9])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_rows_of_a_task_do_not_grow(spark):
    from nextbuy.session import spread
    assert spread(spark.range(1000), "id", per_task=100).rdd.getNumPartitions() == 10
    assert spread(spark.range(0), "id").rdd.getNumPartitions() == 1


def test_packed_blocks_are_small_and_whole():
    """Blocks keep their size whatever the number of users, and give back every count, large ones too."""
    import pyarrow as pa
    r = np.random.default_rng(3)
    m, n = 25, 20_000
    counts, segs = r.integers(0, 3, (n, m)).astype(np.float32), r.integers(0, 3, n).astype(np.int32)
    counts[7, 3], counts[11, 0] = 300.0, 2.5

    def batches():
        for a in range(0, n, 3000):
            c = counts[a:a + 3000]
            yield pa.RecordBatch.from_arrays([pa.array(segs[a:a + 3000]), pa.ListArray.from_arrays(
                pa.array(np.arange(len(c) + 1, dtype=np.int32) * m), pa.array(c.ravel()))], names=["seg", "counts"])

    packed = list(als._packing(m)(batches()))
    blocks = [b for x in packed for b in x.column(2).to_pylist()]
    assert max(map(len, blocks)) <= als.BLOCK_BYTES and sum(map(len, blocks)) < 1.1 * n * m
    back = list(als._unpacked(iter(packed), m))
    assert max(len(c) for _, c in back) <= als.CHUNK
    for s in range(3):
        assert np.array_equal(np.concatenate([c for k, c in back if k == s]), counts[segs == s])
