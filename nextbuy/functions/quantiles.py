"""Exact quantiles without holding a column's distinct values in one task.

Spark's exact ``percentile`` keeps a value -> count map in the aggregation
buffer; for a global aggregate the final merge holds every distinct value of
the column in one task (income has as many distinct values as clients).
Here the exact order statistics are found by range refinement instead:

1. one aggregate gives n, min, max;
2. a histogram over ``BUCKETS`` equal-width buckets (partial aggregation,
   at most ``BUCKETS`` rows) locates the bucket holding each needed rank; a
   bucket is a count and its ends, so that the histogram stays small;
3. the (value, count) pairs of just those buckets are read back, unless a
   bucket has one value only - if it holds more than ``MAX_VALUES`` rows it is
   refined again with the same histogram step on its own range.

The interpolation matches Spark's ``percentile``: with pos = p * (n - 1),
result = (ceil(pos) - pos) * v[floor] + (pos - floor(pos)) * v[ceil].
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1 << 16
MAX_VALUES = 100_000


def _valid(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x)


def _kth_values(inside: DataFrame, ranks: list[int], lo: float, hi: float,
                depth: int = 0) -> dict[int, float]:
    """Values at 0-based ranks of column ``_x`` of ``inside`` (valid values in [lo, hi])."""
    if lo == hi:
        return {r: lo for r in ranks}
    width = (hi - lo) / BUCKETS
    b = F.least(F.floor((F.col("_x") - F.lit(lo)) / F.lit(width)), F.lit(BUCKETS - 1)).cast("int")
    hist = {int(r["b"]): (int(r["n"]), float(r["mn"]), float(r["mx"])) for r in
            inside.groupBy(b.alias("b")).agg(F.count(F.lit(1)).alias("n"),
                                             F.min("_x").alias("mn"),
                                             F.max("_x").alias("mx")).collect()}
    where: dict[int, tuple[int, int]] = {}   # rank -> (bucket, rank inside the bucket)
    cum = 0
    pending = sorted(ranks)
    for bk in sorted(hist):
        n = hist[bk][0]
        while pending and pending[0] < cum + n:
            r = pending.pop(0)
            where[r] = (bk, r - cum)
        cum += n
    out: dict[int, float] = {r: hist[bk][1] for r, (bk, _) in where.items() if hist[bk][1] == hist[bk][2]}
    small = sorted({bk for r, (bk, _) in where.items()
                    if r not in out and (hist[bk][0] <= MAX_VALUES or depth >= 6)})
    if small:
        per: dict[int, list[tuple[float, int]]] = {}
        for r in (inside.where(b.isin(small)).groupBy(b.alias("b"), "_x")
                  .agg(F.count(F.lit(1)).alias("n")).collect()):
            per.setdefault(int(r["b"]), []).append((float(r["_x"]), int(r["n"])))
        for rank, (bk, k) in where.items():
            if bk in per:
                acc = 0
                for v, n in sorted(per[bk]):
                    acc += n
                    if k < acc:
                        out[rank] = v
                        break
    for bk in sorted({bk for rank, (bk, _) in where.items() if rank not in out}):  # dense buckets: refined on their own ranges
        _, mn, mx = hist[bk]
        mine = {rank: k for rank, (of, k) in where.items() if of == bk}
        found = _kth_values(inside.where(b == bk), sorted(mine.values()), mn, mx, depth + 1)
        out |= {rank: found[k] for rank, k in mine.items()}
    return out


def exact_quantiles(df: DataFrame, col: str | Column, probs: list[float]) -> list[float | None]:
    """Exact linear-interpolated quantiles of ``col`` (NULL and NaN ignored)."""
    return exact_quantiles_many(df, {"_q": (col, probs)})["_q"]


def exact_quantiles_many(df: DataFrame, specs: dict[str, tuple[str | Column, list[float]]]
                         ) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns with shared passes over ``df``.

    ``specs`` maps a name to (column, probabilities).  One aggregate gives
    n / min / max of every column, one grouped count the bucket histograms
    of all of them (keyed by (column, bucket): at most columns x ``BUCKETS``
    rows), one more the (value, count) pairs of the buckets holding the
    needed ranks.  Dense buckets are refined per column as in the
    single-column path.
    """
    names = list(specs)
    xs = {}
    for name in names:
        col = specs[name][0]
        x = (F.col(col) if isinstance(col, str) else col).cast("double")
        xs[name] = F.when(_valid(x), x)
    st = df.agg(*[a for i, nm in enumerate(names) for a in (
        F.count(xs[nm]).alias(f"n{i}"), F.min(xs[nm]).alias(f"mn{i}"),
        F.max(xs[nm]).alias(f"mx{i}"))]).collect()[0]
    out: dict[str, list[float | None]] = {}
    need: dict[int, tuple[list[int], float, float]] = {}     # column id -> ranks, lo, hi
    positions: dict[int, list[float]] = {}
    for i, nm in enumerate(names):
        n = int(st[f"n{i}"])
        if n == 0:
            out[nm] = [None for _ in specs[nm][1]]
            continue
        positions[i] = [p * (n - 1) for p in specs[nm][1]]
        ranks = sorted({int(math.floor(p)) for p in positions[i]}
                       | {int(math.ceil(p)) for p in positions[i]})
        need[i] = (ranks, float(st[f"mn{i}"]), float(st[f"mx{i}"]))
    vals: dict[int, dict[int, float]] = {}
    spread = {i: v for i, v in need.items() if v[1] != v[2]}
    for i, (ranks, lo, hi) in need.items():
        if lo == hi:
            vals[i] = {r: lo for r in ranks}
    if spread:
        bucket = {i: F.least(F.floor((xs[names[i]] - F.lit(lo)) / F.lit((hi - lo) / BUCKETS)),
                             F.lit(BUCKETS - 1)).cast("int")
                  for i, (_, lo, hi) in spread.items()}
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("c"), bucket[i].alias("b"), xs[names[i]].alias("x"))
            for i in spread])).alias("t")).select("t.c", "t.b", "t.x").where(
            F.col("x").isNotNull())
        hist: dict[int, dict[int, tuple[int, float, float]]] = {}
        for r in long.groupBy("c", "b").agg(
                F.count(F.lit(1)).alias("n"),
                F.min("x").alias("mn"), F.max("x").alias("mx")).collect():
            hist.setdefault(int(r["c"]), {})[int(r["b"])] = (
                int(r["n"]), float(r["mn"]), float(r["mx"]))
        where: dict[int, dict[int, tuple[int, int]]] = {}
        for i, (ranks, _, _) in spread.items():
            cum, pending, where[i] = 0, sorted(ranks), {}
            for bk in sorted(hist[i]):
                n = hist[i][bk][0]
                while pending and pending[0] < cum + n:
                    r = pending.pop(0)
                    where[i][r] = (bk, r - cum)
                cum += n
        single = {i: {bk: hist[i][bk][1] for bk, _ in where[i].values() if hist[i][bk][1] == hist[i][bk][2]} for i in spread}
        small = {i: sorted({bk for bk, _ in where[i].values() if bk not in single[i] and hist[i][bk][0] <= MAX_VALUES})
                 for i in spread}
        cond = None
        for i, bks in small.items():
            if bks:
                c = (F.col("c") == i) & F.col("b").isin(bks)
                cond = c if cond is None else (cond | c)
        per: dict[tuple[int, int], list[tuple[float, int]]] = {}
        if cond is not None:
            for r in (long.where(cond).groupBy("c", "b", "x")
                      .agg(F.count(F.lit(1)).alias("n")).collect()):
                per.setdefault((int(r["c"]), int(r["b"])), []).append((float(r["x"]), int(r["n"])))
        for i in spread:
            vals[i] = {}
            dense: dict[int, dict[int, int]] = {}
            for rank, (bk, k) in where[i].items():
                if bk in single[i]:
                    vals[i][rank] = single[i][bk]
                    continue
                if (i, bk) in per:
                    acc = 0
                    for v, n in sorted(per[(i, bk)]):
                        acc += n
                        if k < acc:
                            vals[i][rank] = v
                            break
                if rank not in vals[i]:
                    dense.setdefault(bk, {})[rank] = k
            for bk, mine in dense.items():   # refined on their own ranges
                _, mn, mx = hist[i][bk]
                inside = long.where((F.col("c") == i) & (F.col("b") == bk)).select(
                    F.col("x").alias("_x"))
                found = _kth_values(inside, sorted(mine.values()), mn, mx, 1)
                vals[i] |= {rank: found[k] for rank, k in mine.items()}
    for i, pos_list in positions.items():
        res = []
        for pos in pos_list:
            f, c = int(math.floor(pos)), int(math.ceil(pos))
            res.append(vals[i][f] if f == c else (c - pos) * vals[i][f] + (pos - f) * vals[i][c])
        out[names[i]] = res
    return out


GROUP_BUCKETS = 1 << 12


def grouped_quantile(df: DataFrame, group: str, col: str, prob: float) -> DataFrame:
    """(group, value): the exact interpolated quantile of ``col`` within each group (as text; NULL groups left out), as a table.

    The same refinement for all groups at once: each round joins every group's
    open range to the rows, counts them in ``GROUP_BUCKETS`` buckets of it and
    keeps the bucket that holds the wanted rank.  A round's rows are partial
    counts, so a group that holds nearly all rows is no task of its own, and
    neither the number of groups nor of values meets a limit.  Ranges narrow by
    a factor of ``GROUP_BUCKETS`` or to a single value.
    """
    from ..session import materialize

    x = F.col(col).cast("double")
    rows = df.select(F.col(group).cast("string").alias("g"), x.alias("x")).filter(F.col("g").isNotNull() & _valid(F.col("x")))
    pos = F.lit(prob) * (F.col("n") - 1)
    state = materialize(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).select(
        "g", pos.alias("pos"), F.explode(F.array_distinct(F.array(F.floor(pos), F.ceil(pos)))).alias("rank"), "lo", "hi").withColumn("left", F.col("rank")), "quantile-state")
    while not state.filter("lo < hi").isEmpty():
        still = state.filter("lo < hi")
        inside = rows.join(still, "g").filter("x >= lo and x <= hi")
        b = F.least(F.floor((F.col("x") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / GROUP_BUCKETS)), F.lit(GROUP_BUCKETS - 1))
        hist = inside.groupBy("g", "pos", "rank", "left", b.alias("b")).agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        upto = F.sum("c").over(Window.partitionBy("g", "rank").orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
        hit = hist.withColumn("upto", upto).filter((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("c") <= F.col("left")))
        state = materialize(state.filter("lo = hi").unionByName(hit.select(
            "g", "pos", "rank", "lo", "hi", (F.col("left") - (F.col("upto") - F.col("c"))).alias("left"))), "quantile-state")
    low, high = F.min_by("lo", "rank"), F.max_by("lo", "rank")
    part = F.max("pos") - F.floor(F.max("pos"))
    value = F.when(part == 0, low).otherwise((F.ceil(F.max("pos")) - F.max("pos")) * low + part * high)
    return state.groupBy(F.col("g").alias(group)).agg(value.alias("value"))
