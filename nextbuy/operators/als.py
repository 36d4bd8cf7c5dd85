"""Implicit-feedback ALS for catalogues of tens of items and any number of users (survey family D).

Per user u the model minimises  sum_i w_ui (p_ui - x_u . y_i)^2 + reg |x_u|^2
with p = 1 and w = the purchase count where there is a history, p = 0 and w = 1
elsewhere; items likewise.  As items are few, everything is done in item space:

* a user's factors are ``Y^T z`` with ``z = (Y Y^T + reg W_u^-1)^-1 p_u``, an
  m x m system whatever the rank, solved for a batch of users at once;
* an item's half-step needs only m x m sums over the users, which every task
  adds up for its own rows (``Z^T Z``, and per item the sums weighted by what
  exceeds one purchase).  No task holds the ratings of an item, user factors
  are never stored or shuffled, and an iteration is one pass over the history
  rows plus a two-level sum of one small row per task.

Several histories (one per snapshot of the walk-forward feature) are fitted
side by side: the same pass serves all of them, so a run costs as many Spark
jobs as iterations, not iterations times snapshots.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, spread

RANK, ITERATIONS, REG = 50, 50, 0.05
#: Users whose systems are solved together, and largest catalogue for which the m^3 sums of a task stay small.
CHUNK = 4096
MOST_ITEMS = 128
#: Bytes of a stored block of users: Spark's readers and Arrow batches hold blocks by number (4,096 and 10,000), whatever their size.
BLOCK_BYTES = 1 << 12
#: Rows multiplied at once: larger products start BLAS threads, which slow each other down where every core has a task already.
SLICE = 128
#: Tasks whose sums are added up at once; those of more are added in two levels.
MOST_SUMS = 128


def histories(events: DataFrame, starts: list[_dt.date], items: list[int], inclusive: bool = False) -> DataFrame:
    """(seg, ncodpers, counts): purchases per item strictly before (``inclusive``: up to) each segment's start; clients without any are left out.

    A purchase counts from the first segment that starts later on.  Rows are
    counted per client, first segment and item, and a task adds these up along
    the segments: a purchase is shuffled once, whatever the number of segments.
    """
    if len(items) > MOST_ITEMS:
        raise ValueError(f"{len(items)} items: this solver is for catalogues up to {MOST_ITEMS}")
    order = sorted(range(len(starts)), key=lambda i: starts[i])
    m, day = len(items), F.col("fecha_dato")
    past = sum((F.when((day > F.lit(starts[i])) if inclusive else (day >= F.lit(starts[i])), 1).otherwise(0) for i in order), F.lit(0))
    place = F.array_position(F.array(*[F.lit(c) for c in items]).cast("array<int>"), F.col("purchase").cast("int")) - 1
    cells = events.filter(day.isNotNull()).select("ncodpers", past.alias("first"), place.cast("int").alias("place")) \
        .filter((F.col("place") >= 0) & (F.col("first") < len(starts))).select("ncodpers", (F.col("first") * m + F.col("place")).alias("cell"))
    # Both sums below are by client, so that they need one exchange; a client has at most a cell per segment and item.
    counted = spread(cells, "ncodpers").groupBy("ncodpers", "cell").agg(F.count(F.lit(1)).alias("n"))
    lists = counted.groupBy("ncodpers").agg(F.collect_list("cell").alias("cells"), F.collect_list("n").alias("ns"))
    client = events.schema["ncodpers"].dataType.simpleString()
    return lists.mapInArrow(_along_segments(order, m), f"seg int, ncodpers {client}, counts array<float>")


def _along_segments(order: list[int], m: int) -> Callable:
    """The clients' cells added up along the segments; ``order`` has the segments by their starts."""
    k, names = len(order), np.array(order, dtype=np.int32)
    chunk = max(1, CHUNK * 8 // max(k, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, chunk):
                batch = whole.slice(a, chunk)
                cells = batch.column(1)
                at = np.repeat(np.arange(batch.num_rows), pc.list_value_length(cells).to_numpy(zero_copy_only=False)) * (k * m)
                every = np.bincount(at + cells.flatten().to_numpy(zero_copy_only=False), batch.column(2).flatten().to_numpy(zero_copy_only=False),
                                    batch.num_rows * k * m).reshape(-1, k, m).cumsum(axis=1)
                who, seg = np.nonzero(every.any(axis=2))
                counts = every[who, seg].astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[seg]), batch.column(0).take(pa.array(who)),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(who) + 1, dtype=np.int32) * m), pa.array(counts.ravel()))],
                    names=["seg", "ncodpers", "counts"])

    return run


def _counts(column: pa.Array, m: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, m).astype(np.float64)


def _sliced(a: np.ndarray) -> np.ndarray:
    """Rows in slices of ``SLICE``, the last filled up with zeros."""
    rest = -len(a) % SLICE
    return (np.concatenate([a, np.zeros((rest, a.shape[1]))]) if rest else a).reshape(-1, SLICE, a.shape[1])


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` slice by slice."""
    return np.matmul(_sliced(a), b).reshape(-1, b.shape[1])[:len(a)]


def _cross(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` slice by slice."""
    return np.matmul(_sliced(a).transpose(0, 2, 1), _sliced(b)).sum(axis=0)


def user_weights(gram: np.ndarray, counts: np.ndarray, reg: float) -> np.ndarray:
    """z of each user (rows of ``counts``): the user's factors are Y^T z, the scores of the items ``gram`` z.

    The systems differ from ``gram + reg`` only at the items bought more than
    once, so each is solved by a correction of that many rows and columns of
    the one common inverse (Woodbury), users with equally many together.
    """
    seen = counts > 0
    inverse = np.linalg.inv(gram + reg * np.eye(len(gram)))
    z = _times(seen.astype(np.float64), inverse)
    other = seen & (counts != 1)
    sizes = other.sum(axis=1)
    order = np.argsort(sizes, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
        if not len(rows) or not reg or not sizes[rows[0]]:
            continue
        at = np.nonzero(other[rows])[1].reshape(len(rows), -1)
        n = counts[rows[:, None], at]
        small = inverse[at[:, :, None], at[:, None, :]]
        d = np.arange(at.shape[1])
        small[:, d, d] += n / (reg * (1 - n))
        part = np.zeros((len(rows), len(gram)))
        np.put_along_axis(part, at, np.linalg.solve(small, z[rows[:, None], at][:, :, None])[:, :, 0], axis=1)
        z[rows] -= _times(part, inverse)
    return z


def _packing(m: int) -> Callable:
    """Rows of (seg, counts) as blocks of users of one segment, a byte a count where counts are small: the iterations read byte strings
    instead of lists.  Blocks have up to ``BLOCK_BYTES`` (a user's counts at least)."""
    users, wide = max(1, BLOCK_BYTES // m), max(1, BLOCK_BYTES // (4 * m))

    def blocks(s: int, c: np.ndarray, rest: bool) -> tuple[list[tuple], np.ndarray]:
        full, out = len(c) if rest else len(c) // users * users, []
        small = np.clip(c, 0, 255).astype(np.uint8)
        for a in range(0, full, users):
            b = min(a + users, full)
            if (small[a:b] == c[a:b]).all():
                out.append((s, 1, small[a:b].tobytes()))
            else:
                out += [(s, 4, c[i:min(i + wide, b)].tobytes()) for i in range(a, b, wide)]
        return out, c[full:]

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))],
                                          names=["seg", "width", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            segs, every, out = batch.column(0).to_numpy(), _counts(batch.column(1), m).astype(np.float32), []
            for s in map(int, np.unique(segs)):
                mine = every[segs == s]
                found, held[s] = blocks(s, np.concatenate([held[s], mine]) if s in held else mine, False)
                out += found
            yield batch_of(out)
        yield batch_of([x for s, c in held.items() for x in blocks(s, c, True)[0]])

    return run


def _unpacked(batches: Iterator[pa.RecordBatch], m: int) -> Iterator[tuple[int, np.ndarray]]:
    """(segment, counts) of up to ``CHUNK`` users from packed blocks."""
    held: dict[int, list[np.ndarray]] = {}
    sizes: dict[int, int] = {}
    for batch in batches:
        for s, width, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            c = np.frombuffer(block.as_buffer(), np.uint8 if width == 1 else np.float32).reshape(-1, m)
            if s in held and sizes[s] + len(c) > CHUNK:
                yield s, np.concatenate(held.pop(s)).astype(np.float64)
                sizes[s] = 0
            held.setdefault(s, []).append(c.copy())  # the batch's memory need not stay for a segment's last blocks
            sizes[s] = sizes.get(s, 0) + len(c)
    for s, some in held.items():
        yield s, np.concatenate(some).astype(np.float64)


def _summing(grams: np.ndarray, reg: float) -> Callable:
    """Per task and segment one row: Z^T Z, the items' excess sums and Z^T C, laid end to end."""
    m = grams.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for s, c in _unpacked(batches, m):
            z = user_weights(grams[s], c, reg)
            out = total.setdefault(s, np.zeros(2 * m * m + m ** 3))
            out[:m * m] += _cross(z, z).ravel()
            extra = np.maximum(c - 1, 0)
            excess = out[m * m:m * m + m ** 3].reshape(m, m, m)
            for i in np.flatnonzero(extra.any(axis=0)):
                some = np.flatnonzero(extra[:, i])
                mine = z[some]
                excess[i] += _cross(mine * extra[some, i][:, None], mine)
            out[m * m + m ** 3:] += _cross(z, c).ravel()
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()), pa.array(np.arange(len(total)) % 16, pa.int32()),
                 pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["seg", "part", "sums"])

    return run


def _added(table: pa.Table) -> pa.Table:
    total = None
    for raw in table.column("sums"):
        x = np.frombuffer(raw.as_py())
        total = x.copy() if total is None else total + x
    return pa.table({"seg": table.column("seg")[:1], "sums": pa.array([total.tobytes()], pa.binary())})


@dataclass
class Factors:
    """Fitted item factors of each segment: ``y[seg]`` has a row per item of ``items``."""

    items: list[int]
    y: np.ndarray
    reg: float

    def grams(self) -> np.ndarray:
        return self.y @ self.y.transpose(0, 2, 1)


def start(items: list[int], rank: int, seed: int) -> np.ndarray:
    """Initial item factors; an item's do not depend on which other items there are."""
    return np.array([np.random.default_rng([seed, abs(c)]).random(rank) * 0.01 for c in items]).reshape(len(items), rank)


def fit(history: DataFrame, segments: int, items: list[int], rank: int = RANK, iterations: int = ITERATIONS, reg: float = REG, seed: int = 0) -> Factors:
    """D3: factors of each segment of ``history`` (seg, counts).  All segments start from the same seeded factors.

    Items that nobody bought in a segment, and all items of a segment without
    rows, have zero factors from the start: what is bought later leaves no trace.
    """
    m = len(items)
    rows = history.select("seg", "counts")
    bought = np.zeros((segments, m, 1))
    for r in rows.groupBy("seg").agg(F.array(*[F.sum(F.col("counts")[i]) for i in range(m)]).alias("n")).collect():
        bought[r["seg"], :, 0] = np.array(r["n"]) > 0
    y = start(items, rank, seed) * bought
    blocks = materialize(rows.mapInArrow(_packing(m), "seg int, width int, block binary"), "als-blocks")
    tasks = blocks.rdd.getNumPartitions()
    for _ in range(iterations):
        grams = y @ y.transpose(0, 2, 1)
        level = blocks.mapInArrow(_summing(grams, reg), "seg int, part int, sums binary")
        if tasks > MOST_SUMS:
            level = level.withColumn("part", F.spark_partition_id() % 64).groupBy("seg", "part").applyInArrow(_added, "seg int, sums binary")
        sums = {r["seg"]: np.frombuffer(r["sums"]) for r in level.groupBy("seg").applyInArrow(_added, "seg int, sums binary").collect()}
        new = np.zeros_like(y)
        for s, flat in sums.items():
            zz, excess, zc = flat[:m * m].reshape(m, m), flat[m * m:m * m + m ** 3].reshape(m, m, m), flat[m * m + m ** 3:].reshape(m, m)
            for i in range(m):
                new[s, i] = np.linalg.solve(y[s].T @ (zz + excess[i]) @ y[s] + reg * np.eye(rank), y[s].T @ zc[:, i])
        y = new
    return Factors(list(items), y, reg)


def _ranking(factors: Factors, k: int, exclude: int, seg: int, counts: int) -> Callable:
    """Adds the best ``k`` items of each row that its exclusion list lacks; equal scores go to the earlier item.  No history: null."""
    grams, codes = factors.grams(), np.array(factors.items)
    m = len(codes)
    place = np.full(codes.max(initial=0) + 2, -1)
    place[codes] = np.arange(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(a, CHUNK)
                known = np.flatnonzero(batch.column(counts).is_valid().to_numpy(zero_copy_only=False))
                c = _counts(batch.column(counts).take(pa.array(known)), m)
                segs = batch.column(seg).to_numpy(zero_copy_only=False)[known].astype(int)
                scores = np.empty((len(known), m))
                for s in np.unique(segs):
                    mine = segs == s
                    scores[mine] = _times(user_weights(grams[s], c[mine], factors.reg), grams[s])
                out = batch.column(exclude).take(pa.array(known))
                lengths = pc.fill_null(pc.list_value_length(out), 0).to_numpy(zero_copy_only=False)
                flat = pc.fill_null(out.flatten(), -1).to_numpy(zero_copy_only=False).astype(int)
                at = place[np.where((flat >= 0) & (flat < len(place)), flat, -1)]
                row = np.repeat(np.arange(len(known)), lengths)
                scores[row[at >= 0], at[at >= 0]] = -np.inf
                order = np.argmax(scores, axis=1)[:, None] if k == 1 and m else np.argsort(-scores, axis=1, kind="stable")[:, :k]
                best = np.take_along_axis(scores, order, axis=1)
                live = np.isfinite(best)
                held = np.zeros(batch.num_rows, dtype=np.int64)
                held[known] = live.sum(axis=1)
                missing = np.ones(batch.num_rows + 1, dtype=bool)
                missing[known] = missing[-1] = False
                found = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(held)).astype(np.int32), mask=missing),
                    pa.StructArray.from_arrays([pa.array(codes[order][live].astype(np.int32)), pa.array(best[live])], names=["code", "score"]))
                yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "ranked"])

    return run


def rank_items(rows: DataFrame, factors: Factors, exclude: str, k: int) -> DataFrame:
    """Adds ``ranked`` (array of code, score) to rows with ``seg``, ``counts`` and the column ``exclude`` of item codes.

    The rows stay in their partitions; only the factors travel.
    """
    names = rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(_ranking(factors, k, names.index(exclude), names.index("seg"), names.index("counts")),
                           schema + ", ranked array<struct<code: int, score: double>>")


def item_table(spark, factors: Factors) -> DataFrame:
    """(seg, item, features)."""
    return spark.createDataFrame([(s, c, [float(v) for v in factors.y[s, i]]) for s in range(len(factors.y)) for i, c in enumerate(factors.items)],
                                 "seg int, item int, features array<double>")


def written(history: DataFrame) -> DataFrame:
    """Histories as a table, which every iteration reads."""
    return materialize(history, "als-history")
