"""Near duplicates of word-shingle sets by HyperMinHash registers (operator 10).

The set of a text is its distinct shingles of ``width`` words
``[^\\x20\\x09-\\x0D]+``, A-Z folded; a shorter text is one shingle, a text
without words an empty set.  Two texts are linked if 100 * intersection is at
least 100 * ``threshold`` * union.

1. *Sketch*, one narrow pass.  A shingle hash's first bits choose one of
   ``BUCKETS`` buckets; of the smallest remainder in a bucket a 16-bit register
   keeps the leading-zero count (6 bits) and the next 10 mantissa bits.  Empty
   buckets borrow from the first filled one in a fixed random order of their
   own, so small sets keep the Jaccard collision rate.
2. *Classes*: texts of equal sets (a 128-bit sum of their hashes) fall
   together, so copies never meet in a join.  A class has a number of its own;
   classes that share a doc_id are linked through it.
3. *Banding*: ``BANDS`` keys of ``ROWS`` registers.  At similarity 0.75 a pair
   misses every band with probability (1 - 0.75^5)^51 < 1.1e-6.
4. *Stars instead of pairs*: within a band key each class is paired with one
   pivot, the smallest set.  Pairs whose collision-corrected estimate is far
   below the threshold go; the rest are verified on the full sets, and verified
   links are joined to components.
5. *The rest, exactly*: classes of a band key that still lie in different
   components meet again by a prefix filter on their rarest shingles, which
   loses no link, and their full sets are compared block against block.  No
   pair becomes a row there but the links found.

Links inside one component cannot change the result, so none between different
texts is lost but for what banding misses.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from nextbuy.llm.ship import ship
from nextbuy.llm.words import distinct, mix64, split_words, window_hashes
from nextbuy.session import Scratch

WIDTH = 5
THRESHOLD = 75
BUCKETS, BUCKET_BITS = 256, 8
MANTISSA_BITS = 10
ROWS, BANDS = 5, 51
#: A pair is dropped unverified if its estimate is this far below the threshold: over 6 standard deviations at 256 registers.
SLACK = 0.2
#: Shingles of a block of members whose sets are compared within one task.
BLOCK_SHINGLES = 1 << 17

_order = np.random.default_rng(77).permuted(
    np.tile(np.arange(BUCKETS, dtype=np.uint8), (BUCKETS, 1)), axis=1)


def shingle_sets(column: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in row order; empty for null or no words."""
    for words in split_words(column, lower=True):
        every = window_hashes(words.hashes, width)
        for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
            yield distinct(every[a:b - width + 1] if b - a >= width else window_hashes(words.hashes[a:b], max(b - a, 1)))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The HyperMinHash registers of a sorted, non-empty set of 64-bit hashes."""
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    filled = bucket[first]
    rest = hashes[first] << np.uint64(BUCKET_BITS)
    _, exponent = np.frexp((rest >> np.uint64(11)).astype(np.float64))
    zeros = np.minimum(53 - exponent, 53).astype(np.uint64)
    mantissa = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA_BITS)
    out = np.zeros(BUCKETS, np.uint16)
    out[filled] = (zeros << np.uint64(MANTISSA_BITS)) + mantissa
    if len(filled) < BUCKETS:
        empty = np.setdiff1d(np.arange(BUCKETS), filled)
        out[empty] = out[filled[_order[np.ix_(empty, filled)].argmin(axis=1)]]
    return out


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, one, two, regs = [], [], [], []
        for s in shingle_sets(batch.column(1)):
            size.append(len(s))
            one.append(int(s.sum(dtype=np.uint64)) - 2**63)
            two.append(int(mix64(s + np.uint64(0xD1B54A32D192ED03)).sum(dtype=np.uint64)) - 2**63)
            regs.append(registers(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(size, pa.int64()), pa.array(one, pa.int64()),
             pa.array(two, pa.int64()), pa.array(regs, pa.binary())],
            names=["doc_id", "row", "n_shingles", "fp1", "fp2", "registers"])


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, row (the text's hash), n_shingles, 128-bit set fingerprint (fp1, fp2), registers (null for an empty set)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("row")).mapInArrow(
        _sketches, "doc_id long, row long, n_shingles long, fp1 long, fp2 long, registers binary")


def _expected_collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Expected number of registers that two disjoint sets of these sizes share by chance.

    A bucket's minimum lies in the cell (zeros i, mantissa j) with a probability
    read off the exponential law of a minimum; chance collisions are the sum of
    the products over the cells.  Sizes are taken on a grid of powers of 2^(1/4).
    """
    grid = lambda x: np.round(np.log2(np.maximum(x, 1)) * 4).astype(np.int64)
    a, b = grid(n), grid(m)
    keys, inverse = np.unique(np.stack([a, b]), axis=1, return_inverse=True)
    zeros, cells = np.arange(30), np.arange(2**MANTISSA_BITS)
    low = 2.0 ** -(zeros[:, None] + 1.0) * (1 + cells / 2**MANTISSA_BITS)
    high = 2.0 ** -(zeros[:, None] + 1.0) * (1 + (cells + 1) / 2**MANTISSA_BITS)
    chance = {}
    for g in np.unique(keys):
        rate = max(2.0 ** (g / 4) / BUCKETS, 1.0)
        chance[g] = np.exp(-rate * low) - np.exp(-rate * high)
    per = np.array([(chance[x] * chance[y]).sum() * BUCKETS for x, y in keys.T])
    return per[inverse.ravel()]


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the collision-corrected estimate; in: a, b, n_a, n_b, registers_a, registers_b."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, BUCKETS) for k in (4, 5))
        n, m = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
        chance = _expected_collisions(n, m)
        same = (x == y).sum(axis=1)
        jaccard = np.clip((same - chance) / np.maximum(BUCKETS - chance, 1), 0, 1)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(jaccard)], names=["a", "b", "jaccard"])


def estimate(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) with their estimated Jaccard similarity; those that sizes exclude are gone."""
    side = lambda s: classes.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("registers").alias(f"registers_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        (F.col("n_a") * 100 >= F.col("n_b") * THRESHOLD) & (F.col("n_b") * 100 >= F.col("n_a") * THRESHOLD))
    return both.select("a", "b", "n_a", "n_b", "registers_a", "registers_b").mapInArrow(_estimate, "a long, b long, jaccard double")


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among the pairs (a, b, text_a, text_b), on the full shingle sets."""
    for batch in batches:
        keep = [i for i, (s, t) in enumerate(zip(shingle_sets(batch.column(2)), shingle_sets(batch.column(3)), strict=True))
                if 100 * (common := len(np.intersect1d(s, t, assume_unique=True))) >= THRESHOLD * (len(s) + len(t) - common) > 0]
        if keep:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).take(pa.array(keep))


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked; ``texts`` has one row per class (rep, text)."""
    a, b = (texts.select(F.col("rep").alias(s), F.col("text").alias(f"text_{s}")) for s in "ab")
    return pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, component (its smallest reachable node) of the edges (a, b); alternates large and small stars.

    Minima are partial aggregates and neighbours come back by an equi-join, so
    a hub with a third of all edges is no single task.
    """
    edges = scratch.write(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    while True:
        below = edges.groupBy("b").agg(F.count("*").alias("above"))
        if below.filter("above > 1").isEmpty() and edges.select("a").join(below.select(F.col("b").alias("a")), "a", "left_semi").isEmpty():
            return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = scratch.write(both.join(low, "a").filter("b > a").select(F.col("low").alias("a"), "b").filter("a < b").distinct(), "large")
        scratch.drop(edges)
        least = large.groupBy("b").agg(F.min("a").alias("low"))
        stars = large.join(least, "b").select(F.explode(F.array(F.struct(F.col("low").alias("a"), F.col("a").alias("b")), F.struct(F.col("low").alias("a"), "b"))).alias("e"))
        edges = scratch.write(stars.select("e.*").filter("a < b").distinct(), "star")
        scratch.drop(large)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text; other columns are ignored).

    Null or wordless text: n_shingles 0, a component of its own.  Null doc_id:
    component_id null, kept (rows of such texts link nothing).  Rows that
    repeat a doc_id each get a result row; rows of one doc_id whose texts
    differ are told apart by their sets, except that an id that stands for two
    sets joins them, whatever each of them is linked with.  An empty table
    gives an empty result.
    """
    ship(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "op10")
    sketches = scratch.write(sketch(docs), "sketch")
    full = sketches.filter("n_shingles > 0 and doc_id is not null")
    # numbers are written with the classes, so every reader sees the same ones
    classes = scratch.write(
        full.groupBy("fp1", "fp2", "n_shingles").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.first("registers").alias("registers"))
        .select(F.monotonically_increasing_id().alias("rep"), F.col("n_shingles").alias("n"), "fp1", "fp2", "registers",
                F.col("first.doc_id").alias("doc_id"), F.col("first.row").alias("row")), "classes")
    numbers = classes.select("fp1", "fp2", F.col("n").alias("n_shingles"), "rep")
    rows = scratch.write(sketches.drop("registers", "row").join(numbers, ["fp1", "fp2", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("rep")), "rows")
    scratch.drop(sketches)
    several = rows.filter("rep is not null").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("high")).filter("a < high").select("doc_id", "a")
    same_id = scratch.write(rows.filter("rep is not null").join(several, "doc_id").select("a", F.col("rep").alias("b")).filter("a < b").distinct(), "same-id")
    bands = classes.select("rep", "n", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring("registers", i * (2 * ROWS) + 1, F.lit(2 * ROWS))))).alias("band", "key")).select("rep", "n", "key")
    shared = scratch.write(
        bands.groupBy("key").agg(F.min(F.struct("n", "rep")).alias("low"), F.max(F.struct("n", "rep")).alias("high")).filter("low < high")
        .select("key", F.col("low.rep").alias("pivot")), "shared")
    hits = scratch.write(bands.join(shared, "key").select("key", "pivot", "rep"), "hits")
    scratch.drop(shared)
    candidates = scratch.write(
        estimate(hits.filter("pivot <> rep").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct(), classes)
        .filter(F.col("jaccard") >= THRESHOLD / 100 - SLACK).select("a", "b"), "candidates")
    links = scratch.write(verify(candidates, _texts(candidates.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), classes, docs)), "links")
    scratch.drop(candidates)
    found = scratch.write(components(links.union(same_id), scratch), "found")
    # band keys whose classes lie in several components
    own = hits.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = scratch.write(own.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2"), F.count("*").alias("members"))
                          .filter("c1 < c2 and members > 2").select("key"), "mixed")
    loose = scratch.write(own.join(mixed, "key", "left_semi").select("rep", "component").distinct(), "loose")
    scratch.drop(hits, mixed, found)
    members = scratch.write(_texts(loose.select("rep"), classes, docs).join(loose, "rep").select("rep", "component", "text"), "members")
    scratch.drop(loose)
    rest = scratch.write(block_links(rare_meetings(members, scratch)), "rest")
    scratch.drop(members)
    return _result(rows, classes, components(links.union(same_id).union(rest), scratch))


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rep, component, n, shingle: a row per distinct shingle; in: rep, component, text."""
    for batch in batches:
        for i, s in enumerate(shingle_sets(batch.column(2))):
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(batch.column(0)[i], len(s)), pa.repeat(batch.column(1)[i], len(s)), pa.repeat(pa.scalar(len(s), pa.int64()), len(s)),
                 pa.array(s.view(np.int64))], names=["rep", "component", "n", "shingle"])


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rep, component, cluster, block, other, shingles (a sorted set as bytes); in: the same with the text last."""
    for batch in batches:
        sets = pa.array([s.tobytes() for s in shingle_sets(batch.column(5))], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], sets], names=["rep", "component", "cluster", "block", "other", "shingles"])


def _block_links(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Links between the members of two blocks that are in different components: one per member and other component."""
    _, low, high = key
    left, right = (rows[rows.block == x].reset_index(drop=True) for x in (low, high))
    found: list[tuple[int, int]] = []
    sets = [np.frombuffer(x, np.uint64) for x in right.shingles]
    n = np.array([len(s) for s in sets], np.int64)
    if len(left) and len(right):
        every = np.concatenate(sets)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], np.repeat(np.arange(len(sets)), n)[order]
        component, rep = right.component.to_numpy(), right.rep.to_numpy()
        for x, c, raw in zip(left.rep, left.component, left.shingles, strict=True):
            s = np.frombuffer(raw, np.uint64)
            lo, hi = np.searchsorted(every, s), np.searchsorted(every, s, "right")
            size = hi - lo
            at = np.arange(size.sum()) + np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
            common = np.bincount(owner[at], minlength=len(sets))
            hit = np.flatnonzero((100 * common >= THRESHOLD * (len(s) + n - common)) & (component != c))
            _, one = np.unique(component[hit], return_index=True)
            found += [(int(x), int(rep[k])) for k in hit[one]]
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def block_links(members: DataFrame) -> DataFrame:
    """Links (a, b) between different components, of ``members`` (rep, component, cluster, n, text), on full sets.

    A cluster is dealt out in blocks of about ``BLOCK_SHINGLES`` shingles and
    each pair of blocks is one task's work, whatever the size of the cluster.
    """
    blocks = members.groupBy("cluster").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("long").alias("blocks"))
    dealt = members.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks")).select(
        "rep", "component", "cluster", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), "text")
    return dealt.mapInArrow(_set_rows, "rep long, component long, cluster long, block long, other long, shingles binary").groupBy(
        "cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).applyInPandas(_block_links, "a long, b long")


def rare_meetings(members: DataFrame, scratch: Scratch) -> DataFrame:
    """rep, component, cluster, n, text of the ``members`` (rep, component, text) that may still be linked across components.

    With the shingles of a set ranked from rare to frequent, two sets can be
    linked only if they share one among each set's first n - ceil(0.75 n) + 1.
    A passage that many texts share is frequent and comes last, so texts that
    have little else in common never meet.  Shingles that no other member has
    (n - m of them) cannot be common either, which bounds the similarity.
    Members that share such a shingle with another component form a cluster.
    """
    rows = scratch.write(members.mapInArrow(_shingle_rows, "rep long, component long, n long, shingle long"), "shingles")
    # counts are written apart, so that the join splits a shingle that very many sets hold
    spread = scratch.write(rows.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1"), "spread")
    common = rows.join(spread, "shingle")
    most = common.groupBy("rep").agg(F.count("*").alias("m"))
    by_rarity = Window.partitionBy("rep").orderBy("df", "shingle")
    prefix = scratch.write(
        common.join(most, "rep").filter(f"100 * m >= {THRESHOLD} * n").withColumn("k", F.row_number().over(by_rarity))
        .filter(f"k <= m - ceil({THRESHOLD} * n / 100.0) + 1").select("rep", "component", "n", "m", "shingle"), "prefix")
    scratch.drop(rows, spread)
    smallest = scratch.write(prefix.groupBy("shingle").agg(F.min("n").alias("n_min")), "smallest")
    prefix = prefix.join(smallest, "shingle").filter(f"(100 + {THRESHOLD}) * m >= {THRESHOLD} * (n + greatest(n_min, m))")
    mixed = scratch.write(prefix.groupBy("shingle").agg(F.min("component").alias("c1"), F.max("component").alias("c2"), F.min("rep").alias("hub"))
                          .filter("c1 < c2").select("shingle", "hub"), "meeting")
    met = scratch.write(prefix.join(mixed, "shingle").select("rep", "hub", "n").distinct(), "met")
    clusters = components(met.select(F.col("hub").alias("a"), F.col("rep").alias("b")), scratch)
    return members.join(met.select("rep", "n").distinct(), "rep").join(clusters.select(F.col("node").alias("rep"), F.col("component").alias("cluster")), "rep")


def _texts(reps: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """rep, text of the named classes: the text of each one's first row."""
    place = classes.select("rep", "doc_id", "row").join(reps, "rep", "left_semi")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text").join(place, ["doc_id", "row"]).groupBy(
        "rep").agg(F.first("text").alias("text"))


def _result(rows: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """The smallest doc_id of each component comes back to its rows."""
    of = classes.select("rep", "doc_id").join(found, F.col("rep") == F.col("node"), "left").select("rep", "doc_id", F.coalesce("component", "rep").alias("component"))
    lowest = of.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = of.select("rep", "component").join(lowest, "component").select("rep", "component_id")
    return rows.join(named, "rep", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
