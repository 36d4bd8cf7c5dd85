"""Removal of byte strings that an earlier document already holds, by suffix sorting (operator 11).

A byte of a text goes if a string of ``WINDOW`` bytes covers it that also
starts in a document with a smaller id.  Windows are judged on the input.

1. *Pieces*, one narrow pass.  Every window has a seed, the smallest hash among
   its ``SEED``-byte substrings; consecutive windows of one seed form a piece
   (about 65 bytes for 16 windows).  Equal windows have equal seeds wherever
   they lie, so a seed names the suffix bucket.
2. *Shared seeds*: pieces whose seed occurs in one document only cannot hold a
   repeat; they go.  Copies of a piece fall together: what a later document
   holds of a piece goes whole, and the first holder's piece is sorted, unless
   its seed has no other piece that it could be compared with.
3. *Buckets*: the texts of the remaining pieces are shuffled by seed, and a task
   sorts one bucket at a time.  It ranks the suffixes at the positions of a
   difference cover (period 31, 6 residues) first, then takes the suffixes
   block by block, sorts a block by 32-byte prefixes, and settles the ties by
   the ranks: any two positions reach sampled ones at a common distance below
   31.  Memory is the bucket's text, a rank for a fifth of its bytes, and one block.
4. Neighbours in the order that agree in ``WINDOW`` bytes are one string; its
   smallest document keeps it.

A seed with more than ``HOT_PIECES`` different pieces (a common word sequence in
ever new surroundings) has no bucket of its own: its windows are grouped by
content instead, with partial aggregates, which is exact as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from nextbuy.llm.ship import ship
from nextbuy.llm.words import mix64, text_bytes
from nextbuy.session import Scratch

WINDOW = 50
SEED = 20
SPAN = WINDOW - SEED + 1
#: Window starts that are looked at together: the block's arrays stay in a core's cache.
BLOCK_STARTS = 1 << 16
#: Pieces that are handed to Spark together, at least.
BATCH_PIECES = 1 << 16
#: Bytes of piece text of a bucket, suffixes of a block.
BUCKET_BYTES = 4 << 20
BLOCK_SUFFIXES = 1 << 18
#: Shares of the seeds that are worked off one after the other, which halves what lies on disk at a time.
PASSES = 2
#: Different pieces of a seed beyond which its windows are grouped instead of sorted.
HOT_PIECES = 1 << 14

#: A perfect difference set: every distance modulo 31 is a difference of two of these residues.
PERIOD = 31
COVER = np.array([1, 5, 11, 24, 25, 27])
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: _REACH[a, b]: the smallest step that takes residues a and b into the cover together.
_REACH = np.array([[next(d for d in range(PERIOD) if _IN_COVER[(a + d) % PERIOD] and _IN_COVER[(b + d) % PERIOD])
                    for b in range(PERIOD)] for a in range(PERIOD)])

_rng = np.random.default_rng(1150)
_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _K1, _K2 = (int(x) * 2 + 1 for x in _rng.integers(1, 2**62, 3))


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def _rolling(data: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the substrings of 2, 16 and ``SEED`` bytes, by first byte, and a free array, all in the four rows of ``room``."""
    n = len(data)
    h = {1: _CODE.take(data, out=room[0, :n], mode="clip")}
    for done, row in ((1, 1), (2, 2), (4, 3), (8, 0)):
        n -= done
        h[2 * done] = np.multiply(h[done][:n], _power(done), out=room[row, :n])
        h[2 * done] += h[done][done:]
    n = len(data) - SEED + 1
    seeds = np.multiply(h[16][:n], _power(4), out=room[3, :n])
    seeds += h[4][16:16 + n]
    return h[2], h[16], seeds, room[2, :n]


def _window_hash(h2: np.ndarray, h16: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of the windows of 50 = 16 + 16 + 16 + 2 bytes that start at ``at``."""
    h = h16[at] * _power(16) + h16[at + 16]
    h = h * _power(16) + h16[at + 32]
    return h * _power(2) + h2[at + 48]


def _smallest(values: np.ndarray, free: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values; both arrays are written over."""
    done, n = 1, len(values)
    while done < width:
        step = min(done, width - done)
        n -= step
        values, free = np.minimum(values[:n], values[step:n + step], out=free[:n]), values
        done += step
    return values


def _whole_windows(offsets: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """For the starts from ``lo`` below ``hi``: is there a window, which the last 49 bytes of a text have not?"""
    a, b = np.searchsorted(offsets, lo, "right"), np.searchsorted(offsets, hi + WINDOW, "right")
    first = np.clip(np.maximum(offsets[a:b] - WINDOW + 1, offsets[a - 1:b - 1]) - lo, 0, hi - lo)
    length = np.clip(offsets[a:b] - lo, 0, hi - lo) - first
    good = np.ones(hi - lo, bool)
    good[np.arange(int(length.sum())) + np.repeat(first - np.cumsum(length) + length, length)] = False
    return good


def pieces_of(data: np.ndarray, offsets: np.ndarray, share: int | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """(text index, first window, windows, seed, content hash) of the pieces of a column, or of a share of the seeds, block by block."""
    end = int(offsets[-1])
    # arrays of this size that come and go are given back to the system and cleared anew each time
    room = np.empty((4, min(BLOCK_STARTS + WINDOW, max(end - int(offsets[0]), 1))), np.uint64)
    for lo in range(int(offsets[0]), end - WINDOW + 1, BLOCK_STARTS):
        hi = min(lo + BLOCK_STARTS, end - WINDOW + 1)
        h2, h16, seeds, free = _rolling(data[lo:hi + WINDOW - 1], room)
        low = _smallest(mix64(seeds), free, SPAN)
        n = hi - lo
        good = _whole_windows(offsets, lo, hi)
        change = np.ones(n + 1, bool)
        change[1:n] = low[1:] != low[:-1]
        edge = np.concatenate([[False], good, [False]])
        first = np.flatnonzero(good & (change[:n] | ~edge[:n]))
        last = np.flatnonzero(good & (change[1:] | ~edge[2:]))
        if share is not None:
            # the seed's last bits: its first ones are small, being a minimum's
            mine = low[first] % np.uint64(PASSES) == share
            first, last = first[mine], last[mine]
        runs = last - first + 1
        cuts = (runs + SPAN - 1) // SPAN
        step = np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        start = np.repeat(first, cuts) + SPAN * step
        run = np.minimum(np.repeat(last, cuts) - start + 1, SPAN)
        content = mix64(mix64(_window_hash(h2, h16, start) + np.uint64(_K1)) + _window_hash(h2, h16, start + run - 1) * np.uint64(_K2)
                        + run.astype(np.uint64))
        a, b = np.searchsorted(offsets, [lo, hi], "right")
        text = np.repeat(np.arange(a - 1, b), np.diff(np.searchsorted(start, offsets[a:b] - lo), prepend=0, append=len(start)))
        yield text, start + lo - offsets[text], run, low[start].view(np.int64), content.view(np.int64)


_PIECES = {"doc": "long", "row": "long", "pos": "long", "run": "int", "seed": "long", "content": "long"}


def _gathered(found: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """The pieces of several blocks together."""
    held, n = [], 0
    for block in found:
        held.append(block)
        n += len(block[0])
        if n >= BATCH_PIECES:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))
            held, n = [], 0
    if n:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def _pieces(docs: DataFrame, share: int, *names: str) -> DataFrame:
    """These columns of the pieces whose seeds fall to one of ``PASSES`` shares."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, pos, runs, seed, content in _gathered(pieces_of(*text_bytes(batch.column(2)), share)):
                at = pa.array(text)
                made = {"doc": lambda: batch.column(0).take(at), "row": lambda: batch.column(1).take(at), "pos": lambda: pa.array(pos),
                        "run": lambda: pa.array(runs.astype(np.int32)), "seed": lambda: pa.array(seed), "content": lambda: pa.array(content)}
                yield pa.RecordBatch.from_arrays([made[k]() for k in names], names=list(names))

    return docs.filter("doc is not null").select("doc", "row", "text").mapInArrow(run, ", ".join(f"{k} {_PIECES[k]}" for k in names))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of the listed pieces; a hot one window by window.  In: doc, row, text, pieces (pos, run, seed, hot)."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(2))
        lists = batch.column(3)
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        flat = lists.flatten()
        pos, run, seed, hot = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("pos", "run", "seed", "hot"))
        owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        times = np.where(hot, run, 1)
        step = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        owner, pos, seed, hot, run = (np.repeat(x, times) for x in (owner, pos + 0, seed, hot, run))
        pos, run = pos + step, np.where(hot, 1, run)
        for a in range(0, len(pos), 1 << 16):
            s = slice(a, a + (1 << 16))
            begin, length = offsets[owner[s]] + pos[s], run[s].astype(np.int64) + WINDOW - 1
            ends = np.cumsum(length)
            inner = np.arange(int(ends[-1])) - np.repeat(ends - length, length)
            text = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)),
                                                                   pa.py_buffer(data[np.repeat(begin, length) + inner])])
            at = pa.array(owner[s])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(pos[s].astype(np.int64)), pa.array(seed[s]), pa.array(hot[s]), text],
                names=["doc", "row", "pos", "seed", "hot", "piece"])


def _by_prefix(words: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes ``at`` in the order of their first ``depth`` words, and which differ from the one before; each word sorts ties only."""
    order = at[np.argsort(words[at])]
    new = np.ones(len(at), bool)
    w = words[order]
    new[1:] = w[1:] != w[:-1]
    for k in range(1, depth):
        tied = ~new
        tied[:-1] |= ~new[1:]
        active = np.flatnonzero(tied)
        if not len(active):
            break
        mine, group = order[active], np.cumsum(new[active])
        w = words[mine + 8 * k]
        rank = np.empty(len(active), np.int64)
        rank[np.argsort(w)] = np.arange(len(active))
        turn = np.argsort(group * len(active) + rank)
        order[active], w = mine[turn], w[turn]
        new[active[1:]] |= w[1:] != w[:-1]
    return order, new


def cover_ranks(words: np.ndarray, n: int) -> np.ndarray:
    """Ranks of the suffixes at the cover's positions below ``n``, to a depth of 56 bytes; 0 elsewhere."""
    ranked, new = _by_prefix(words, np.flatnonzero(_IN_COVER[np.arange(n) % PERIOD]), 7)
    ranks = np.zeros(n, np.int32)
    ranks[ranked] = np.cumsum(new) - 1
    return ranks


def sort_block(words: np.ndarray, ranks: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The suffixes at ``starts`` in order: by 32-byte prefixes, ties by the cover's ranks (three-way partitions)."""
    order, new = _by_prefix(words, starts, 4)
    group = np.cumsum(new)
    active = np.flatnonzero(np.bincount(group)[group] > 1)
    group = group[active]
    while len(active):
        first = np.flatnonzero(np.diff(group, prepend=-1))
        size = np.diff(np.append(first, len(group)))
        mine = order[active]
        pivot = np.repeat(mine[first + size // 2], size)
        reach = _REACH[mine % PERIOD, pivot % PERIOD]
        side = np.sign(ranks[mine + reach] - ranks[pivot + reach])
        turn = np.lexsort((side, group))
        order[active] = mine[turn]
        side, group = side[turn], group[turn]
        group = np.cumsum(np.append(True, (group[1:] != group[:-1]) | (side[1:] != side[:-1])))
        left = (side != 0) & (np.bincount(group)[group] > 1)
        active, group = active[left], group[left]
    return order


def first_holders(text: np.ndarray, starts: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For the windows at ``starts`` of a bucket's text, held by ``docs``: the smallest document that holds the same bytes."""
    padded = np.concatenate([text, np.zeros(PERIOD + 64, np.uint8)])
    words = padded.astype(np.uint64)
    for shift in (1, 2, 4):
        words = (words[:-shift] << np.uint64(8 * shift)) | words[shift:]
    ranks = cover_ranks(words, len(text) + PERIOD)
    out = np.empty(len(starts), np.int64)
    lead = words[starts]
    sample = np.sort(lead[::max(1, len(lead) // 4096)])
    parts = len(starts) // BLOCK_SUFFIXES + 1
    splitters = np.unique(sample[(len(sample) * np.arange(1, parts)) // parts])
    block = np.searchsorted(splitters, lead, "right")
    number = np.empty(len(text) + 1, np.int64)
    number[starts] = np.arange(len(starts))
    for b in range(len(splitters) + 1):
        mine = starts[block == b]
        if not len(mine):
            continue
        order = sort_block(words, ranks, mine)
        new = np.zeros(len(order), bool)
        new[0] = True
        for k in (0, 8, 16, 24, 32, 40, 42):
            w = words[order + k]
            new[1:] |= w[1:] != w[:-1]
        at, who = np.flatnonzero(new), number[order]
        low = np.minimum.reduceat(docs[who], at)
        out[who] = np.repeat(low, np.diff(np.append(at, len(order))))
    return out


def _bucket_spans(table: pa.Table) -> pa.Table:
    """doc, row, start, stop of what goes from the pieces of one bucket."""
    table = table.combine_chunks()
    doc, row, pos = (table.column(k).to_numpy() for k in ("doc", "row", "pos"))
    piece = table.column("piece")
    piece = piece.chunk(0) if isinstance(piece, pa.ChunkedArray) else piece
    large = piece.cast(pa.large_binary())
    offs = np.frombuffer(large.buffers()[1], np.int64, len(large) + 1 + large.offset)[large.offset:]
    text = np.frombuffer(large.buffers()[2], np.uint8)[offs[0]:offs[-1]]
    offs = offs - offs[0]
    run = np.diff(offs) - WINDOW + 1
    owner = np.repeat(np.arange(len(doc)), run)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(run) - run, run)
    low = first_holders(text, offs[owner] + step, doc[owner])
    gone = np.flatnonzero(low < doc[owner])
    fresh = np.ones(len(gone), bool)
    fresh[1:] = (np.diff(gone) > 1) | (owner[gone[1:]] != owner[gone[:-1]])
    a = gone[fresh]
    b = gone[np.append(fresh[1:], True)] if len(gone) else gone
    return pa.table({"doc": doc[owner[a]], "row": row[owner[a]], "start": pos[owner[a]] + step[a], "stop": pos[owner[b]] + step[b] + WINDOW},
                    schema=pa.schema([(k, pa.int64()) for k in ("doc", "row", "start", "stop")]))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc, row, start, stop: byte ranges (they may overlap) of ``docs`` (doc, row, text) that an earlier document holds."""
    scratch = Scratch(docs.sparkSession, "op11")
    parts = [_share_of_spans(docs, share, scratch) for share in range(PASSES)]
    spans = parts[0]
    for p in parts[1:]:
        spans = spans.union(p)
    return spans


def _share_of_spans(docs: DataFrame, share: int, scratch: Scratch) -> DataFrame:
    shared = scratch.write(
        _pieces(docs, share, "doc", "seed", "content").groupBy("seed").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.min("content").alias("c1"), F.max("content").alias("c2"))
        .filter("low < high").select("seed", "low", (F.col("c1") < F.col("c2")).alias("mixed")), "seeds")
    held = scratch.write(_pieces(docs, share, *_PIECES).join(shared.hint("shuffle_hash"), "seed").filter("mixed or doc > low").drop("low"), "held")
    scratch.drop(shared)
    mixed = held.filter("mixed").drop("mixed")
    firsts = scratch.write(mixed.groupBy("seed", "content").agg(F.min("doc").alias("low")), "firsts")
    known = scratch.write(mixed.join(firsts, ["seed", "content"]).select(
        "doc", "row", "pos", "run", "seed", (F.col("doc") > F.col("low")).alias("copy")), "known")
    scratch.drop(firsts)
    own = known.filter("not copy")
    # written apart, so that the join splits a seed that very many pieces have
    hot = scratch.write(own.groupBy("seed").count().filter(F.col("count") > HOT_PIECES).select("seed", F.lit(True).alias("hot")), "hot")
    lists = own.join(hot, "seed", "left").groupBy("doc", "row").agg(
        F.collect_set(F.struct("pos", "run", "seed", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("pieces"))
    texts = scratch.write(
        docs.join(lists, ["doc", "row"]).select("doc", "row", "text", "pieces")
        .mapInArrow(_cut, "doc long, row long, pos long, seed long, hot boolean, piece binary"), "texts")
    size = texts.filter("not hot").agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    buckets = -(-size // BUCKET_BYTES) or 1
    sorted_spans = texts.filter("not hot").withColumn("bucket", F.pmod(F.xxhash64("seed"), F.lit(buckets))).groupBy("bucket").applyInArrow(
        _bucket_spans, "doc long, row long, start long, stop long")
    windows = texts.filter("hot").select("doc", "row", "pos", "piece")
    hot_spans = windows.join(windows.groupBy("piece").agg(F.min("doc").alias("low")), "piece").filter("doc > low").select(
        "doc", "row", F.col("pos").alias("start"), (F.col("pos") + WINDOW).alias("stop"))
    copies = known.filter("copy").drop("copy", "seed").union(held.filter("not mixed").select("doc", "row", "pos", "run")).select("doc", "row", F.col("pos").alias("start"), (F.col("pos") + F.col("run") + (WINDOW - 1)).alias("stop"))
    spans = scratch.write(copies.union(sorted_spans).union(hot_spans), "spans")
    scratch.drop(held, known, hot, texts)
    return spans


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In: doc_id, text, spans.  Out: doc_id, n_bytes, spans (merged: maximal runs of overlapping or touching ranges), kept."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
        found = batch.column(2).flatten()
        owner = np.repeat(np.arange(len(batch)), batch.column(2).value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        start, stop = (found.field(k).to_numpy() + offsets[owner] for k in ("start", "stop"))
        order = np.argsort(start, kind="stable")
        owner, start, stop = owner[order], start[order], np.maximum.accumulate(stop[order])
        new = np.ones(len(order) + 1, bool)
        new[1:-1] = (start[1:] > stop[:-1]) | (owner[1:] != owner[:-1])
        owner, start, stop = owner[new[:-1]], start[new[:-1]], stop[new[1:]]
        depth = np.zeros(len(data) + 1, np.int8)
        depth[start] += 1
        depth[stop] -= 1
        gone = np.bincount(owner, stop - start, len(batch)).astype(np.int64)
        bounds = np.append(0, np.cumsum(np.bincount(owner, minlength=len(batch)))).astype(np.int32)
        spans = pa.StructArray.from_arrays([pa.array(start - offsets[owner]), pa.array(stop - offsets[owner])], ["start", "stop"])
        kept = data[np.cumsum(depth[:-1], dtype=np.int8) == 0]
        ends = np.append(0, np.cumsum(np.diff(offsets) - gone))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(bounds, spans),
             pa.Array.from_buffers(pa.large_binary(), len(batch), [None, pa.py_buffer(ends), pa.py_buffer(kept)]).cast(pa.binary())],
            names=["doc_id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans, kept for each row of ``docs`` (doc_id, text; other columns are ignored).

    ``spans`` are the maximal removed byte ranges, ``kept`` the other bytes in
    order (binary, as a cut may fall inside a character).  Null or empty text:
    nothing to remove.  Texts under ``WINDOW`` bytes stay whole.  Null doc_id:
    the row neither removes nor loses anything.  Rows that repeat a doc_id each
    get a result row and remove nothing from one another; rows of different
    texts under one id are told apart by the text's hash.  An empty table gives
    an empty result.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("row"), "text")
    spans = repeated_spans(rows).groupBy("doc", "row").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return rows.join(spans, ["doc", "row"], "left").select("doc", "text", "spans").mapInArrow(
        _kept, "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")
