"""Phrase collocations by dynamic itemset counting (operator 12).

Texts, with A-Z folded, fall into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces
into words ``[^\\x20\\x09]+``.  Phrases of up to three words of one piece are
counted per language.

The corpus is dealt into ``SHARDS`` shards that are scanned in a cycle.  Words
are counted from the first scan on.  A longer phrase becomes active in the scan
after both its subphrases have reached ``LEAST`` occurrences, is counted for one
full cycle from there (so lengths are interleaved) and is complete then; the
scans end when nothing is active.  A phrase that does occur ``LEAST`` times has
subphrases that do, so none is missed, and a full cycle sees every shard once,
so every count is whole.

When each subphrase reached the threshold is handed to the scans as one byte a
slot in a table of ``SLOTS`` hashed slots, whatever the size of the corpus.  Two
phrases in one slot can only activate something early, never late or twice.
Counts themselves are kept by the words' 64-bit hashes (the language is part of
a word's hash); a word hash that stood for two words would raise an error.

A scan's task adds up its own occurrences and hands them on in packed arrays, a
row per bucket of phrases, so Spark moves few rows; a bucket's arrays are added
up in one task.  Every task counts a phrase once, so a frequent phrase makes no
bucket large, and the buckets' number follows the corpus' size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from nextbuy.llm.ship import ship
from nextbuy.llm.words import _FOLD, mix64, text_bytes
from nextbuy.session import Scratch

LEAST = 10
SHARDS = 2
SLOTS = 1 << 22
NEVER = 255
TOP = 2000
RANK_PARTS = 32
#: A candidate goes if a longer one has at least this percentage of its occurrences.
COVERED = 50
BLOCK_BYTES = 2 << 20
#: Text bytes for which there is one bucket of phrases.
BUCKET_BYTES = 16 << 20

#: Fixed characters that end a piece, and those between words.
_BREAK = np.isin(np.arange(256), np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))
_GAP = _BREAK | np.isin(np.arange(256), np.frombuffer(b" \t", np.uint8))
_rng = np.random.default_rng(12)
_LANG, _LEFT, _RIGHT = (_rng.integers(1, 2**62, 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
_CODE = (_rng.integers(1, 2**62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[_FOLD]
_BASE = 0x9E3779B97F4A7C15
_powers = np.ones((2, 1), np.uint64)


def _power_table(n: int) -> np.ndarray:
    """Powers of the base, and of its inverse, modulo 2^64."""
    global _powers
    if _powers.shape[1] < n:
        grown = np.empty((2, n), np.uint64)
        for row, base in zip(grown, (_BASE, pow(_BASE, -1, 1 << 64)), strict=True):
            row[:] = base
            row[0] = 1
            np.cumprod(row, out=row)
        _powers = grown
    return _powers


def _block_end(data: np.ndarray, at: int, end: int) -> int:
    """The first byte from ``at`` on that lies between words."""
    while at < end:
        gap = np.flatnonzero(_GAP[data[at:at + 65536]])
        if len(gap):
            return at + int(gap[0])
        at += 65536
    return end


def words_of(column: pa.Array, lang: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(hash, piece number, first byte, end, text index) of the words of a column, block by block; a piece may go on in the next block."""
    data, offsets = text_bytes(column)
    pieces, lo, end = 0, int(offsets[0]), int(offsets[-1])
    while lo < end:
        hi = _block_end(data, lo + BLOCK_BYTES, end) if lo + BLOCK_BYTES < end else end
        part = data[lo:hi]
        breaks = np.flatnonzero(_BREAK[part])
        texts = offsets[np.searchsorted(offsets, lo):np.searchsorted(offsets, hi)] - lo
        word = ~_GAP[part]
        start, stop = word.copy(), word.copy()
        start[1:] &= ~word[:-1]
        stop[:-1] &= ~word[1:]
        start[texts] = word[texts]
        inner = texts[texts > 0]
        stop[inner - 1] = word[inner - 1]
        first = np.flatnonzero(start)
        if len(first):
            end_at = np.flatnonzero(stop) + 1
            length = end_at - first
            # a word's hash is a difference of prefix sums, moved to the power 0
            power, inverse = _power_table(len(part) + 1)
            sums = np.empty(len(part) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(_CODE[part] * power[:len(part)], out=sums[1:])
            value = (sums[end_at] - sums[first]) * inverse[first]
            text = np.searchsorted(offsets, first + lo, "right") - 1
            h = mix64(mix64(value + length.astype(np.uint64)) + lang[text] * _LANG)
            # one more piece begins after each break and at each text
            piece = pieces + np.searchsorted(breaks, first) + np.searchsorted(texts, first, "right")
            yield np.maximum(h, np.uint64(1)), piece, first + lo, first + lo + length, text
        pieces += len(breaks) + len(texts)
        lo = hi


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix64(left * _LEFT + right * _RIGHT)


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(20)).astype(np.int64) & (SLOTS - 1)


def _key(words: list[np.ndarray]) -> np.ndarray:
    out = words[0]
    for w in words[1:]:
        out = _pair(out, w)
    return out


def _added(words: list[np.ndarray], n: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The distinct phrases of parallel word arrays, their counts (sums of ``n``, or occurrences) and keys; phrases of one key stay apart."""
    key = _key(words)
    order = np.lexsort(words[::-1]) if len(words) == 1 else np.argsort(key, kind="stable")
    words, key = [w[order] for w in words], key[order]
    new = np.zeros(len(key), bool)
    new[:1] = True
    for w in words:
        new[1:] |= w[1:] != w[:-1]
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(key))) if n is None else np.add.reduceat(n[order], at) if len(at) else n
    return [w[at] for w in words], counts.astype(np.int64), key[at]


_PACKED, _COUNTS = "bucket int, length int, packed binary", "h1 long, h2 long, h3 long, n long"


def _pack(words: list[np.ndarray], n: np.ndarray) -> bytes:
    order = np.lexsort(words[::-1])  # equal first words side by side pack well
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x[order].tobytes() for x in (*words, n)))


def _unpack(packed: bytes, length: int) -> tuple[list[np.ndarray], np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint64).reshape(length + 1, -1)
    return list(raw[:length]), raw[length].view(np.int64)


def _bucketed(words: list[np.ndarray], n: np.ndarray, key: np.ndarray, length: int, buckets: int) -> pa.RecordBatch:
    """A row per bucket: the phrases whose key falls in it, packed."""
    bucket = ((key >> np.uint64(8)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = [(k, order[ends[k]:ends[k + 1]]) for k in range(buckets) if ends[k] < ends[k + 1]]
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in rows], pa.int32()), pa.array([length] * len(rows), pa.int32()),
         pa.array([_pack([w[i] for w in words], n[i]) for _, i in rows], pa.binary())], names=["bucket", "length", "packed"])


def _bucket_sums(key: tuple, table: pa.Table) -> tuple[int, list[np.ndarray], np.ndarray]:
    """Length, words and counts of a bucket's phrases; length 0 are the languages' totals."""
    length = key[1].as_py()
    parts = [_unpack(x.as_py(), max(length, 1)) for x in table.column("packed")]
    words = [np.concatenate(x) for x in zip(*(w for w, _ in parts), strict=True)]
    words, n, _ = _added(words, np.concatenate([n for _, n in parts]))
    return length, words, n


def _langs(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def scanner(step: int, reach: tuple[np.ndarray, np.ndarray], buckets: int):
    """Counts what is active in scan ``step``; ``reach`` tells in which scan the slots of words and of pairs reached the threshold.

    In: lang hash, text.  Phrases of length 0 are languages, counted by their words.
    """
    def active(since: np.ndarray) -> np.ndarray:
        return (since <= step) & (step < since + SHARDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = _langs(batch.column(0))
            found: dict[int, list[tuple[np.ndarray, ...]]] = {1: [], 2: [], 3: []}
            total = np.zeros(len(batch.column(1)), np.int64)
            tail = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            for h, piece, *_, text in words_of(batch.column(1), lang):
                if step < SHARDS:
                    found[1].append((h,))
                    total += np.bincount(text, minlength=len(total))
                if step == 0:
                    continue
                h, piece = np.concatenate([tail[0], h]), np.concatenate([tail[1], piece])
                old = len(tail[0])
                tail = (h[-2:], piece[-2:])
                since = reach[0][_slot(h)].astype(np.int64)
                joined = np.flatnonzero((piece[1:] == piece[:-1]) & (since[1:] != NEVER) & (since[:-1] != NEVER))
                two = np.maximum(since[joined], since[joined + 1]) + 1
                mine = joined[active(two) & (joined + 1 >= old)]
                found[2].append((h[mine], h[mine + 1]))
                # three words: both pairs, at i and i + 1, have reached the threshold
                pairs = reach[1][_slot(_pair(h[joined], h[joined + 1]))].astype(np.int64)
                i = np.flatnonzero((joined[1:] == joined[:-1] + 1) & (pairs[1:] != NEVER) & (pairs[:-1] != NEVER))
                three = np.maximum(pairs[i], pairs[i + 1]) + 1
                mine = joined[i[active(three)]]
                mine = mine[mine + 2 >= old]
                found[3].append((h[mine], h[mine + 1], h[mine + 2]))
            for length, parts in found.items():
                words = [np.concatenate(x) for x in zip(*parts, strict=True)]
                if words and len(words[0]):
                    yield _bucketed(*_added(words), length, buckets)
            if step < SHARDS and len(lang):
                yield _bucketed(*_added([lang], total), 0, buckets)

    return run


def _slots_reached(key: tuple, table: pa.Table) -> pa.Table:
    """length, chunk, bits: the slots of a bucket's words or pairs with at least LEAST occurrences."""
    length, words, n = _bucket_sums(key, table)
    slot = np.unique(_slot(_key([w[n >= LEAST] for w in words])))
    return pa.table({"length": np.full(len(slot), length, np.int32), "chunk": (slot >> 6).astype(np.int32),
                     "bit": (np.uint64(1) << (slot & 63).astype(np.uint64)).view(np.int64)})


def _frequent(key: tuple, table: pa.Table) -> pa.Table:
    """h1, h2, h3, n of a bucket's phrases with at least LEAST occurrences (zero for words that are none); languages as h1 = 0, h2."""
    length, words, n = _bucket_sums(key, table)
    keep = n >= (LEAST if length else 0)
    zero = np.zeros(int(keep.sum()), np.int64)
    columns = [w[keep].view(np.int64) for w in words] if length else [zero, words[0][keep].view(np.int64)]
    columns += [zero] * (3 - len(columns))
    return pa.table(dict(zip(("h1", "h2", "h3", "n"), (*columns, n[keep]), strict=True)))


def _mark(scans: list[DataFrame], step: int, reach: tuple[np.ndarray, np.ndarray], scratch: Scratch) -> None:
    """Enter ``step`` for the slots of the words and pairs that have reached the threshold by now; at most SLOTS / 32 rows come back.

    Words are whole after SHARDS scans, pairs after twice as many.
    """
    counts = _union(scans).filter("length in (1, 2)" if step < SHARDS else "length = 2")
    slots = scratch.write(counts.groupBy("bucket", "length").applyInArrow(_slots_reached, "length int, chunk int, bit long").groupBy("length", "chunk").agg(
        F.bit_or("bit").alias("bits")), "slots")
    found = slots.toArrow()
    scratch.drop(slots)
    length, chunk, bits = (found.column(k).to_numpy() for k in ("length", "chunk", "bits"))
    for k, table in enumerate(reach):
        mine = length == k + 1
        on = (bits[mine].view(np.uint64)[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
        slot = (chunk[mine].astype(np.int64)[:, None] * 64 + np.arange(64))[on == 1]
        table[slot[table[slot] == NEVER]] = step


def phrase_counts(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, np.ndarray]:
    """h1, h2, h3, n of every phrase with at least LEAST occurrences (h2, h3 zero where shorter), the languages' totals (h1 = 0); the words' reach."""
    shards = scratch.write(docs.select("lang", "text", F.pmod(F.xxhash64("lang", "text", "doc"), F.lit(SHARDS)).cast("int").alias("shard")),
                           "shards", ["shard"])
    size = shards.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = -(-size // BUCKET_BYTES) or 1
    reach = (np.full(SLOTS, NEVER, np.uint8), np.full(SLOTS, NEVER, np.uint8))
    scans: list[DataFrame] = []
    step = 0

    def last(table: np.ndarray) -> int:
        return int(np.where(table == NEVER, -SHARDS - 1, table.astype(np.int64)).max()) + 1 + SHARDS

    while step < SHARDS or step < last(reach[0]) or step < last(reach[1]):
        texts = shards.filter(F.col("shard") == step % SHARDS).select("lang", "text")
        scans.append(scratch.write(texts.mapInArrow(scanner(step, reach, buckets), _PACKED), f"scan{step}"))
        # a pair's count can grow until twice the scans of a cycle
        if step < 2 * SHARDS:
            _mark(scans, step, reach, scratch)
        step += 1
    counts = scratch.write(_union(scans).groupBy("bucket", "length").applyInArrow(_frequent, _COUNTS), "counts")
    scratch.drop(shards, *scans)
    return counts, reach[0]


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def speller(reach: np.ndarray):
    """h, lang, word of the words whose slot reached the threshold; in: lang hash, text, lang."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, _ = text_bytes(batch.column(1))
            parts = []
            for h, _, start, end, text in words_of(batch.column(1), _langs(batch.column(0))):
                mine = np.flatnonzero(reach[_slot(h)] != NEVER)
                _, one = np.unique(h[mine], return_index=True)
                parts.append(tuple(x[mine[one]] for x in (h, start, end, text)))
            if not parts:
                continue
            h, start, end, text = (np.concatenate(x) for x in zip(*parts, strict=True))
            h, one = np.unique(h, return_index=True)
            start, length = start[one], (end - start)[one]
            ends = np.cumsum(length)
            at = np.repeat(start - (ends - length), length) + np.arange(int(ends[-1]) if len(ends) else 0)
            spelt = pa.Array.from_buffers(pa.string(), len(h), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(_FOLD[data[at]])])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column(2).take(pa.array(text[one])), spelt], names=["h", "lang_name", "word"])

    return run


def _score(a: str, left: str, right: str) -> str:
    """floor(1000000 a a / (l r)) in exact decimals."""
    wide = lambda c: f"cast({c} as decimal(38, 0))"
    return f"(1000000 * {wide(a)} * {wide(a)}) div ({wide(left)} * {wide(right)})"


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language of ``docs`` (lang, text, doc_id).

    Null text is empty, null lang is ``und``.  Rows that repeat, also under one
    doc_id, each count; doc_id only deals rows to shards and may be null or
    absent.  A language without a candidate, and an empty table, give no rows.
    Other columns are ignored.
    """
    ship(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "op12")
    name = F.coalesce(F.col("lang"), F.lit("und"))
    doc = F.col("doc_id").cast("string") if "doc_id" in docs.columns else F.lit(None).cast("string")
    texts = docs.select(F.xxhash64(name).alias("lang"), F.coalesce("text", F.lit("")).alias("text"), name.alias("lang_name"), doc.alias("doc"))
    counts, reach = phrase_counts(texts, scratch)
    spelt = scratch.write(
        texts.select("lang", "text", "lang_name").mapInArrow(speller(reach), "h long, lang_name string, word string").groupBy("h").agg(
            F.min("word").alias("word"), F.min("lang_name").alias("lang_name"), F.max(F.struct("word", "lang_name")).alias("other"))
        .select("h", "lang_name", F.expr(
            "if(other.word = word and other.lang_name = lang_name, word, raise_error('two words share a hash'))").cast("string").alias("word")), "words")
    words = counts.filter("h1 <> 0 and h2 = 0").select(F.col("h1").alias("w"), F.col("n").alias("f"))
    pairs = counts.filter("h1 <> 0 and h2 <> 0 and h3 = 0").select("h1", "h2", F.col("n").alias("a"))
    triples = counts.filter("h3 <> 0").select("h1", "h2", "h3", F.col("n").alias("a"))

    def part(frame: DataFrame, on: list[str], out: str, source: DataFrame, keys: list[str], value: str) -> DataFrame:
        """``frame`` with the count of the words at ``on`` as ``out``."""
        named = source.select(*(F.col(k).alias(f"k_{i}") for i, k in enumerate(keys)), F.col(value).alias(out))
        match = [F.col(c) == F.col(f"k_{i}") for i, c in enumerate(on)]
        return frame.join(named, match).drop(*(f"k_{i}" for i in range(len(keys))))

    def one(frame: DataFrame, word: str, out: str) -> DataFrame:
        return part(frame, [word], out, words, ["w"], "f")

    def two(frame: DataFrame, on: list[str], out: str) -> DataFrame:
        return part(frame, on, out, pairs, ["h1", "h2"], "a")

    longer = triples.select(F.explode(F.array(F.struct("h1", "h2", "a"), F.struct(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))).alias("x")) \
        .select("x.*").groupBy("h1", "h2").agg(F.max("a").alias("longer"))
    scored = one(one(pairs, "h1", "l"), "h2", "r").join(longer, ["h1", "h2"], "left").filter(
        f"longer is null or 100 * longer < {COVERED} * a").select("h1", "h2", F.lit(0).cast("long").alias("h3"), "a", "l", "r", F.expr(_score("a", "l", "r")).alias("score"))
    both = two(two(one(one(triples, "h1", "l1"), "h3", "r2"), ["h2", "h3"], "r1").withColumnRenamed("a", "a"), ["h1", "h2"], "l2")
    cuts = F.least(F.struct(F.expr(_score("a", "l1", "r1")).alias("score"), F.lit(1).alias("k"), F.col("l1").alias("l"), F.col("r1").alias("r")),
                   F.struct(F.expr(_score("a", "l2", "r2")).alias("score"), F.lit(2).alias("k"), F.col("l2").alias("l"), F.col("r2").alias("r")))
    scored = scored.union(both.withColumn("cut", cuts).select("h1", "h2", "h3", "a", "cut.l", "cut.r", "cut.score"))
    for k in ("h1", "h2", "h3"):
        spelling = spelt.select(F.col("h").alias(k), F.col("word").alias(f"word_{k}"), *([F.col("lang_name")] if k == "h1" else []))
        scored = scored.join(spelling, k, "left" if k == "h3" else "inner")
    totals = counts.filter("h1 = 0").select(F.col("h2").alias("lang_hash"), F.col("n").alias("total"))
    phrases = scored.withColumn("phrase", F.concat_ws(" ", "word_h1", "word_h2", "word_h3"))
    # a language's first ``top`` are among the first of its parts, so the last window sees RANK_PARTS * top rows of it at most
    best = lambda *by: F.row_number().over(Window.partitionBy("lang_name", *by).orderBy(F.desc("score"), F.desc("a"), "phrase"))
    parts = phrases.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).withColumn("rank", best("part")).filter(F.col("rank") <= top)
    ranked = parts.withColumn("rank", best()).filter(F.col("rank") <= top)
    return ranked.withColumn("lang_hash", F.xxhash64("lang_name")).join(totals, "lang_hash").select(
        F.col("lang_name").alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
