"""Benchmark decontamination by template canonicalisation (operator 5).

Words become typed slots or lower-cased literals: numbers ``<num>``, names
(capitalised inside a sentence) ``<name>``, units ``<unit>``.  Windows of
``WINDOW`` canonical words of the benchmark are hashed and joined with the
windows of every text, so a question with other numbers, names or units meets
its template.  A text is contaminated by an item if at least ``SHARE`` of the
item's windows are found and the slots are consistent: equal slot values of the
item stand for equal values of the text.  A text may hold a question several
times with other values, so both are asked of each occurrence: of the whole
text, of the windows that lie alike in text and item, and of those whose places
differ by less than an item's length (words may have come in between).

Case is not trusted alone: a window with names is hashed a second time with the
names as lower-cased literals, so titles and texts in capitals meet theirs.
A window with few literals even so (lists of numbers) is hashed by its literal
words, and only the same values meet it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from nextbuy.llm.ship import ship
from nextbuy.llm.words import span_hashes, split_words, window_hashes
from nextbuy.session import materialize

WINDOW = 8
#: Items of fewer words than this cannot be told from chance and match nothing.
LEAST_WORDS = 4
SHARE = 0.5
#: Share of an item's slot values that must each stand for one value of the occurrence.
CONSISTENT = 0.8
NUM, NAME, UNIT = (np.uint64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93))
#: Units that follow a number.
UNITS = ("%", "$", "€", "£", "kg", "g", "mg", "lb", "lbs", "oz", "km", "m", "cm", "mm", "mi", "miles", "ft", "feet", "inches",
         "l", "ml", "liters", "litres", "s", "sec", "seconds", "min", "minutes", "h", "hours", "days", "weeks", "months", "years",
         "mph", "km/h", "kw", "w", "usd", "eur", "gbp", "dollars", "euros", "cents")
_TRIM = np.zeros(256, bool)
_TRIM[list(b".,;:!?\"'()[]{}")] = True
_END = np.zeros(256, bool)
_END[list(b".!?:")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
#: First bytes of the two-byte characters that ``_folded`` knows.
_LEADS = np.array([0xC3, 0xCE, 0xD0], np.uint8)


def _unit_hashes() -> np.ndarray:
    return next(split_words(pa.array([" ".join(UNITS)]), lower=True)).hashes


def _folded(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with Latin-1, Greek and Cyrillic capitals in lower case, which have the same length; A-Z are left."""
    lead = np.flatnonzero((data == 0xC3) | (data == 0xCE) | (data == 0xD0))
    lead = lead[lead + 1 < len(data)]
    if not len(lead):
        return data
    data, a, b = data.copy(), data[lead], data[lead + 1]
    near = ((a == 0xC3) & (b >= 0x80) & (b <= 0x9E) & (b != 0x97)) | ((a == 0xCE) & (b >= 0x91) & (b <= 0x9F)) | ((a == 0xD0) & (b >= 0x90) & (b <= 0x9F))
    data[lead[near] + 1] += 0x20
    far = ((a == 0xCE) & (b >= 0xA0) & (b <= 0xA9)) | ((a == 0xD0) & (b >= 0xA0) & (b <= 0xAF))
    data[lead[far]] += 1
    data[lead[far] + 1] -= 0x20
    early = (a == 0xD0) & (b >= 0x80) & (b <= 0x8F)
    data[lead[early]] += 1
    data[lead[early] + 1] += 0x10
    return data


def canonical(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, word bounds of the rows from there on, canonical word hashes, the same with names as literals, literal hashes) by group of texts.

    A word that begins in upper case (Latin, Greek or Cyrillic) is a name unless it begins the text, a
    line or a sentence; a word after a number that is a known unit is a unit; a
    word that begins with a digit, after a currency sign too, is a number.
    """
    units = np.sort(_unit_hashes())
    for w in split_words(column, lower=False):
        n = len(w.hashes)
        if not n:
            continue
        data, starts, ends = w.data, w.starts.copy(), w.ends.copy()
        ended = _END[data[ends - 1]]
        for _ in range(3):  # punctuation around a word is no part of it
            last = _TRIM[data[ends - 1]] & (ends - starts > 1)
            ends[last] -= 1
            head = _TRIM[data[starts]] & (ends - starts > 1)
            starts[head] += 1
        low = int(starts[0])
        folded = _folded(data[low:int(ends[-1])])
        literal = span_hashes(folded, starts - low, ends - low, lower=True)
        signed = np.isin(data[starts], np.frombuffer(b"$-+#", np.uint8)) & (ends - starts > 1)
        number = _DIGIT[data[starts]] | (signed & _DIGIT[data[np.minimum(starts + 1, len(data) - 1)]])
        first = np.zeros(n, bool)
        first[w.bounds[:-1][w.bounds[:-1] < n]] = True
        begins = first.copy()
        begins[1:] |= ended[:-1]
        broken = np.concatenate([[False], np.add.reduceat((data[w.ends[0]:w.starts[-1] + 1] == 10).astype(np.int8), w.ends[:-1] - w.ends[0]) > 0]) if n > 1 else np.zeros(1, bool)
        begins[:len(broken)] |= broken
        # a capital beyond A-Z is two bytes that folding changes
        two, at = np.isin(data[starts], _LEADS), starts - low
        further = np.minimum(at + 1, len(folded) - 1)
        capital = _UPPER[data[starts]] | (two & ((folded[at] != data[starts]) | (folded[further] != data[low + further])))
        name = capital & ~begins & ~number
        after = np.zeros(n, bool)
        after[1:] = number[:-1] & ~first[1:]
        unit = after & (units[np.minimum(np.searchsorted(units, literal), len(units) - 1)] == literal)
        plain = np.where(number, NUM, np.where(unit, UNIT, literal))
        yield w.first, w.bounds, np.where(name & ~unit, NAME, plain), plain, literal


def _literals(words: np.ndarray, literal: np.ndarray, width: int) -> np.ndarray:
    """Literal words in each window."""
    sums = np.concatenate([[0], np.cumsum(words == literal)])
    return sums[width:] - sums[:-width]


def _forms(words: np.ndarray, plain: np.ndarray, literal: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of windows and their hashes: windows by template, by template with literal names, and by literal words if literals are few."""
    if len(words) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least, most, some = width // 2 - 1, _literals(words, literal, width), _literals(plain, literal, width)
    typed, named, listed = np.flatnonzero(most >= least), np.flatnonzero((some > most) & (some >= least)), np.flatnonzero(some < least)
    return np.concatenate([typed, named, listed]), np.concatenate(
        [window_hashes(words, width)[typed], window_hashes(plain, width, named), window_hashes(literal, width, listed)])


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per form of each window of an item, as ``item_windows`` gives them."""
    for batch in batches:
        for first, bounds, *forms in canonical(batch.column(1)):
            for d in np.flatnonzero(np.diff(bounds) >= LEAST_WORDS):
                words, plain, literal = (x[bounds[d]:bounds[d + 1]] for x in forms)
                width = min(WINDOW, len(words))
                at, windows = _forms(words, plain, literal, width)
                own = window_hashes(literal, width)
                firm = _literals(words, literal, width) >= width // 2 - 1
                value = np.where(words == literal, np.uint64(0), literal)
                slots = [value[i:i + width].view(np.int64).tolist() if value[i:i + width].any() else [] for i in at]
                same = lambda x, kind: pa.repeat(pa.scalar(x, kind), len(at))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(batch.column(0)[first + d], len(at)), same(width, pa.int32()), same(len(np.unique(own)), pa.int64()),
                     same(len(np.unique(own[firm])), pa.int64()), pa.array(windows.view(np.int64)), pa.array(slots, pa.list_(pa.int64())),
                     pa.array(at), same(len(words), pa.int64()), pa.array(own[at].view(np.int64)), pa.array(firm[at])],
                    names=["item_id", "width", "n_windows", "n_firm", "window", "slots", "place", "words", "own_window", "firm"])


def item_windows(benchmark: DataFrame) -> DataFrame:
    """A row per form of each window: item_id, width, n_windows (distinct ones of the item), n_firm (those of them with
    literals enough by template), window (hash of the form), slots (0 for a literal; empty: no slot), place (its first
    word), words (of the item), own_window (hash of its literal words), firm."""
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        _item_rows, "item_id long, width int, n_windows long, n_firm long, window long, slots array<long>, place long, words long, own_window long, firm boolean")


#: Windows of a benchmark up to this many are looked up in memory on every executor (8 bytes each); beyond, the windows of the corpus are shuffled.
IN_MEMORY = 4_000_000


def _finder(widths: list[int], known: Broadcast | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value if known is not None else None
        for batch in batches:
            for first, bounds, words, plain, literal in canonical(batch.column(1)):
                for width in widths:
                    at, windows = _forms(words, plain, literal, width)
                    if table is not None:
                        known_ = table[np.minimum(np.searchsorted(table, windows), len(table) - 1)] == windows
                        at, windows = at[known_], windows[known_]
                    row = np.searchsorted(bounds, at, "right") - 1
                    inside = at + width <= bounds[row + 1]
                    at, windows, row = at[inside], windows[inside], row[inside]
                    if len(at):
                        spans = pa.array(literal[at[:, None] + np.arange(width)].view(np.int64).ravel())
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array(first + row)), batch.column(2).take(pa.array(first + row)), pa.repeat(pa.scalar(width, pa.int32()), len(at)),
                             pa.array(windows.view(np.int64)), pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * width, pa.int32()), spans), pa.array(at - bounds[row])],
                            names=["doc_id", "version", "width", "window", "doc_slots", "doc_place"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, item_id, n_found, n_windows, exact of each contaminated text and item; clean texts have no row.

    ``exact``: no slot of an occurrence differs.  Null and empty texts and items match nothing,
    nor do rows without an id; rows that repeat an id count as one text, items
    alike.  Copies of an item under several ids each give a row.
    """
    ship(docs.sparkSession)
    items = materialize(item_windows(benchmark.filter("item_id is not null")), "op5-items")
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # at most WINDOW values
    known = items.select("window").distinct()
    table = None
    if known.count() <= IN_MEMORY:
        table = docs.sparkSession.sparkContext.broadcast(np.sort(np.array([r[0] for r in known.toLocalIterator()], np.int64).view(np.uint64)))
    if not widths:
        widths, table = [WINDOW], None
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("version")).filter("doc_id is not null").mapInArrow(
        _finder(widths, table), "doc_id long, version long, width int, window long, doc_slots array<long>, doc_place long")
    met = rows.join(items.distinct(), ["width", "window"]).select("*", F.explode(_occurrences()).alias("run"))
    key = ["doc_id", "item_id", "run"]
    # of all windows, or of those that other values leave as they are
    whole = met.groupBy(*key, "own_window").agg(F.max("firm").alias("firm"), F.max("n_windows").alias("n_windows"), F.max("n_firm").alias("n_firm")).groupBy(*key).agg(
        F.count("*").alias("n_found"), F.count_if("firm").alias("firm_found"), F.max("n_windows").alias("n_windows"), F.max("n_firm").alias("n_firm"))
    whole = whole.filter((F.col("n_found") >= share * F.col("n_windows")) | ((F.col("n_firm") > 0) & (F.col("firm_found") >= share * F.col("n_firm"))))
    # a slot value of the item must stand for one value of the occurrence, in all windows
    values = met.filter("size(slots) > 0").select(*key, F.explode(F.arrays_zip(F.col("slots").alias("own"), F.col("doc_slots").alias("other"))).alias("s")).filter("s.own <> 0")
    votes = values.groupBy(*key, "s.own").agg(F.count_distinct("s.other").alias("n"), F.max(F.col("s.own") != F.col("s.other")).alias("changed"))
    slots = votes.groupBy(*key).agg(F.avg((F.col("n") == 1).cast("double")).alias("agree"), F.max("changed").alias("changed"))
    judged = whole.join(slots, key, "left").withColumn("agrees", F.coalesce("agree", F.lit(1.0)) >= CONSISTENT)
    return judged.groupBy("doc_id", "item_id").agg(
        F.max("n_found").alias("n_found"), F.max("n_windows").alias("n_windows"), F.max("agrees").alias("agrees"),
        F.max(F.col("agrees") & ~F.coalesce("changed", F.lit(False))).alias("exact")).filter("agrees").select("doc_id", "item_id", "n_found", "n_windows", "exact")


def _occurrences() -> Column:
    """Runs of a met window: the whole text (all versions of its id), its shift against the item, and two bins of shifts.

    Bins are at most an item long and begin every half of that, so copies one
    after the other are never in one bin, and shifts that differ by less than
    half an item share one.
    """
    shift = F.col("doc_place") - F.col("place")
    half = F.greatest(F.floor(F.col("words") / 2), F.lit(1))
    cell = F.floor(shift / half)
    run = lambda kind, at, version: F.struct(F.lit(kind).alias("kind"), at.cast("long").alias("at"), version.cast("long").alias("version"))
    return F.array(run(0, F.lit(0), F.lit(0)), run(1, shift, F.col("version")), run(2, cell, F.col("version")), run(2, cell - 1, F.col("version")))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) whose id no item contaminates; rows without an id stay."""
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias("leaked_id")).distinct()
    return docs.join(bad, docs["doc_id"].cast("long") == bad["leaked_id"], "left_anti")
