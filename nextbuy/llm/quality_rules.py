"""Quality rules with risk-controlled cutoffs (operator 6).

Every rule compares a count with another one, ``100 * value > cutoff * base``,
over a fixed grid of cutoffs.  A cutoff may be used in a stratum only if a
labelled holdout proves it: the exact (Clopper-Pearson) upper bound of the
share of good documents that it rejects must not exceed ``limit / rules``, so
all rules together falsely reject at most ``limit`` of a stratum's good
documents.  All bounds hold together with probability ``1 - error``: the error
is divided by strata and rules (Bonferroni), and within a rule the grid is
tested from the most lenient cutoff on, up to the first failure (a fixed
sequence needs no further division).  Among the proven cutoffs the one that
rejects most bad documents beyond good ones is taken; a rule without any gain,
or with too few labels to prove anything, stays off.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text; null is the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from nextbuy.llm.ship import ship
from nextbuy.llm.words import split_words, window_hashes

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
#: Rule: (value, base, cutoffs in hundredths from lenient to strict).
RULES = {
    "symbols": ("n_symbols", "n_words", (200, 100, 50, 30, 20, 10)),
    "dup_lines": ("n_dup_lines", "n_lines", (90, 80, 70, 60, 50, 40, 30)),
    "repeat_words": ("n_repeat_words", "n_words", (45, 40, 35, 30, 25, 20)),
    "word_length": ("word_chars", "n_words", (3000, 2000, 1500, 1200, 1000)),
}
LIMIT, ERROR = 0.05, 0.05

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CHAR = np.ones(256, bool)
_CHAR[0x80:0xC0] = False
_CHAR[[0x20, *range(0x09, 0x0E)]] = False
_SPACE = bytes([0x20, *range(0x09, 0x0E)])


def count_batch(column: pa.Array) -> np.ndarray:
    """An int64 array (row, count of ``COUNTS``) of a text column."""
    out = np.zeros((len(column), len(COUNTS)), np.int64)
    for w in split_words(column):
        lo, hi = int(w.offsets[w.first]), int(w.offsets[w.first + w.n_docs])
        at = w.offsets[w.first:w.first + w.n_docs + 1] - lo
        part = w.data[lo:hi]
        rows = out[w.first:w.first + w.n_docs]
        rows[:, 0] = np.diff(w.bounds)
        for k, table in ((1, _CHAR), (2, _SYMBOL)):
            rows[:, k] = np.diff(np.concatenate([[0], np.cumsum(table[part])])[at])
        every = window_hashes(w.hashes, 3)
        for d in range(w.n_docs):
            n = int(rows[d, 0])
            if not n:
                continue
            lines = [x for x in part[at[d]:at[d + 1]].tobytes().split(b"\n") if x.strip(_SPACE)]
            rows[d, 3], rows[d, 5] = len(lines) - len(set(lines)), len(lines)
            if n > 3:
                windows = every[w.bounds[d]:w.bounds[d + 1] - 2]
                order = np.argsort(windows)
                same = np.diff(windows[order]) == 0
                if same.any():
                    covered = np.zeros(n, bool)
                    for again in (order[1:][same], order[:-1][same]):
                        for k in range(3):
                            covered[again + k] = True
                    rows[d, 4] = covered.sum()
    return out


def measure(docs: DataFrame, name: str = "quality", text: bool = True) -> DataFrame:
    """``docs`` with a struct column ``name`` of the ``COUNTS`` of its text; other columns pass through, the text if asked for."""
    ship(docs.sparkSession)
    at = docs.columns.index("text")
    keep = [k for k in range(len(docs.columns)) if text or k != at]
    schema = T.StructType([*(docs.schema.fields[k] for k in keep), T.StructField(name, T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = count_batch(batch.column(at))
            struct = pa.StructArray.from_arrays([pa.array(counts[:, k]) for k in range(len(COUNTS))], names=list(COUNTS))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), struct], names=[*(batch.schema.names[k] for k in keep), name])

    return docs.mapInArrow(run, schema)


def base_failed(name: str = "quality") -> F.Column:
    q = F.col(name)
    return (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])


def at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial X(n, p)."""
    return sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log1p(-p)) for i in range(k + 1))


def choose_cutoffs(counts: list[tuple], limit: float = LIMIT, error: float = ERROR) -> list[tuple[str, str, int]]:
    """(stratum, rule, cutoff) of the rules that stay on.

    ``counts`` has (stratum, rule, quality, level, rows): rows that the first
    ``level`` cutoffs of the grid do not reject and the next one does (the
    grid's length: none rejects).  The upper bound with k of n good rows
    rejected is at most p exactly if P(X <= k | n, p) <= the error.
    """
    seen: dict[tuple, dict] = {}
    for stratum, rule, quality, level, rows in counts:
        seen.setdefault((stratum, rule), {0: {}, 1: {}})[quality][level] = rows
    each = error / max(len(seen), 1)
    chosen = []
    for (stratum, rule), by in sorted(seen.items()):
        n, good, bad, best = sum(by[1].values()), 0, 0, (0, None)
        for level, cutoff in enumerate(RULES[rule][2]):
            good, bad = good + by[1].get(level, 0), bad + by[0].get(level, 0)
            share = limit / len(RULES)
            if good >= share * n or at_most(good, n, share) > each:
                break
            if bad - good > best[0]:
                best = (bad - good, cutoff)
        if best[1] is not None:
            chosen.append((stratum, rule, best[1]))
    return chosen


def calibrate(measured: DataFrame, labels: DataFrame, stratum: str, name: str = "quality",
              limit: float = LIMIT, error: float = ERROR) -> list[tuple[str, str, int]]:
    """Cutoffs proven on the labelled rows; one row per (stratum, rule, quality, level) comes to the driver.

    A document with several labels counts as bad if one of them is 0; rows that
    fail the base rules are no part of it, rows without a stratum form their own.
    """
    marked = labels.filter("quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("label"))
    q = F.col(name)
    level = lambda rule: F.coalesce(*(F.when(100 * q[value] > c * q[base], i) for value, base, grid in [RULES[rule]] for i, c in enumerate(grid)), F.lit(len(RULES[rule][2])))
    rows = measured.filter(~base_failed(name)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
        F.array(*(F.struct(F.lit(r).alias("rule"), level(r).alias("level")) for r in RULES)).alias("levels")).join(marked, "doc_id")
    found = rows.select("stratum", "label", F.explode("levels").alias("l")).groupBy("stratum", "l.rule", "label", "l.level").count()
    return choose_cutoffs([tuple(r) for r in found.select("stratum", "rule", "label", "level", "count").collect()], limit, error)


def rejected(cutoffs: list[tuple[str, str, int]], stratum: str, name: str = "quality") -> F.Column:
    """Whether a measured row breaks a rule that is on in its stratum."""
    q, of = F.col(name), F.coalesce(F.col(stratum).cast("string"), F.lit(""))
    out = F.lit(False)
    for rule, (value, base, _) in RULES.items():
        on = [x for s, r, c in cutoffs if r == rule for x in (F.lit(s), F.lit(c))]
        if on:
            out = out | F.coalesce(100 * q[value] > F.element_at(F.create_map(*on), of) * q[base], F.lit(False))
    return out


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """``docs`` with a struct column ``quality``: the counts, base_failed and kept.

    Texts that are null, empty or without words have counts of 0 and fail the
    base rules.  Every row is judged by its own text, repeated rows alike; an
    existing column ``quality`` is replaced by the struct.  An empty table, or
    no labels, gives base rules only.
    """
    docs = docs.drop("quality")
    cutoffs = calibrate(measure(docs.select("doc_id", stratum, "text"), text=False), labels, stratum)  # counts are joined with labels, not texts
    measured = measure(docs)
    failed = base_failed()
    return measured.withColumn("quality", F.struct("quality.*", failed.alias("base_failed"), (~failed & ~rejected(cutoffs, stratum)).alias("kept")))
