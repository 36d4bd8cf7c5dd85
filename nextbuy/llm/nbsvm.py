"""Quality classifier: naive Bayes support vectors (operator 8).

Indicators of n-grams are hashed into ``2 ** BITS`` features: words and word
pairs, and 1- to 3-grams of abstract words (equal to the word before, part of a
word triple seen before, without a letter, with a symbol, long), which carry
over to words never seen.  Each indicator is scaled by its class log-count
ratio, rows are brought to unit length, and a linear model with hinge loss is
fitted by dual coordinate descent.  Margins become scores by a logistic curve
fitted on rows that the model has not seen.

The fit uses at most about ``SAMPLE`` labelled rows (a documented bound), drawn
by a hash of the id; only their feature numbers come to the driver.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from nextbuy.llm.ship import ship
from nextbuy.llm.words import distinct, mix64, split_words, window_hashes

BITS = 18
SAMPLE = 6000
EPOCHS, COST, SMOOTH = 12, 4.0, 1.0
CUTOFF = 0.3

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0xC3, 0x100)]] = True
_KIND = {k: np.uint64(k * 0x9E3779B97F4A7C15 & (2**64 - 1)) for k in range(1, 9)}


def _slots(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mix64(hashes + _KIND[kind]) >> np.uint64(64 - BITS)).astype(np.int32)


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct feature numbers of each text, in row order; feature 0 is in every text."""
    for w in split_words(column, lower=True):
        n = len(w.hashes)
        single, pairs, triples = _slots(w.hashes, 1), _slots(window_hashes(w.hashes, 2), 2), window_hashes(w.hashes, 3)
        lo = int(w.starts[0]) if n else 0
        part = w.data[lo:int(w.ends[-1])] if n else w.data[:0]
        sums = [np.concatenate([[0], np.cumsum(t[part], dtype=np.int32)]) for t in (_SYMBOL, _LETTER)]
        symbols, letters = (s[w.ends - lo] - s[w.starts - lo] for s in sums)
        abstract = (letters == 0) * 1 + np.minimum(symbols, 3) * 2 + (w.ends - w.starts > 24) * 8
        abstract[1:] += 16 * (w.hashes[1:] == w.hashes[:-1])
        for d in range(w.n_docs):
            a, b = int(w.bounds[d]), int(w.bounds[d + 1])
            out = [np.zeros(1, np.int32), single[a:b], pairs[a:b - 1] if b > a else pairs[:0]]
            if b > a:
                code = abstract[a:b].copy()
                code[0] &= 15
                seen = 0.0
                if b - a > 3:
                    order = np.argsort(triples[a:b - 2], kind="stable")
                    ranked = triples[a:b - 2][order]
                    again = order[1:][ranked[1:] == ranked[:-1]]
                    code[again] += 32
                    seen = len(again) / (b - a - 2)
                grams = [code.astype(np.uint64) + np.uint64(1)]
                for k in (1, 2):
                    if b - a > k:
                        grams.append(grams[-1][:-1] * np.uint64(64) + code[k:].astype(np.uint64) + np.uint64(1) if k == 1
                                     else grams[-1][:-1] * np.uint64(64) + code[2:].astype(np.uint64) + np.uint64(1))
                out += [_slots(g, 3 + k) for k, g in enumerate(grams)]
                shares = [seen, (code & 16 > 0).mean(), symbols[a:b].mean() / 4, (code & 1).mean()]
                out.append(_slots(np.array([k * 16 + min(int(10 * s), 10) for k, s in enumerate(shares)], np.uint64), 7))
            yield distinct(np.concatenate(out))


@dataclass
class Model:
    """Weights by feature (scaled by the log-count ratios), ratios, and the curve from margin to score."""

    weights: np.ndarray
    ratios: np.ndarray
    slope: float
    offset: float

    def margin(self, x: np.ndarray) -> float:
        return float(self.weights[x].sum() / np.sqrt(max((self.ratios[x] ** 2).sum(), 1e-9)))

    def score(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -30, 30)))


def _descend(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, seed: int = 0) -> np.ndarray:
    """Dual coordinate descent for the hinge loss; rows have unit length, so every diagonal entry is 1."""
    values = [ratios[x] / np.sqrt(max((ratios[x] ** 2).sum(), 1e-9)) for x in rows]
    weights, alpha, rng = np.zeros(len(ratios)), np.zeros(len(rows)), np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            x, v = rows[i], values[i]
            new = min(max(alpha[i] - (y[i] * (weights[x] @ v) - 1), 0), COST)
            if new != alpha[i]:
                weights[x] += (new - alpha[i]) * y[i] * v
                alpha[i] = new
    return weights


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Model of feature rows with labels 0 or 1; with one class only, every score is near that class, and a warning is logged."""
    y = np.where(labels == 1, 1.0, -1.0)
    if len(set(y.tolist())) < 2:
        logging.getLogger(__name__).warning("quality classifier: %d labelled rows of one class, nothing learned", len(y))
        return Model(np.zeros(2**BITS), np.zeros(2**BITS), 0.0, 3.0 if not len(y) or y[0] > 0 else -3.0)
    train = np.arange(len(y)) % 5 != 4
    if len(set(y[train].tolist())) < 2 or len(set(y[~train].tolist())) < 2:
        train[:] = True
    counts = np.full((2, 2**BITS), SMOOTH)
    for i in np.flatnonzero(train):
        counts[int(labels[i])][rows[i]] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    ratios[0] = 1.0
    weights = _descend([rows[i] for i in np.flatnonzero(train)], y[train], ratios)
    model = Model(weights * ratios, ratios, 1.0, 0.0)
    unseen = ~train if not train.all() else train
    m = np.array([model.margin(rows[i]) for i in np.flatnonzero(unseen)])
    t = np.where(y[unseen] > 0, (np.sum(y[unseen] > 0) + 1) / (np.sum(y[unseen] > 0) + 2), 1 / (np.sum(y[unseen] < 0) + 2))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps for the logistic curve
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        w, g = p * (1 - p) + 1e-9, p - t
        h = np.array([[(w * m * m).sum() + 1e-3, (w * m).sum()], [(w * m).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, [(g * m).sum() + 1e-3 * a, g.sum()])
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    return Model(model.weights, ratios, float(max(a, 0.0)), float(b))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in features(batch.column(1))], pa.binary())], names=["label", "features"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Model from the labelled rows of ``docs`` (doc_id, text); labels other than 0 and 1 are ignored."""
    ship(docs.sparkSession)
    marked = labels.filter("quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("label"))
    share = min(1.0, sample / max(marked.count(), 1))
    some = marked.filter((F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))) | F.lit(share >= 1))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(some, "doc_id").select("label", "text")
    rows = texts.mapInArrow(_feature_rows, "label int, features binary").collect()
    rows = sorted(((r.label, bytes(r.features)) for r in rows), key=lambda r: (hash_order(r[1]), r[0]))
    return fit([np.frombuffer(x, np.int32) for _, x in rows], np.array([y for y, _ in rows]))


def hash_order(x: bytes) -> int:
    import zlib

    return zlib.crc32(x)


def classify(docs: DataFrame, model: Model, name: str = "quality_score") -> DataFrame:
    """``docs`` with a column ``name``: the score of each row's text, 0 to 1.

    Null and empty texts get the score of a text without words; all rows are
    scored, rows alike get the same score; an existing column ``name`` is
    replaced.
    """
    ship(docs.sparkSession)
    docs = docs.drop(name)
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS weights: a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            margins = np.array([m.margin(x) for x in features(batch.column(at))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(m.score(margins), pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def held_in(part: int, of: int) -> F.Column:
    """Rows whose crc32 of the id as text leaves another remainder than ``part``."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of != part, F.lit(True))
