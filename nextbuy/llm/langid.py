"""Language identification by segmentation-marginalised unigrams (operator 9).

The vocabulary is fixed: all pieces of a public tokenizer, and the 256 bytes.  Training gives each language a smoothed unigram
distribution over it, from the pieces that the tokenizer finds in a bounded
sample of labelled texts.  A word's probability in a language is the sum over
*all* its segmentations into pieces, by the forward algorithm; a text's is the
product over its words.  The forward pass runs over the distinct words of a
batch at once, and rescales, so words of any length keep their precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from nextbuy.llm.ship import ship
from nextbuy.llm.words import span_hashes, split_words

#: Bytes of the public vocabulary's longest piece.
LONGEST = 25
SMOOTH = 0.5
#: Labelled texts per language that training uses, about.
SAMPLE = 2000
#: Distinct words whose scores a task remembers between batches.
REMEMBERED = 1_000_000
_STEP = 8192


def vocabulary(model_file: str) -> tuple[list[bytes], dict[int, int]]:
    """Pieces as bytes (a word start is a space) after the 256 single bytes, and the tokenizer's ids of them."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces, ids, known = [bytes([b]) for b in range(256)], {}, {}
    known = {p: i for i, p in enumerate(pieces)}
    for k in range(sp.get_piece_size()):
        if sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k):
            continue
        p = bytes([int(sp.id_to_piece(k)[3:5], 16)]) if sp.is_byte(k) else sp.id_to_piece(k).replace("▁", " ").encode()
        if p == b" " or p.rstrip(b" "):
            ids[k] = known.setdefault(p, len(pieces))
            if ids[k] == len(pieces):
                pieces.append(p)
    return pieces, ids


class Scorer:
    """Scores words: log probabilities by language of all segmentations together."""

    def __init__(self, pieces: list[bytes], probabilities: np.ndarray):
        self.p = probabilities.T.copy()  # (piece, language)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(x) for x in pieces])
        keys = span_hashes(data, ends - [len(x) for x in pieces], ends)
        self.tables, self.keys, left = [], keys, np.arange(len(keys))
        for shift in (46, 28, 10):  # three chances for a slot of its own
            table = np.full(1 << 18, -1, np.int32)
            slot = (keys[left] >> np.uint64(shift)).astype(np.int64) & ((1 << 18) - 1)
            table[slot] = left
            self.tables.append((np.uint64(shift), table))
            left = left[table[slot] != left]
        assert not len(left), "pieces without a slot"
        # a bit for each part that begins a longer piece: other spans need not be followed further
        parts = sorted({x[:k] for x in pieces for k in range(1, len(x))})
        self.more, self.longest = np.zeros(1 << 22, bool), max(len(x) for x in pieces)
        if parts:
            ends = np.cumsum([len(x) for x in parts])
            self.more[span_hashes(np.frombuffer(b"".join(parts), np.uint8), ends - [len(x) for x in parts], ends) >> np.uint64(42)] = True
        self.seen, self.scores = np.zeros(0, np.uint64), np.zeros((0, self.p.shape[1]))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece of each hash, -1 if none."""
        out = np.full(len(hashes), -1, np.int32)
        for shift, table in self.tables:
            at = table[(hashes >> shift).astype(np.int64) & ((1 << 18) - 1)]
            hit = (at >= 0) & (self.keys[at] == hashes)
            out[hit] = at[hit]
        return out

    def forward(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """(word, language) log probabilities of words (byte spans), each after a word start."""
        length = ends - starts + 1
        out = np.zeros((len(starts), self.p.shape[1]))
        order = np.argsort(length, kind="stable")
        for rows in np.array_split(order, len(order) // _STEP + 1):
            if not len(rows):
                continue
            n, width = length[rows], int(length[rows].max())
            at = np.concatenate([[0], np.cumsum(n)[:-1]])
            text = np.full(int(n.sum()), 0x20, np.uint8)
            inside = np.ones(len(text), bool)
            inside[at] = False
            pos = np.arange(len(text)) - np.repeat(at, n)
            text[inside] = data[(np.repeat(starts[rows], n) + pos - 1)[inside]]
            rest = np.repeat(n, n) - pos
            word = np.repeat(np.arange(len(rows)), n)
            # pieces by the position where they end, and by their length k
            met, going = [], np.arange(len(text))
            for k in range(1, self.longest + 1):
                going = going[rest[going] >= k]
                if not len(going):
                    break
                hashes = span_hashes(text, going, going + k)
                piece = self.find(hashes)
                ok = piece >= 0
                met.append(((pos[going[ok]] + k) * (self.longest + 1) + k, word[going[ok]], piece[ok]))
                going = going[self.more[hashes >> np.uint64(42)]]
            key, owner, piece = (np.concatenate(x) for x in zip(*met, strict=True))
            ranked = np.argsort(key, kind="stable")
            owner, piece = owner[ranked], piece[ranked]
            key, cut = np.unique(key[ranked], return_index=True)
            cut, by_end = np.append(cut, len(ranked)), np.searchsorted(key, np.arange(width + 2) * (self.longest + 1))
            ring = min(self.longest, width) + 1
            alpha = np.zeros((ring, len(rows), self.p.shape[1]))  # a ring over positions
            alpha[0] = 1.0
            scale = np.zeros(len(rows))
            for j in range(1, width + 1):
                total = np.zeros_like(alpha[0])
                for g in range(by_end[j], by_end[j + 1]):
                    hit = owner[cut[g]:cut[g + 1]]  # a word has one span of a length that ends here
                    total[hit] += alpha[(j - int(key[g]) % (self.longest + 1)) % ring][hit] * self.p[piece[cut[g]:cut[g + 1]]]
                alpha[j % ring] = total
                done = n == j
                out[rows[done]] = np.log(np.maximum(total[done], 1e-300)) + scale[done, None]
                if j % 16 == 0:
                    low = np.flatnonzero(~done & (n > j))
                    most = alpha[:, low].max(axis=(0, 2))
                    low, most = low[most > 0], most[most > 0]
                    alpha[:, low] /= most[None, :, None]
                    scale[low] += np.log(most)
        return out

    def words(self, w) -> np.ndarray:
        """(word, language) log probabilities of a group of texts' words."""
        distinct, first, inverse = np.unique(w.hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.seen, distinct)
        known = at < len(self.seen)
        known[known] = self.seen[at[known]] == distinct[known]
        found = np.zeros((len(distinct), self.p.shape[1]))
        found[known] = self.scores[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            found[new] = self.forward(w.data, w.starts[first[new]], w.ends[first[new]])
            if len(self.seen) < REMEMBERED:
                keys = np.concatenate([self.seen, distinct[new]])
                order = np.argsort(keys)
                self.seen, self.scores = keys[order], np.concatenate([self.scores, found[new]])[order]
        return found[inverse.ravel()]


def train(docs: DataFrame, model_file: str, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages in order, and (language, piece) probabilities.

    Uses the rows whose ``lang`` is not null, about ``sample`` of each language
    (a documented bound) by a hash of the id.  Only piece counts, at most one
    per language and piece, come to the driver.
    """
    ship(docs.sparkSession)
    docs = docs.filter("lang is not null and text is not null").select(F.col("doc_id").cast("string").alias("id"), "lang", "text")
    sizes = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    pieces, _ = vocabulary(model_file)
    if not languages:
        return [], np.zeros((0, len(pieces)))
    share = F.element_at(F.create_map(*(x for k in languages for x in (F.lit(k), F.lit(min(1.0, sample / sizes[k]))))), F.col("lang"))
    some = docs.filter(F.pmod(F.xxhash64(F.lit(9), "id"), F.lit(1 << 20)) < share * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = vocabulary(model_file)[1]
        table = np.full(sp.get_piece_size(), -1, np.int64)
        table[list(ids)] = list(ids.values())
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = totals.setdefault(lang, np.zeros(max(ids.values()) + 1, np.int64))
                for lo in range(0, len(text), 100_000):
                    found = table[np.array(sp.encode(text[lo:lo + 100_000]), np.int64)]
                    own += np.bincount(found[found >= 0], minlength=len(own))
        for lang, own in totals.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(at)), pa.array(at, pa.int32()), pa.array(own[at])], names=["lang", "piece", "n"])

    counted = some.select("lang", "text").mapInArrow(count, "lang string, piece int, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    counts = np.full((len(languages), len(pieces)), SMOOTH)
    for r in counted.collect():
        counts[languages.index(r["lang"]), r["piece"]] += r["n"]
    return languages, counts / counts.sum(axis=1, keepdims=True)


def predict(docs: DataFrame, languages: list[str], probabilities: np.ndarray, model_file: str) -> DataFrame:
    """doc_id, lang_pred, score of every row of ``docs`` (doc_id, text; other columns are ignored).

    The score is the share of the best language in the text's probability under
    all.  Null, empty and letterless texts are ``und`` with score 0, and so are
    all if no language was learned; a tie goes to the first language by name.
    Rows that repeat an id, or have none, are each predicted.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((languages, probabilities.astype(np.float64)))  # languages x vocabulary: a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, p = shared.value
        scorer = None
        for batch in batches:
            scorer = scorer or Scorer(vocabulary(model_file)[0], p)
            best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for w in split_words(batch.column(1)):
                if not len(w.hashes) or not names:
                    continue
                sums = np.concatenate([np.zeros((1, len(names))), np.cumsum(scorer.words(w), axis=0)])
                total = sums[w.bounds[1:]] - sums[w.bounds[:-1]]
                rows = slice(w.first, w.first + w.n_docs)
                best[rows] = total.argmax(axis=1)
                score[rows] = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            told = batch.column(2).to_numpy(zero_copy_only=False).astype(bool) & bool(names)
            pred = pa.array([names[b] if t else "und" for b, t in zip(best, told, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pred, pa.array(np.where(told, score, 0.0))], names=["doc_id", "lang_pred", "score"])

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", lettered.alias("lettered")).mapInArrow(
        run, "doc_id long, lang_pred string, score double")
