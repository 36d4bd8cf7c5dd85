"""Operators 11 to 13 against brute force, and their edge cases."""
import collections
import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nextbuy.llm import collocations, suffix_dedup, whitening
from nextbuy.llm.words import text_bytes
from tests.llm.test_llm import LONG, no_docs, odd_docs, texts


def holders(rows):
    """(doc, text) rows -> window bytes -> smallest document."""
    low = {}
    for doc, text in rows:
        raw = (text or "").encode()
        for p in range(len(raw) - 49):
            w = raw[p:p + 50]
            low[w] = min(low.get(w, doc), doc)
    return low


def cut(doc, text, low):
    """(n_bytes, spans, kept) by looking at every window."""
    raw = (text or "").encode()
    gone = bytearray(len(raw))
    for p in range(len(raw) - 49):
        if low.get(raw[p:p + 50], doc) < doc:
            gone[p:p + 50] = b"\1" * 50
    spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
    return len(raw), spans, bytes(c for c, g in zip(raw, gone, strict=True) if not g)


def repeat_rows(seed=5):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeéü ") for _ in range(r.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, base = prose(30), prose(60)
    rows = [(i, prose(r.randint(0, 40))) for i in range(30)]
    rows += [(30 + i, prose(5) + passage + prose(5)) for i in range(6)]
    rows += [(40 + i, base[:100 + i] + "#" * i + base[100 + i:]) for i in range(8)]
    rows += [(50 + i, base) for i in range(3)]
    rows += [(60, "-" * 300), (61, "x" + "-" * 200 + "y"), (62, "ab" * 90), (63, "b" + "ab" * 70), (64, passage[:49]), (65, passage[3:53]), (66, "é" * 40),
             (67, base + base), (68, None), (69, "")]
    r.shuffle(rows)
    return rows


def check_spans(out, rows):
    low = holders([(d, t) for d, t in rows if d is not None])
    want = collections.Counter()
    for d, t in rows:
        n, spans, kept = cut(d, t, low) if d is not None else (len((t or "").encode()), [], (t or "").encode())
        want[(d, n, tuple(spans), kept)] += 1
    got = collections.Counter((r.doc_id, r.n_bytes, tuple((s.start, s.stop) for s in r.spans), bytes(r.kept)) for r in out.collect())
    assert got == want
    return want


@pytest.mark.parametrize("hot,bucket", [(1 << 14, 1 << 22), (0, 1 << 22), (3, 2000)])
def test_repeats_brute_force(spark, monkeypatch, hot, bucket):
    monkeypatch.setattr(suffix_dedup, "HOT_PIECES", hot)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", bucket)
    rows = repeat_rows()
    want = check_spans(suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)), rows)
    assert sum(len(k[2]) for k in want) > 15


def test_repeats_edges(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check_spans(suffix_dedup.remove_repeats(docs), rows)
    assert suffix_dedup.remove_repeats(no_docs(spark)).collect() == []


def test_pieces_hold_each_window_once(monkeypatch):
    column = pa.array([t for _, t in repeat_rows()] + [LONG])
    data, offsets = text_bytes(column)
    want = {(d, p) for d in range(len(column)) for p in range(offsets[d + 1] - offsets[d] - 49)}
    for size in (1 << 19, 777):
        monkeypatch.setattr(suffix_dedup, "BLOCK_STARTS", size)
        got = [(int(d), int(p) + k) for text, pos, run, _, _ in suffix_dedup.pieces_of(data, offsets)
               for d, p, n in zip(text, pos, run, strict=True) for k in range(n)]
        assert len(got) == len(want) and set(got) == want


def test_equal_windows_have_equal_seeds():
    rows = [t for _, t in repeat_rows() if t]
    data, offsets = text_bytes(pa.array(rows))
    seeds = {}
    for text, pos, run, seed, _ in suffix_dedup.pieces_of(data, offsets):
        for d, p, n, s in zip(text, pos, run, seed, strict=True):
            for k in range(n):
                at = int(offsets[d] + p + k)
                assert seeds.setdefault(data[at:at + 50].tobytes(), s) == s


def test_shares_split_the_pieces(monkeypatch):
    """The shares together are all pieces, also of texts without a byte or shorter than a window."""
    monkeypatch.setattr(suffix_dedup, "BLOCK_STARTS", 301)
    data, offsets = text_bytes(pa.array([None, "", "x", *(t for _, t in repeat_rows()), "", "y" * 49, "z" * 50, ""]))
    rows = lambda share: sorted(x for block in suffix_dedup.pieces_of(data, offsets, share) for x in zip(*(c.tolist() for c in block), strict=True))
    parts = [rows(k) for k in range(suffix_dedup.PASSES)]
    assert all(parts) and sorted(x for p in parts for x in p) == rows(None)
    assert all(x[3] % suffix_dedup.PASSES == k for k, p in enumerate(parts) for x in p)


def test_pieces_take_little_room():
    """Arrays that outgrow a core's cache made the search for pieces twice as slow."""
    r = np.random.default_rng(2)
    data, offsets = text_bytes(pa.array(["".join(map(chr, r.integers(97, 123, 1 << 16))) for _ in range(32)]))
    tracemalloc.start()
    n = sum(len(block[0]) for block in suffix_dedup.pieces_of(data, offsets))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 50_000 and peak < 8 << 20


def test_spans_merge_within_their_text():
    """Overlapping and touching spans are one; spans of neighbouring texts are not, nor do null lists, empty texts or slices matter."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    spans = [[(0, 3)], [(5, 10), (0, 2), (2, 4), (6, 7)], None, [], [], [(0, 10), (0, 10)], [(0, 1)]]
    texts_ = ["xyz", "0123456789", "kept", "", "kéé", "aaaaaaaaaa", "bcd"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(7)), pa.array(texts_),
         pa.array([x if x is None else [{"start": a, "stop": b} for a, b in x] for x in spans], kind)], names=["doc", "text", "spans"])
    want = [(3, [(0, 3)], b""), (10, [(0, 4), (5, 10)], b"4"), (4, [], b"kept"), (0, [], b""), (5, [], "kéé".encode()), (10, [(0, 10)], b""), (3, [(0, 1)], b"cd")]
    for lo, n in ((0, 7), (1, 4), (2, 3), (5, 2), (3, 0)):
        out = next(suffix_dedup._kept(iter([batch.slice(lo, n)]))).to_pylist()
        assert [(r["n_bytes"], [(x["start"], x["stop"]) for x in r["spans"]], r["kept"]) for r in out] == want[lo:lo + n]
        assert [r["doc_id"] for r in out] == list(range(lo, lo + n))


def test_cover_reaches_every_distance():
    for a in range(31):
        for b in range(31):
            d = suffix_dedup._REACH[a, b]
            assert d < 31 and (a + d) % 31 in suffix_dedup.COVER and (b + d) % 31 in suffix_dedup.COVER


@pytest.mark.parametrize("block", [1 << 18, 100])
def test_suffixes_in_order(monkeypatch, block):
    """Long ties, which only the cover's ranks settle: texts of two letters and of one."""
    monkeypatch.setattr(suffix_dedup, "BLOCK_SUFFIXES", block)
    r = random.Random(3)
    unit = "".join(r.choice("ab") for _ in range(45))
    text = (unit * 20 + "c" + unit * 10 + "a" * 200 + "".join(r.choice("ab") for _ in range(500))).encode()
    data = np.frombuffer(text, np.uint8)
    starts = np.arange(len(text) - 49)
    docs = np.array([r.randint(0, 50) for _ in starts])
    low = {}
    for p, d in zip(starts, docs, strict=True):
        low[text[p:p + 50]] = min(low.get(text[p:p + 50], 99), d)
    assert suffix_dedup.first_holders(data, starts, docs).tolist() == [low[text[p:p + 50]] for p in starts]
    padded = np.concatenate([data, np.zeros(95, np.uint8)]).astype(np.uint64)
    for s in (1, 2, 4):
        padded = (padded[:-s] << np.uint64(8 * s)) | padded[s:]
    order = suffix_dedup.sort_block(padded, suffix_dedup.cover_ranks(padded, len(text) + 31), starts)
    assert [text[p:p + 50] for p in order] == sorted(text[p:p + 50] for p in starts)


def phrases(rows, top):
    """The contract, in plain Python."""
    counts, total = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split(r"[.,;:!?\n-\r]", folded):
            ws = [w for w in re.split(r"[ \t]+", piece) if w]
            total[lang] += len(ws)
            for m in (1, 2, 3):
                for i in range(len(ws) - m + 1):
                    counts[lang][tuple(ws[i:i + m])] += 1
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= 10}
        found = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, _, left, right = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def phrase_rows(seed=9):
    r = random.Random(seed)
    rows = []
    for i in range(300):
        words = [r.choice(["of", "the", "New", "york", "city", "été", "a\xa0b", "x1"]) for _ in range(r.randint(0, 30))]
        for _ in range(r.randint(0, 3)):
            words[r.randint(0, len(words)):0] = r.choice([["new", "york", "city"], ["grand", "central"], ["é", "ü", "ö"]])
        rows.append((r.choice(["en", "fr", None, "und"]), "".join(w + r.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "!"]) for w in words)))
    return rows


def read(out):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in out.collect())


@pytest.mark.parametrize("top", [2000, 5])
def test_collocations_brute_force(spark, top):
    rows = phrase_rows()
    got = read(collocations.collocations(spark.createDataFrame(rows, "lang string, text string").repartition(4), top))
    assert got == phrases(rows, top) and len(got) >= 3 * min(top, 10)


def test_late_activation_counts_every_shard(spark):
    """Words that reach the threshold in the last shard only: their phrases are counted in the cycle after it."""
    rows = [("en", f"rare pair here filler{i}") for i in range(14)] + [("en", f"alone{i}") for i in range(500)]
    assert read(collocations.collocations(spark.createDataFrame(rows, "lang string, text string"))) == phrases(rows, 2000)


def test_collocations_edges(spark):
    docs = odd_docs(spark)
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    assert read(collocations.collocations(docs)) == phrases(rows, 2000)
    assert collocations.collocations(no_docs(spark)).collect() == []


def test_phrase_words_across_blocks(monkeypatch):
    column = pa.array([t for _, t in phrase_rows()] + [LONG, None, "", "last words"])
    lang = np.zeros(len(column), np.uint64)
    whole = [np.concatenate(x) for x in zip(*collocations.words_of(column, lang), strict=True)]
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 200)
    parts = [np.concatenate(x) for x in zip(*collocations.words_of(column, lang), strict=True)]
    for a, b in zip(whole, parts, strict=True):
        assert a.tolist() == b.tolist()


def spectrum(kind, d=24, seed=2):
    r = np.random.default_rng(seed)
    q = np.linalg.qr(r.standard_normal((d, d)))[0]
    e = {"spread": 2.0 ** -np.arange(d), "ties": np.repeat([9.0, 4.0, 1.0], d // 3), "close": 1 + 1e-7 * np.arange(d),
         "deficient": np.r_[np.arange(1.0, 6.0), np.zeros(d - 5)], "flat": np.ones(d)}[kind]
    return q @ np.diag(e) @ q.T, np.sort(e)[::-1]


@pytest.mark.parametrize("kind", ["spread", "ties", "close", "deficient", "flat"])
def test_sliced_spectrum(kind):
    v, e = spectrum(kind)
    v = (v + v.T) / 2
    for shift in np.r_[e[::5] * 1.0001 + 1e-6, e[::5] * 0.9999 - 1e-6, -1.0]:
        assert whitening.below(v, shift) == int((np.linalg.eigvalsh(v) < shift).sum())
    values, vectors = whitening.leading(v, 16)
    assert np.allclose(values, e[:16], rtol=1e-9, atol=1e-9)
    assert np.allclose(vectors.T @ vectors, np.eye(16), atol=1e-7)
    assert np.allclose(v @ vectors, vectors * values, atol=1e-8)


def test_whitening_brute_force(spark):
    r = np.random.default_rng(4)
    base = (r.standard_normal((300, 20)) @ r.standard_normal((20, 20))).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(300 + i, rows[0][1]) for i in range(200)] + [(7, rows[9][1]), (None, rows[3][1])]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)).collect()
    x = np.floor(base.astype(np.float64) * 64).astype(np.int64) + 1000000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    cov = np.cov(fit.T, bias=True)
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    assert len(out) == len(rows) * 16
    for o in out:
        if o.vec_id is None or o.vec_id in (7, 9):
            continue
        i = 0 if o.vec_id >= 300 else o.vec_id
        k = o.component - 1
        assert o.n == n and o.deviation == int(((n * x[i] - s) ** 2).sum())
        assert abs(abs(o.whitened) - abs((x[i] - s / n) @ q[:, k] / e[k] ** 0.5)) < 1e-7
        assert abs(o.explained - e[k] / np.trace(cov)) < 1e-9 and o.identity_error < 1e-8
    signs = {o.component: np.sign(o.whitened * ((x[o.vec_id] - s / n) @ q[:, o.component - 1])) for o in out if o.vec_id == 1}
    assert all(np.sign(o.whitened * ((x[o.vec_id] - s / n) @ q[:, o.component - 1])) == signs[o.component] for o in out if o.vec_id in range(10, 60))


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<float>"
    nan, inf = float("nan"), float("inf")
    rows = [(0, None), (1, []), (2, [1.0, None, 2.0]), (3, [nan, 1.0, 1.0]), (4, [1.0, -inf, 1.0]), (5, [1.0, 2.0]), (6, [3e38, 1.0, 1.0])]
    good = [(10 + i, [float(i), float(i * i % 7), 3.0]) for i in range(12)]
    df = spark.createDataFrame(rows + good, schema)
    for c in ("component", "n", "x", "whitened", "d", "count"):
        df = df.withColumn(c, F.lit("clash"))
    out = whitening.whiten(df).collect()
    assert {o.vec_id for o in out} == set(range(10, 22)) and {o.component for o in out} == {1, 2}
    assert whitening.whiten(spark.createDataFrame(rows, schema)).collect() != None  # noqa: E711
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    wide = [(i, [float(2 ** 40 + 2 ** 33 * i), float(i % 3)]) for i in range(5)]
    assert {o.deviation for o in whitening.whiten(spark.createDataFrame(wide, "vec_id long, embedding array<double>")).collect()} >= {None}
