"""The training-data operators on small tables, against brute force, round trips and edge cases."""
import collections
import hashlib
import io
import random
import re
from math import comb

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nextbuy.llm import chat, decontaminate, hyperminhash, langid, mixing, nbsvm, quality_rules, token_counts, url_rules, warc
from nextbuy.llm.queries import QUERIES, tokenizer_path
from nextbuy.llm.oracles import ORACLES
from nextbuy.llm.words import split_words, window_hashes
from tests.oracle_check import compare, duck

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BPE = tokenizer_path("byte_bpe_50k.json")
PIECES = tokenizer_path("piece_bpe_32k.model")
LONG = "word " * 3000 + "x" * 70_000 + "\n" + "é ü " * 2000


def texts(n=40, seed=1):
    r = random.Random(seed)
    return [" ".join(r.choice(["the", "of", "and", "over", "river", "Paris", "12", "kg"]) + str(r.randint(0, 60)) * r.randint(0, 1) for _ in range(r.randint(1, 120))) for _ in range(n)]


def odd_docs(spark):
    """Nulls everywhere, empty and very long texts, repeated rows and ids, clashing extra columns."""
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts())]
    rows += [(100, None, None, None, None), (101, "", "en", "s", 0), (102, " \n\t", "fr", "s", 1), (103, LONG, "en", None, 5),
             (0, rows[0][1], "en", "s", 1), (1, "another text under an old id", "en", "s", 1), (None, rows[2][1], "en", "s", 1), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("kept", "score", "component_id", "quality", "mix", "n_words", "rep", "key", "label", "weight", "topic", "first", "digest"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twin(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES[name], SMALL)
    assert r["cols"] and r["rows"] and r["values"], r


def test_words_across_blocks(monkeypatch):
    import nextbuy.llm.words as W

    column = pa.array([*texts(), None, "", LONG, " a  b\x0bc\x1cd\u00a0e "])
    monkeypatch.setattr(W, "BLOCK_BYTES", 500)
    found = [w.data[a:b].tobytes().decode() for w in split_words(column) for a, b in zip(w.starts, w.ends)]
    assert found == [x for t in column.to_pylist() for x in WORD.findall(t or "")]
    small = np.concatenate([w.hashes for w in split_words(column)])
    monkeypatch.setattr(W, "BLOCK_BYTES", 1 << 21)
    assert (small == np.concatenate([w.hashes for w in split_words(column)])).all()
    assert len(window_hashes(small[:3], 5)) == 0


# -- 1

def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_chat_round_trip(spark):
    says = ["</s>[INST] ok [/INST]", "<\\/s> <\\\\/s> <|turn|><|text|><|end|>", "", None, LONG, "<<|turn|>|turn|>", "\U0001f600 <|endoftext|>"]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(says)] + [(2, 0, None, "x"), (None, None, "assistant", "y"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same")]
    turns = chat.format_turns(conversations(spark, rows).withColumn("ids", F.lit(1)), BPE)
    got = {r.conv_id: r for r in chat.read_back(turns, BPE).collect()}
    for conv in {r[0] for r in rows}:
        own = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        learned = "".join(t for r, t in own if r == "assistant")
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    for t in filter(None, says):
        assert chat.unescape(chat.escape(t)) == t and not any(c in chat.escape(t) for c in chat.CONTROL)
    placed = chat.place_turns(turns).filter("conv_id = 1").orderBy("number").collect()
    assert [p.first_token for p in placed] == list(np.cumsum([0] + [len(p.ids) for p in placed])[:-1])
    assert chat.read_back(chat.format_turns(conversations(spark, []), BPE), BPE).count() == 0


# -- 2

class Bytes(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_warc_round_trip(spark):
    big = "<p>" + "ü" * 200
    rows = [(5, "http://a/\r\nX: y", big), (3, None, big), (9, "http://b", big), (4, "u", None), (6, "u", "tiny"), (7, "u", "tiny"), (None, "u", big), (3, None, big), (8, "u", "WARC/1.1\r\n" * 50), (10, "u", LONG)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).withColumn("first", F.lit(1))
    got = sorted((tuple(r) for r in warc.page_digests(warc.read_archives(warc.write_archives(pages))).collect()), key=str)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = [(p, len((h or "").encode()), sha(h), "revisit" if h == big and p != 3 else "response", 3 if h == big and p != 3 else None) for p, _, h in rows]
    assert got == sorted(want, key=str)
    assert warc.page_digests(warc.read_archives(warc.write_archives(pages.limit(0)))).count() == 0


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_recovers_later_records(packed):
    r = random.Random(3)
    records = [warc.encode_record(k, "u", (f"page {k} WARC/1.1\r\n" * r.randint(1, 30)).encode(), "0" * 64, 1, None) for k in range(30)]
    stored = [warc.member(x) if packed else x for x in records]
    whole = list(warc.salvage(Bytes(b"".join(stored))))
    assert [int(x.headers["x-page-id"]) for x in whole] == list(range(30))
    for _ in range(60):
        data, hit = bytearray(b"".join(stored)), set()
        starts = np.cumsum([0] + [len(x) for x in stored])
        for _ in range(r.randint(1, 3)):
            at = r.randrange(len(data))
            data[at] ^= r.randint(1, 255)
            hit.add(int(np.searchsorted(starts, at, "right")) - 1)
        end = len(data) - r.choice([0, 0, 5])
        found = list(warc.salvage(Bytes(bytes(data[:end]))))
        assert sum(x.length for x in found) == end and [x.offset for x in found] == list(np.cumsum([0] + [x.length for x in found])[:-1])
        intact = set(range(30)) - hit - ({29} if end < len(data) else set())
        assert intact <= {int(x.headers.get("x-page-id", -1)) for x in found if x.reason is None}


# -- 3

def plain_count(t):
    return len(token_counts.load_tokenizer(BPE).encode(t, add_special_tokens=False).ids)


def test_token_counts(spark):
    rows = {r.doc_id: r for r in token_counts.count_tokens(odd_docs(spark).dropDuplicates(["doc_id"]), BPE, tokenizer_path("byte_bpe_50k.tiktoken")).collect()}
    for r in odd_docs(spark).dropDuplicates(["doc_id"]).collect():
        assert rows[r.doc_id].n_tokens == plain_count(r.text or ""), r.doc_id
        assert rows[r.doc_id].n_bytes == len((r.text or "").encode()) and rows[r.doc_id].over_limit == (rows[r.doc_id].n_tokens > 512)
    assert token_counts.count_tokens(no_docs(spark), BPE).count() == 0


def test_splicing_is_exact():
    tokenizer, r = token_counts.load_tokenizer(BPE), random.Random(5)
    parts = ["the", " river", "\n\n", "  ", "'re", "'", " 12", "x" * 300, "é", "\u00a0", "\u3000", "<|endoftext|>", "<|endof", "text|>", ".", "???", "\t", " \u2003", "日本語"]
    counter = token_counts.Counter(BPE, tokenizer_path("byte_bpe_50k.tiktoken"))
    for _ in range(150):
        t = "".join(r.choice(parts) for _ in range(r.randint(1, 300)))
        want = len(tokenizer.encode(t, add_special_tokens=False).ids)
        assert token_counts.count_huge(t, tokenizer, chunk=r.choice([60, 200]), overlap=r.choice([10, 40])) == want, t
        assert counter.column(pa.array([t, None, t]))[1].tolist() == [want, 0, want], t


def test_plain_characters_count_alike():
    counter, r = token_counts.Counter(BPE, tokenizer_path("byte_bpe_50k.tiktoken")), random.Random(6)
    plain = ["\n", *map(chr, range(0x20, 0x7F)), *map(chr, range(0xC0, 0x180))]
    column = ["".join(r.choice(plain) for _ in range(r.randint(1, 80))) for _ in range(3000)] + plain + ["the 's 're  a\n\n b" + c + "x1" + c + " " + c for c in plain]
    assert counter.column(pa.array(column))[1].tolist() == [len(x.ids) for x in counter.tokenizer.encode_batch(column, add_special_tokens=False)]


# -- 4

def test_raking_meets_marginals():
    r = np.random.default_rng(1)
    tokens = r.integers(1, 500, (4, 3, 2)).astype(float)
    goals = [np.array([.4, .3, .2, .1]), np.array([.5, .25, .25]), np.array([.7, .3])]
    shares = mixing.rake(tokens, goals)
    for axis, goal in enumerate(goals):
        assert np.allclose(shares.sum(axis=tuple(a for a in range(3) if a != axis)), goal, atol=1e-6)
    odds = lambda x: x[0, 0, 0] * x[1, 1, 0] / x[0, 1, 0] / x[1, 0, 0]
    assert np.isclose(odds(shares), odds(tokens))  # raking keeps the interactions
    p = mixing.probabilities(tokens, shares, 0.5 * tokens.sum())
    assert p.max() <= 1 and np.isclose((p * tokens).sum(), 0.5 * tokens.sum())
    assert np.isclose((mixing.probabilities(tokens, shares, 2 * tokens.sum()) * tokens).sum(), tokens.sum())


def test_mix(spark):
    docs = odd_docs(spark)
    rows = mixing.mix(docs).select("doc_id", "text", "mix.*").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.n_tokens == len(WORD.findall(r.text or "")) and 0 <= r.probability <= 1 and (r.n_tokens or not r.selected)
    assert mixing.mix(no_docs(spark)).count() == 0


def test_topics(spark):
    cases = {"All Rights Reserved": "legal", "ALL RIGHTS RESERVED": "legal", "x COPYRIGHT 2020": "legal", "LICENSED UNDER the": "legal", "license under a": "legal", "Licence Under": "legal",
             "licensing under": "prose", "at @ noon": "prose", "a@b": "prose", "see a.b@c-d.org now": "contact", "call +49 (30) 1234": "contact", "1 + 2": "prose",
             "a | b": "prose", "a | b | c": "table", "a | b\nc | d": "prose", "in 1999": "figures", "in 199": "prose", "": "none", None: "none"}
    got = spark.createDataFrame([(k, v) for k, v in cases.items()], "text string, want string").withColumn("topic", mixing.topic_of(F.col("text"))).collect()
    assert not [r for r in got if r.topic != r.want]
    legal, contact, table = re.compile(r"licen[sc]ed? under|all rights reserved|copyright", re.I | re.A), re.compile(r"[\w.+-]+@[\w-]+\.\w|\+\d[\d ()-]{6,}", re.A), re.compile(r" \| .* \| ")
    want = lambda t: "none" if not t else next((n for n, p in (("legal", legal), ("contact", contact), ("table", table), ("figures", re.compile(r"\d{4,}", re.A))) if p.search(t)), "prose")
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("text", mixing.topic_of(F.col("text")).alias("topic")).collect()
    assert all(r.topic == want(r.text) for r in rows)


def test_mix_draws_the_budget(spark):
    got = QUERIES["op4_mixing"](spark, "/root/testdata/sf0.01")
    all_, drawn, aim = got.agg(F.sum("n_tokens"), F.sum(F.expr("n_tokens * int(selected)")), F.sum(F.expr("n_tokens * probability"))).first()
    assert abs(aim / all_ - mixing.BUDGET) < 1e-6 and abs(drawn / all_ - mixing.BUDGET) < 0.12


# -- 5

def test_decontamination(spark):
    r = random.Random(2)
    filler = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n)) + "."
    item = "A farmer in Leeds sells 12 kg of apples and 7 kg of pears. How many kg does the farmer in Leeds sell when 12 kg are left over at noon?"
    other = item.replace("Leeds", "Turin").replace("12", "45").replace("7", "9").replace("kg", "lb")
    loose = "A farmer in Oslo sells 1 kg of apples and 2 lb of pears. How many oz does the farmer in Rome sell when 3 mg are left over at noon?"
    plain = filler(30)
    rows = [(1, filler(50) + " " + item + " " + filler(50)), (2, filler(9) + "\n" + other), (3, filler(80)), (4, loose), (5, None), (6, ""), (None, item),
            (7, plain.upper().lower() + " " + filler(5)), (7, plain), (8, " ".join(plain.split()[:12])), (9, LONG), (10, LONG + item), (11, "one two three four")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("window", F.lit(1)).withColumn("item_id", F.lit(1))
    bench = spark.createDataFrame([(1, item), (2, plain), (3, None), (4, ""), (5, "of the"), (6, "one two three four"), (None, "abc")], "item_id long, text string").withColumn("slots", F.lit(0))
    got = {(x.doc_id, x.item_id): x.exact for x in decontaminate.leaks(docs, bench).collect()}
    assert got == {(1, 1): True, (2, 1): False, (7, 2): True, (10, 1): True, (11, 6): True}
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns and sorted(str(x.doc_id) for x in left.collect()) == ["3", "4", "5", "6", "8", "9", "None"]
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0 and decontaminate.leaks(docs.limit(0), bench).count() == 0


def test_decontamination_by_occurrence(spark):
    item = "A farmer in Leeds sells 12 kg of apples and 7 kg of pears. How many kg does the farmer in Leeds sell when 12 kg are left over at noon?"
    other = lambda name, a, b: item.replace("Leeds", name).replace("12", a).replace("7", b)
    loose = "A farmer in Oslo sells 1 kg of apples and 2 lb of pears. How many oz does the farmer in Rome sell when 3 mg are left over at noon?"
    drift = other("New York", "45", "9")
    rows = [(1, item + " " + other("Turin", "45", "9")), (2, "\n".join(other(x, a, b) for x, a, b in (("Turin", "45", "9"), ("Bonn", "3", "8"), ("Lyon", "66", "1")))),
            (3, loose), (4, loose + " " + loose.replace("Oslo", "Bonn")), (5, " ".join(other("Bonn", "3", "8").split()[:12]) + " " + item), (6, drift + " x " + other("Bonn", "3", "8")),
            (7, other("Turin", "45", "9")), (7, other("Bonn", "3", "8"))]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {x.doc_id: x.exact for x in decontaminate.leaks(docs, bench).collect()} == {1: True, 2: False, 5: True, 6: False, 7: False}


def test_decontamination_without_literals(spark):
    plain = "the farmer sells apples and pears at the market in the old town of Leeds on every second day of spring and é or ж"
    items = [plain.title(), plain.upper(), "What comes next: 1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610, 987, 1597?", plain,
             "7 31 64 90", "Alice Bob Carol Dave Erin Frank Grace Heidi Ivan Judy"]
    docs = [f"some words before\n{x}\nand some after" for x in items] + ["numbers 2 4 6 8 10 12 14 16 18 20 22 24 26 28 30 32 34 36", "Bob Alice Dave Carol Frank Erin Heidi Grace Judy Ivan"]
    got = decontaminate.leaks(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    cased = {(a, b) for a in (0, 1, 3) for b in (0, 1, 3)}
    assert {(x.doc_id, x.item_id) for x in got} == cased | {(2, 2), (4, 4), (5, 5)} and all(x.exact for x in got)


def test_decontamination_shuffled_windows(spark, monkeypatch):
    want = {tuple(x) for x in QUERIES["op5_decontamination"](spark, SMALL).collect()}
    monkeypatch.setattr(decontaminate, "IN_MEMORY", 0)
    assert want and {tuple(x) for x in QUERIES["op5_decontamination"](spark, SMALL).collect()} == want


def test_whole_items_are_found(spark, con):
    squeeze = lambda t: " ".join(WORD.findall(t))
    docs, items = (con.sql(q).fetchall() for q in ("select doc_id, text from documents", "select item_id, text from benchmark"))
    want = {(d, i) for d, t in docs for i, b in items if squeeze(b) in squeeze(t)}
    got = {(x.doc_id, x.item_id) for x in QUERIES["op5_decontamination"](spark, SMALL).collect()}
    assert want and want <= got and len(got - want) <= 0.02 * len(want)


# -- 6

def brute_counts(t):
    w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
    tri = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), len(lines)]


def test_quality_counts():
    column = [*texts(), "", " \n ", LONG, "a b c a b c\na b c a b c\n a b c", "é|é & ü\n\n\x0b\né|é & ü", "x x x x"]
    assert quality_rules.count_batch(pa.array([*column, None])).tolist() == [brute_counts(t) for t in [*column, ""]]


def test_cutoffs_keep_their_risk():
    r, broken = random.Random(7), 0
    for _ in range(200):  # the true false rejection rate of a cutoff must not exceed the limit but with the error
        rate = quality_rules.LIMIT / len(quality_rules.RULES) * 1.2
        good = sum(r.random() < rate for _ in range(1500))
        counts = [("s", "symbols", 1, 0, good), ("s", "symbols", 1, 6, 1500 - good), ("s", "symbols", 0, 0, 500)]
        broken += bool(quality_rules.choose_cutoffs(counts))
    assert broken <= 200 * quality_rules.ERROR + 12
    assert quality_rules.choose_cutoffs([("s", "symbols", 1, 6, 2000), ("s", "symbols", 0, 2, 50)]) == [("s", "symbols", 50)]
    assert quality_rules.choose_cutoffs([("s", "symbols", 1, 6, 20), ("s", "symbols", 0, 2, 50)]) == []  # too few labels
    assert quality_rules.choose_cutoffs([("s", "symbols", 1, 6, 2000)]) == []
    assert np.isclose(quality_rules.at_most(3, 40, .1), sum(comb(40, i) * .1**i * .9**(40 - i) for i in range(4)))


def test_quality_edges(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 7)], "doc_id long, quality int")
    rows = quality_rules.judge(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert list(r.quality[:6]) == brute_counts(r.text or "") and r.quality.kept == (not r.quality.base_failed)
    assert quality_rules.judge(no_docs(spark), labels.limit(0)).count() == 0


# -- 7

def test_url_parts(spark):
    cases = ["http://A.Example.NET/en/x?q=1#t", "https://m.x.org/fr/", "x://Host", "x://h?a/b", "x://h#a", "no scheme", None, "", "a://b://c/d", "http:///p", "http://É.NET/en/\nx"]
    def parts(u):
        if u is None or "://" not in u:
            return "", ""
        rest = u.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.split("[?#]", rest[len(host):])[0]
    def ruled(h, p):
        fits = [(len(a + b), a + b, v) for a, b, v in url_rules.RULES if (h == a or h.endswith("." + a)) and p.startswith(b)]
        return max(fits)[1:] if fits else (None, "allow")
    pages = spark.createDataFrame(list(enumerate(cases)) + [(1, cases[1]), (None, cases[0])], "page_id long, url string").withColumn("blocked", F.lit("clash")).withColumn("tokens", F.lit(1))
    none = url_rules.mine(spark.createDataFrame([], "url string, bad boolean"))
    got = url_rules.judge(pages, none).collect()
    assert len(got) == pages.count() and url_rules.judge(pages.limit(0), none).count() == 0
    for r, u in ((r, cases[r.page_id]) for r in got if r.page_id is not None):
        assert (r.host, r.path) == parts(u) and (r.rule, r.verdict) == ruled(r.host, r.path), u


def test_mined_rules(spark):
    r = random.Random(4)
    rows = []
    for k in range(3000):  # bad: casino hosts, and mirrors in /win/
        host, folder = r.choice(["casino", "mirror", "news", "blog"]), r.choice(["win", "en", "de"])
        rows.append((f"http://{host}{k % 7}.{host}.com/{folder}/{k}", host == "casino" or host == "mirror" and folder == "win"))
    labelled = spark.createDataFrame(rows + [(None, True), ("http://x.com", None)], "url string, bad boolean")
    mined = url_rules.mine(labelled, support=0.01, confidence=0.9)
    got = mined.collect()
    tokens = {u: set(t) for u, t in spark.createDataFrame(rows, "url string, bad boolean").select("url", url_rules.tokens_of(F.col("url"))).collect()}
    assert got
    for x in got:  # against a count over all rows
        fits = [b for u, b in rows if set(x.tokens) <= tokens[u]]
        assert np.isclose(x.support, sum(fits) / len(rows)) and np.isclose(x.confidence, sum(fits) / len(fits))
    urls = spark.createDataFrame([("http://casino1.casino.com/en/9999",), ("http://mirror2.mirror.com/win/1",), ("http://mirror2.mirror.com/en/1",), ("http://news1.news.com/win/1",), (None,)], "url string")
    assert {x.url for x in url_rules.match(urls, mined).collect()} == {"http://casino1.casino.com/en/9999", "http://mirror2.mirror.com/win/1"}
    assert {x.url for x in url_rules.match(labelled.select("url"), mined).collect()} == {u for u, b in rows if b}


# -- 8

def test_wide_rules(spark):
    four = ("p:aa", "p:bb", "p:cc", "p:dd")
    rows = []
    for i in range(160):  # bad only with all four words; "p:zz" alone is bad, with any others too
        some = [w for k, w in enumerate(four) if i >> k & 1]
        rows += [("/" + "/".join(w[2:] for w in some), len(some) == 4), ("/" + "/".join([w[2:] for w in some] + ["zz"]), True)]
    labelled = spark.createDataFrame([("https://h.net" + path, bad) for path, bad in rows], "url string, bad boolean")
    mined = {tuple(r.tokens): r.confidence for r in url_rules.mine(labelled, support=0.01, confidence=0.9).collect()}
    assert mined == {four: 1.0, ("p:zz",): 1.0}
    pages = spark.createDataFrame([("http://x.io/dd/cc/bb/aa",), ("http://x.io/dd/cc/bb",)], "url string")
    rules = url_rules.mine(labelled, support=0.01, confidence=0.9)
    assert [r.url for r in url_rules.match(pages, rules).collect()] == ["http://x.io/dd/cc/bb/aa"]


def test_classifier_held_out(spark):
    got = QUERIES["op8_quality_classifier"](spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert len(held) > 40 and sum(p == q for p, q in held) / len(held) >= 0.95


def test_classifier_edges(spark):
    docs = odd_docs(spark).drop("label")
    for pairs in ([], [(1, 1)], [(1, 1), (2, 0), (2, 1), (3, None), (None, 0), (103, 0)]):
        model = nbsvm.train(docs, spark.createDataFrame(pairs, "doc_id long, quality int"))
        rows = nbsvm.classify(docs, model).collect()
        assert len(rows) == docs.count() and all(0 <= r.quality_score <= 1 for r in rows)
    assert nbsvm.classify(no_docs(spark), model).count() == 0


# -- 9

def test_forward_sums_all_segmentations():
    pieces = [bytes([b]) for b in range(256)] + [b" a", b"ab", b"b", b"ba", b"aba", b" ab", "é".encode()]
    pieces = list(dict.fromkeys(pieces))
    p = np.random.default_rng(0).dirichlet(np.ones(len(pieces)), 3)
    scorer = langid.Scorer(pieces, p)
    def brute(text, lang):
        table = dict(zip(pieces, p[lang]))
        total = [1.0] + [0.0] * len(text)
        for j in range(1, len(text) + 1):
            total[j] = sum(total[j - k] * table.get(text[j - k:j], 0) for k in range(1, min(j, langid.LONGEST) + 1))
        return np.log(total[-1])
    words = ["abab", "é", "ba", "xyz", "a", "abaabab"]
    (w,) = split_words(pa.array([" ".join(words)]))
    got = scorer.words(w)
    for k, word in enumerate(words):
        assert np.allclose(got[k], [brute(b" " + word.encode(), lang) for lang in range(3)])
    (w,) = split_words(pa.array(["ab" * 5000]))
    long = scorer.words(w)
    assert np.isfinite(long).all() and (long < -700).all()


def test_language_whole_vocabulary(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    pieces, ids = langid.vocabulary(PIECES)
    assert max(map(len, pieces)) == langid.LONGEST
    left = [sp.id_to_piece(k) for k in range(sp.get_piece_size()) if k not in ids and not (sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k))]
    assert all(set(x) == {"▁"} for x in left)
    text = "government information understanding"
    docs = spark.createDataFrame([(i, text, "en") for i in range(50)] + [(99, "gouvernement", "fr")], "doc_id long, text string, lang string")
    languages, p = langid.train(docs, PIECES)
    at = {x: i for i, x in enumerate(pieces)}
    for k in sp.encode(text):
        assert p[0, ids[k]] > 10 * p[1, ids[k]]
    assert max(len(pieces[ids[k]]) for k in sp.encode(text)) > 8
    scorer = langid.Scorer(pieces, p)
    (w,) = split_words(pa.array([text + " правительство"]))
    got = scorer.words(w)
    for k, word in enumerate((text + " правительство").split()):
        b = b" " + word.encode()
        total = [1.0] + [0.0] * len(b)
        for j in range(1, len(b) + 1):
            total[j] = sum(total[i] * p[0, at[b[i:j]]] for i in range(j) if b[i:j] in at)
        assert np.isclose(got[k, 0], np.log(total[-1]))


def test_language_held_out(spark):
    got = QUERIES["op9_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    right, n = got.filter("held_out").join(docs, "doc_id").agg(F.avg(F.expr("double(lang_pred = lang)")), F.count("*")).first()
    assert n > 100 and right >= 0.97


def test_language_edges(spark):
    docs = odd_docs(spark)
    languages, p = langid.train(docs, PIECES)
    assert languages == ["en", "fr"]
    rows = langid.predict(docs.unionByName(docs.limit(1).withColumn("doc_id", F.lit(500).cast("long")).withColumn("text", F.lit("12 34 !!"))), languages, p, PIECES).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == docs.count() + 1 and all(0 <= r.score <= 1 for r in rows)
    assert [by[k].lang_pred for k in (100, 101, 102, 500)] == ["und"] * 4 and by[103].lang_pred == "en"
    assert langid.predict(no_docs(spark), languages, p, PIECES).count() == 0
    none = langid.train(no_docs(spark), PIECES)
    assert {r.lang_pred for r in langid.predict(docs, *none, PIECES).collect()} == {"und"}


# -- 10

def shingles(t):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()


def brute_groups(rows):
    up = {i: i for i, _ in rows}
    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    sets = [(i, shingles(t)) for i, t in rows]
    for i, s in sets:
        for j, t in sets:
            if i < j and s and 100 * len(s & t) >= 75 * len(s | t):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {i: top(i) for i, _ in rows}


def test_near_duplicates_brute_force(spark):
    r = random.Random(9)
    rows, base = [], [f"w{r.randint(0, 400)}" for _ in range(160)]
    passage = [f"p{k}" for k in range(60)]
    for k in range(260):
        kind = k % 4
        if kind == 0:  # edits of one text, some beyond the threshold
            words = list(base)
            for _ in range(r.randint(0, 12)):
                words[r.randrange(len(words))] = f"e{r.randint(0, 9999)}"
        elif kind == 1:  # a shared passage with a little or much of its own
            words = passage + [f"u{r.randint(0, 9999)}" for _ in range(r.randint(0, 30))]
        elif kind == 2:  # short texts
            words = [r.choice("ab") for _ in range(r.randint(0, 9))]
        else:
            words = [f"w{r.randint(0, 9999)}" for _ in range(r.randint(1, 200))]
        rows.append((k, r.choice([" ", "\n", "  "]).join(words)))
    got = hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_groups(rows)
    assert {x.doc_id: x.component_id for x in got} == want
    sizes = {i: len(shingles(t)) for i, t in rows}
    assert all(x.n_shingles == sizes[x.doc_id] and x.kept == (x.doc_id == x.component_id) for x in got)


def test_near_duplicate_edges(spark):
    docs = odd_docs(spark)
    rows = hyperminhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    for x in rows:
        assert x.kept == (x.doc_id is None or x.doc_id == x.component_id)
        if x.doc_id is None:
            assert x.component_id is None
        elif not x.n_shingles:
            assert x.component_id == x.doc_id
    assert hyperminhash.near_duplicates(no_docs(spark)).count() == 0


def test_estimate_is_corrected():
    r = np.random.default_rng(3)
    common, a, b = (np.unique(r.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)) for n in (3000, 500, 500))
    x, y = (hyperminhash.registers(np.union1d(common, own)) for own in (a, b))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([3500]), pa.array([3500]), pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], names=list("abcdef"))
    (out,) = hyperminhash._estimate(iter([batch]))
    assert abs(out.column(2)[0].as_py() - 0.75) < 0.12


# -- the pipeline

def test_pipeline(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "decontamination", "mixing"]
    for name, stage in P.STAGES:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        after = stage(spark, docs, SMALL)
        assert {r.doc_id for r in after.select("doc_id").collect()} <= before
        if name == "near_duplicates":
            rows = [(r.doc_id, r.text) for r in docs.collect()]
            groups = brute_groups(rows)
            assert {r.doc_id for r in after.collect()} == set(groups.values())
        if name != "mixing":
            assert after.columns == docs.columns
            docs = spark.createDataFrame(after.collect(), docs.schema)
    assert P.run(spark, SMALL).count() == after.count() > 0


def test_pipeline_classifier_learns_from_the_table(spark):
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labelled = docs.join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality"), "doc_id")
    good = labelled.filter("quality = 1").select(*docs.columns)  # as if the rules had rejected all labelled junk
    junk = labelled.filter("quality = 0").withColumn("doc_id", F.col("doc_id") + 10**9).select(*docs.columns)
    kept = P.classifier_stage(spark, good.unionByName(junk), sf)
    old, new = kept.filter("doc_id < 1000000000").count(), kept.filter("doc_id >= 1000000000").count()
    assert junk.count() > 20 and new < 0.1 * junk.count() and old > 0.9 * good.count()


def test_one_class_is_logged(caplog):
    nbsvm.fit([np.zeros(1, np.int32)] * 3, np.array([1, 1, 1]))
    assert "one class" in caplog.text


def test_pipeline_edges(spark):
    import corpus_pipeline as P

    docs = odd_docs(spark)
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0
        out = stage(spark, docs, SMALL)
        assert set(docs.columns) <= set(out.columns) and out.count() <= docs.count()
