"""Operator 7: the proven bound, long urls, small tables, and the query against an enumeration of all token sets."""
import itertools
import random
from math import comb

import pytest
from pyspark.sql import functions as F

from nextbuy.llm import url_rules
from nextbuy.llm.queries import QUERIES
from nextbuy.sources.tables import table

SMALL = "/root/testdata/sf0.001"


def tail(n, k, p):
    return sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k, n + 1))


def enumerated(rows, tokens, support, confidence, risk):
    """Rules by looking at every token set of every bad url: {tokens: confidence}."""
    n = len(rows)
    fewest = max(support * n, url_rules.least_count(risk, confidence))
    holders = {}
    for i, (u, _) in enumerate(rows):
        for t in tokens[u]:
            holders.setdefault(t, set()).add(i)
    first = {}
    for t in sorted(holders):
        first.setdefault(frozenset(holders[t]), t)
    useful = {t for s, t in first.items() if len(s) < n and sum(rows[i][1] for i in s) >= fewest}
    found = {}
    for u, bad in rows:
        if not bad:
            continue
        mine = sorted(tokens[u] & useful)
        for size in range(1, len(mine) + 1):
            for some in itertools.combinations(mine, size):
                if some not in found:
                    own = set.intersection(*(holders[t] for t in some))
                    found[some] = (sum(rows[i][1] for i in own), len(own))
    found = {s: (b, f) for s, (b, f) in found.items() if b >= fewest}
    out = {}
    for s, (b, f) in found.items():
        parts = [found[p] for k in range(1, len(s)) for p in itertools.combinations(s, k)]
        if b / f >= confidence and all(pb / pf < b / f for pb, pf in parts) and (risk is None or b > f * confidence and tail(f, b, confidence) <= risk / len(found)):
            out[s] = b / f
    return out


def tokens_by_url(spark, urls):
    return {u: set(t) for u, t in spark.createDataFrame([(u,) for u in urls], "url string").select("url", url_rules.tokens_of(F.col("url"))).collect()}


@pytest.mark.parametrize("n,k", [(6, 6), (20, 18), (300, 280), (5000, 3200), (200_000, 121_500), (10, 6), (10, 3), (1, 1)])
def test_tail_is_exact(spark, n, k):
    got = spark.range(1).select(url_rules.binomial_tail(F.lit(n), F.lit(k), 0.6)).first()[0]
    if k <= n * 0.6:
        assert got == 1.0
    elif n <= 300:
        assert got == pytest.approx(tail(n, k, 0.6), rel=1e-9)
    else:
        from fractions import Fraction
        term = Fraction(comb(n, k)) * Fraction(3, 5) ** k * Fraction(2, 5) ** (n - k) if n <= 5000 else None
        if term is not None:
            exact = 0.0
            for i in range(k, n + 1):
                exact += float(term)
                term = term * (n - i) / (i + 1) * Fraction(3, 2)
                if float(term) < exact * 1e-17:
                    break
            assert got == pytest.approx(exact, rel=1e-9)
        assert 0 < got < 1


@pytest.mark.parametrize("copies", [1, 6])
def test_long_url_is_one_item(spark, copies):
    """A bad url of 40 words, alone or in copies, among 50 good ones."""
    long = "http://spam.example.org/" + "-".join(f"w{chr(97 + i % 26)}{'x' * (i // 26)}" for i in range(40))
    rows = [(long, True)] * copies + [(f"http://good{chr(97 + i % 5)}.com/{'ab' if i % 2 else 'cd'}", False) for i in range(50)]
    mined = url_rules.mine(spark.createDataFrame(rows, "url string, bad boolean")).collect()
    assert len(mined) == 1 and len(mined[0].tokens) == 1 and mined[0].confidence == 1.0
    proven = url_rules.mine(spark.createDataFrame(rows, "url string, bad boolean"), risk=0.05).collect()
    assert len(proven) == (copies == 6)


@pytest.mark.parametrize("risk", [None, 0.05])
def test_rules_equal_the_enumeration(spark, risk):
    r = random.Random(8)
    rows = []
    for i in range(400):
        words = r.sample(["buy", "win", "news", "kids", "shop", "poker"], r.randint(1, 4))
        bad = ("win" in words and "poker" in words and r.random() < 0.97) or r.random() < 0.1
        rows.append((f"http://{r.choice(['a', 'b'])}.com/{'/'.join(words)}", bad))
    mined = url_rules.mine(spark.createDataFrame(rows, "url string, bad boolean"), 0.02, 0.6, risk).collect()
    got = {tuple(sorted(x.tokens)): x.confidence for x in mined}
    want = enumerated(rows, tokens_by_url(spark, {u for u, _ in rows}), 0.02, 0.6, risk)
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)
    assert ("p:poker", "p:win") in got


def test_chance_makes_no_rule(spark):
    """Labels that do not depend on the url: no rule is proven, though raw confidences of 0.6 and more occur."""
    r = random.Random(3)
    rows = [(f"http://h{r.randint(0, 30)}x.com/{chr(97 + r.randint(0, 25))}/{chr(97 + r.randint(0, 25))}", r.random() < 0.15) for _ in range(120)]
    df = spark.createDataFrame(rows, "url string, bad boolean")
    assert url_rules.mine(df, risk=0.05).collect() == []


def test_query_against_the_enumeration(spark):
    """The whole query: every page's verdict from the fixed rules and the enumerated ones."""
    got = {r.page_id: r for r in QUERIES["op7_url_rules"](spark, SMALL).collect()}
    import re
    pages = [(r.page_id, r.url) for r in table(spark, SMALL, "pages", "page_id", "url").collect()]
    labels = {r.doc_id: r.quality == 0 or r.toxic == 1 for r in table(spark, SMALL, "labels", "doc_id", "quality", "toxic").collect()}
    rows = []
    for _, u in pages:
        m = re.search(r"/([0-9]{1,18})(?:\.html|/)?$", re.split("[?#]", u.split("://", 1)[1].partition("/")[1] + u.split("://", 1)[1].partition("/")[2])[0]) if u and "://" in u else None
        if m and int(m[1]) in labels:
            rows.append((u, labels[int(m[1])]))
    tokens = tokens_by_url(spark, {u for _, u in pages if u is not None})
    rules = enumerated(rows, tokens, url_rules.SUPPORT, url_rules.CONFIDENCE, url_rules.RISK) if any(b for _, b in rows) else {}
    assert len(got) == len(pages)
    for page, u in pages:
        hit = u is not None and any(set(s) <= tokens[u] for s in rules)
        x = got[page]
        assert x.verdict == ("block" if x.rule in ("net/", "example.com/de/") else "allow" if x.rule else "block" if hit else "allow")
