"""Operators 4, 5 and 8 against plain versions: given targets, capitals beyond A-Z, the support vector fit."""
import logging
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nextbuy.llm import decontaminate, mixing, nbsvm


def mixed_docs(spark, n=400, seed=6):
    r = random.Random(seed)
    form = {"legal": "copyright notice ", "prose": "just words ", "figures": "in 1999 "}
    rows = [(i, form[r.choice(["legal", "prose", "prose", "figures"])] * r.randint(1, 9), r.choice(["en"] * 5 + ["de", None]), r.choice(["web"] * 6 + ["books", "code", None]))
            for i in range(n)]
    return spark.createDataFrame(rows + [(n, None, "en", "web"), (n + 1, "", "de", "web")], "doc_id long, text string, lang string, source string")


def plain_raking(cells, targets):
    """{cell: share} by dictionaries, one margin at a time."""
    total = sum(cells.values())
    share = {c: n / total for c, n in cells.items()}
    for _ in range(3000):
        for k, goal in enumerate(targets):
            now = {}
            for c, s in share.items():
                now[c[k]] = now.get(c[k], 0.0) + s
            share = {c: s * goal[c[k]] / now[c[k]] if now[c[k]] else 0.0 for c, s in share.items()}
    return share


def water(cells, share, budget):
    """{cell: probability}: min(1, level * share / tokens) with the level found by bisection."""
    low, high = 0.0, 1e12
    for _ in range(300):
        level = (low + high) / 2
        got = sum(min(n, level * share[c]) for c, n in cells.items())
        low, high = (level, high) if got < budget else (low, level)
    return {c: min(1.0, low * share[c] / n) if n else 0.0 for c, n in cells.items()}


@pytest.mark.parametrize("given", [None, {"source": {"web": 0.3, "books": 0.5, "code": 0.1, "": 0.1}, "topic": {"legal": 0.5, "prose": 0.25, "figures": 0.25}}])
@pytest.mark.parametrize("budget", [0.3, 0.95])
def test_weights_and_probabilities(spark, given, budget):
    rows = mixing.mix(mixed_docs(spark), given, budget).select("*", "mix.*").collect()
    key = lambda r: (r.source or "", r.lang or "", r.topic)
    cells = {}
    for r in rows:
        cells[key(r)] = cells.get(key(r), 0) + r.n_tokens
    total, targets = sum(cells.values()), []
    for k, margin in enumerate(("source", "lang", "topic")):
        own = {}
        for c, n in cells.items():
            own[c[k]] = own.get(c[k], 0) + n
        goal = {v: (given or {}).get(margin, {}).get(v, 0.0) if margin in (given or {}) else n if margin == "lang" else n ** mixing.FLATTEN for v, n in own.items()}
        goal = {v: g if own[v] else 0.0 for v, g in goal.items()}
        targets.append({v: g / sum(goal.values()) for v, g in goal.items()})
    share = plain_raking({c: n for c, n in cells.items() if n}, targets)
    chance = water({c: n for c, n in cells.items() if n}, share, budget * total)
    for r in rows:
        c = key(r)
        if not cells[c]:
            assert r.weight == r.probability == 0 and not r.selected
            continue
        assert r.weight == pytest.approx(share[c] * total / cells[c], rel=1e-5, abs=1e-9)
        assert r.probability == pytest.approx(chance[c], rel=1e-5, abs=1e-9) and r.miss < 1e-8


def test_margins_that_contradict_are_told(spark, caplog):
    """Source a has only en, b only de; equal sources and 9 : 1 languages cannot both hold."""
    docs = spark.createDataFrame([(1, "x y", "en", "a"), (2, "x y", "de", "b")], "doc_id long, text string, lang string, source string")
    with caplog.at_level(logging.WARNING):
        rows = mixing.mix(docs, {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.9, "de": 0.1}}).select("mix.miss").collect()
    assert all(r.miss == pytest.approx(0.4, abs=0.01) for r in rows) and "did not converge" in caplog.text


def test_too_many_cells_are_refused(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_CELLS", 20)
    docs = spark.range(50).select("id", F.lit("a b").alias("text"), F.lit("en").alias("lang"), F.col("id").cast("string").alias("source"), F.col("id").alias("doc_id"))
    with pytest.raises(ValueError, match="coarser"):
        mixing.mix(docs)


@pytest.mark.parametrize("item,names", [
    ("Фермер из Москвы продаёт двенадцать мешков яблок на рынке. Сколько мешков фермер из Москвы продаст к вечеру субботы?", ("Москвы", "Одессы")),
    ("La paysanne près de Évreux vend des pommes au marché. Combien de pommes la paysanne près de Évreux vend avant le soir?", ("Évreux", "Orléans")),
    ("Der Bauer aus Köln verkauft dort Äpfel. Wie viele davon verkauft der Bauer aus Köln bis zum Abend mit Frau Özil?", ("Özil", "Müller")),
    ("Ο γεωργός στην Αθήνα πουλάει μήλα στην αγορά. Πόσα μήλα πουλάει ο γεωργός στην Αθήνα ως το βράδυ;", ("Αθήνα", "Πάτρα")),
])
def test_renamed_items_beyond_ascii(spark, item, names):
    docs = spark.createDataFrame([(1, item), (2, item.replace(*names)), (3, "other words entirely " * 20)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {(r.doc_id, r.exact) for r in decontaminate.leaks(docs, bench).collect()} == {(1, True), (2, False)}


def labelled_texts():
    r = random.Random(4)
    good, bad = ["calm", "river", "reason", "notes", "and"], ["buy", "click", "free", "winner", "and"]
    rows = []
    for i in range(50):
        own, other = (good, bad) if i % 3 else (bad, good)
        rows.append((i, " ".join(r.choice(own if r.random() < 0.8 else other) for _ in range(12)), 1 if i % 3 else 0))
    return rows


def test_support_vectors_brute_force(monkeypatch):
    """Fifty rows, whole: log-count ratios by counting, the dual's optimum by projected gradient, margins and scores from both."""
    monkeypatch.setattr(nbsvm, "EPOCHS", 3000)
    rows = labelled_texts()
    feats = [x.astype(int) for x in nbsvm.features(pa.array([t for _, t, _ in rows]))]
    labels = np.array([y for *_, y in rows])
    model = nbsvm.fit([x.astype(np.int32) for x in feats], labels)
    held = np.arange(50) % 5 == 4
    # Naive Bayes: counts of the rows that are not held out for the curve
    counts = {1: {}, 0: {}}
    for i in np.flatnonzero(~held):
        for f in feats[i]:
            counts[labels[i]][f] = counts[labels[i]].get(f, 0) + 1
    totals = {c: 2 ** nbsvm.BITS + sum(counts[c].values()) for c in (0, 1)}
    ratio = lambda f: 1.0 if f == 0 else math.log((counts[1].get(f, 0) + 1) / totals[1]) - math.log((counts[0].get(f, 0) + 1) / totals[0])
    seen = sorted({int(f) for x in feats for f in x})
    for f in seen:
        assert model.ratios[f] == pytest.approx(ratio(f), abs=1e-9)
    # the support vector machine in a plain matrix of unit rows
    place = {f: k for k, f in enumerate(seen)}
    x = np.zeros((50, len(seen)))
    for i, fs in enumerate(feats):
        for f in fs:
            x[i, place[int(f)]] = ratio(int(f))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = (2.0 * labels - 1)[~held]
    q = (x[~held] @ x[~held].T) * np.outer(s, s)
    alpha, step = np.zeros(len(s)), 1 / np.linalg.eigvalsh(q)[-1]
    for _ in range(200_000):
        new = np.clip(alpha + step * (1 - q @ alpha), 0, nbsvm.COST)
        if np.abs(new - alpha).max() < 1e-13:
            break
        alpha = new
    w = (alpha * s) @ x[~held]
    margins = x @ w
    assert np.allclose([model.margin(f.astype(np.int32)) for f in feats], margins, atol=1e-6)
    assert ((margins > 0) == (labels == 1)).mean() > 0.9


def test_trained_on_spark_as_in_memory(spark):
    rows = labelled_texts()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(3)
    for c in ("label", "features", "quality", "score"):
        docs = docs.withColumn(c, F.lit("clash"))
    labels = spark.createDataFrame([(i, y, "clash") for i, _, y in rows] + [(1, 2, "x"), (None, 0, "x"), (999, 1, "x")], "doc_id long, quality int, text string")
    model = nbsvm.train(docs, labels)
    feats = {t: x for t, x in zip([t for _, t, _ in rows], nbsvm.features(pa.array([t for _, t, _ in rows])), strict=True)}
    order = sorted(((y, feats[t].tobytes()) for _, t, y in rows), key=lambda r: (nbsvm.hash_order(r[1]), r[0]))
    want = nbsvm.fit([np.frombuffer(b, np.int32) for _, b in order], np.array([y for y, _ in order]))
    assert np.allclose(model.weights, want.weights) and model.slope == pytest.approx(want.slope)
    out = nbsvm.classify(docs, model)
    assert {r.label for r in out.collect()} == {"clash"}
    for r in out.collect():
        assert r.quality_score == pytest.approx(float(want.score(np.array([want.margin(feats[r.text])]))[0]))
