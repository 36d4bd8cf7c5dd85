"""Mixing sources to target weights by iterative proportional fitting (operator 4).

Tokens are counted by cell (source, language, topic).  Raking multiplies the
cells by one factor per marginal value until the token shares of sources,
languages and topics meet their targets.  A document's weight is its cell's
factor; for a token budget, cells are sampled with the probability that gives
them their raked share, and what cells above probability 1 cannot give is
shared out among the others.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from nextbuy.llm.ship import ship
from nextbuy.llm.words import count_words

MARGINS = ("source", "lang", "topic")
ROUNDS, TOLERANCE = 200, 1e-9
#: Cells (source, language, topic) that raking takes; some 100 bytes each on the driver.
MOST_CELLS = 1 << 20
#: Share of the corpus' tokens that the sample aims at, and the exponent that flattens source and topic shares.
BUDGET, FLATTEN = 0.6, 0.7
#: Marks of a legal text, in lower case.
LEGAL = ("license under", "licence under", "licensed under", "licenced under", "all rights reserved", "copyright")


def with_tokens(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a column ``name``: the words of the whole text, its token weight; null and wordless texts weigh 0."""
    ship(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(count_words(batch.column(at)), pa.int64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def topic_of(text: Column) -> Column:
    """A coarse topic by marks of form in the whole text: legal, contact, table, figures, prose; none without text.

    Legal marks count in any case.  Patterns run only on texts that contain their mark.
    """
    legal = F.exists(F.array(F.lower(text)), lambda low: reduce(or_, [low.contains(x) for x in LEGAL]))  # lower once
    return (
        F.when(F.coalesce(text, F.lit("")) == "", "none")
        .when(legal, "legal")
        .when((text.contains("@") & text.rlike(r"[\w.+-]@[\w-]+\.\w")) | (text.contains("+") & text.rlike(r"\+\d[\d ()-]{6}")), "contact")
        .when(text.contains(" | ") & text.rlike(r" \| .* \| "), "table")
        .when(text.rlike(r"\d{4}"), "figures")
        .otherwise("prose"))


def rake_cells(tokens: np.ndarray, at: np.ndarray, targets: list[np.ndarray], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[np.ndarray, float]:
    """Raked shares of the cells and the largest miss of a margin's target.

    ``at`` has, by margin, each cell's place among the margin's targets.  A
    target on a value without tokens cannot be met: it is shared out among the
    other values of its margin in proportion.  Margins that contradict each
    other (by cells that do not exist) leave a miss above the tolerance.
    """
    shares = tokens / max(tokens.sum(), 1)
    goal = []
    for place, t in zip(at, targets, strict=True):
        have = np.bincount(place, weights=tokens, minlength=len(t)) > 0
        t = np.where(have, t, 0.0)
        goal.append(t / t.sum() if t.sum() else have / max(have.sum(), 1))
    miss = 0.0
    for _ in range(rounds):
        for place, t in zip(at, goal, strict=True):
            now = np.bincount(place, weights=shares, minlength=len(t))
            shares = shares * np.where(now > 0, t / np.where(now > 0, now, 1), 0)[place]
        miss = max((float(np.abs(np.bincount(place, weights=shares, minlength=len(t)) - t).max(initial=0)) for place, t in zip(at, goal, strict=True)), default=0.0)
        if miss < tolerance:
            break
    return shares, miss


def rake(tokens: np.ndarray, targets: list[np.ndarray], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> np.ndarray:
    """``rake_cells`` of a whole array whose axes are the margins."""
    return rake_cells(tokens.ravel(), np.indices(tokens.shape).reshape(tokens.ndim, -1), targets, rounds, tolerance)[0].reshape(tokens.shape)


def probabilities(tokens: np.ndarray, shares: np.ndarray, budget: float) -> np.ndarray:
    """Inclusion probability by cell: expected tokens follow ``shares`` and add up to ``budget`` as far as cells allow."""
    p, open_ = np.zeros(tokens.shape), (tokens > 0) & (shares > 0)
    left = budget
    while open_.any() and left > 0:
        want = left * shares / shares[open_].sum()
        full = open_ & (want >= tokens)
        if not full.any():
            p[open_] = want[open_] / tokens[open_]
            break
        p[full] = 1.0
        left -= float(tokens[full].sum())
        open_ &= ~full
    return p


def cell_table(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET) -> DataFrame:
    """source, lang, topic, weight, probability, miss by cell of ``docs`` (MARGINS, n_tokens).

    Targets by margin and value (values without one get none); where none are
    given, the margin's own token shares, flattened by an exponent for source
    and topic and equal to themselves for lang.  Only cells that occur come to
    the driver, a row each whatever the number of documents; more than
    ``MOST_CELLS`` (a source of as many values as documents) are an error, as
    the margins are meant to be categories.  ``miss`` is the largest deviation
    from a target share, logged where raking did not converge.
    """
    spark = docs.sparkSession
    rows = docs.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("n")).limit(MOST_CELLS + 1).toPandas()
    if len(rows) > MOST_CELLS:
        raise ValueError(f"over {MOST_CELLS} cells of source, language and topic: rake to coarser margins")
    schema = "source string, lang string, topic string, weight double, probability double, miss double"
    if not len(rows):
        return spark.createDataFrame([], schema)
    tokens = rows["n"].to_numpy(np.float64)
    goals, at = [], []
    for m in MARGINS:
        values, place = np.unique(rows[m].to_numpy(str), return_inverse=True)
        own = np.bincount(place, weights=tokens, minlength=len(values))
        given = (targets or {}).get(m)
        goals.append(np.array([given.get(str(x), 0.0) for x in values]) if given else own if m == "lang" else own ** FLATTEN)
        at.append(place)
    shares, miss = rake_cells(tokens, np.array(at), goals)
    if miss >= TOLERANCE:
        logging.getLogger(__name__).warning("raking did not converge: a margin's share is %.3g from its target", miss)
    p = probabilities(tokens, shares, budget * tokens.sum())
    now = tokens / max(tokens.sum(), 1)
    rows["weight"] = np.where(now > 0, shares / np.where(now > 0, now, 1), 0.0)
    rows["probability"], rows["miss"] = p, miss
    return spark.createDataFrame(rows.drop(columns="n"), schema)


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET, seed: int = 4, name: str = "mix") -> DataFrame:
    """``docs`` with a struct column ``name``: topic, n_tokens, weight, probability, selected, miss.

    Null sources and languages are cells of their own (the empty string).  A
    document is drawn if the hash of its id (of its text if it has none) falls
    below its cell's probability, so repeated rows are drawn together and a
    second run draws the same.  Texts without words weigh nothing and are not
    drawn.  An existing column ``name`` is replaced; an empty table stays empty.
    """
    docs = docs.drop(name)
    own = with_tokens(docs, name).withColumn(name, F.struct(
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        topic_of(F.col("text")).alias("topic"), F.col(name).alias("n_tokens")))
    cells = cell_table(own.select(f"{name}.*"), targets, budget)
    cells = cells.select(F.struct(*MARGINS).alias("cell"), F.struct("weight", "probability", "miss").alias("drawn"))
    drawn = own.join(cells, F.struct(*(F.col(f"{name}.{m}") for m in MARGINS)) == F.col("cell"), "left")
    chance = F.pmod(F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), "text")), F.lit(1 << 40)) / float(1 << 40)
    return drawn.withColumn(name, F.struct(
        F.col(f"{name}.topic"), F.col(f"{name}.n_tokens"), F.coalesce("drawn.weight", F.lit(0.0)).alias("weight"),
        F.coalesce("drawn.probability", F.lit(0.0)).alias("probability"),
        (chance < F.coalesce("drawn.probability", F.lit(0.0))).alias("selected"), F.col("drawn.miss").alias("miss"))).drop("cell", "drawn")
