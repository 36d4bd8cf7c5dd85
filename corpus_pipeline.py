"""Corpus pipeline over ``documents``: filter, deduplicate, decontaminate and mix.

Each stage takes (spark, docs, sf_dir) and returns the rows that it keeps; all
but the last return the columns of ``documents``.  ``run`` writes each stage's
result to the shared folder and reads it as the next one's input.  Columns that
no stage reads travel in one struct, so a column that has the name of a stage's
own result keeps its values; where the last stage's output would then have a
name twice, its own column is called ``mix_<name>``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from nextbuy.llm import decontaminate, hyperminhash, mixing, nbsvm, quality_rules
from nextbuy.session import materialize
from nextbuy.sources.tables import table


#: Columns that stages read.
READ = ("doc_id", "text", "lang", "source")
REST = "columns_no_stage_reads"


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns but READ in one struct."""
    rest = [c for c in docs.columns if c not in READ]
    return docs.select(*[c for c in docs.columns if c in READ], *([F.struct(*[F.col(f"`{c}`") for c in rest]).alias(REST)] if rest else []))


def columns_of(docs: DataFrame) -> list[F.Column]:
    """The columns of ``docs`` as they are found in rows that came from ``packed(docs)``."""
    return [F.col(c) if c in READ else F.col(REST)[c].alias(c) for c in docs.columns]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the rules reject go; an unlabelled or empty table meets the base rules only."""
    judged = quality_rules.judge(packed(docs), table(spark, sf_dir, "labels"))
    return judged.filter("quality.kept").select(*columns_of(docs))


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents scored below the cutoff go; it learns from all labelled rows of the table, also those that the rules rejected."""
    scored = nbsvm.classify(packed(docs), nbsvm.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
    return scored.filter(F.col("quality_score") >= nbsvm.CUTOFF).select(*columns_of(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each group stays, the smallest id; rows without an id stay."""
    gone = hyperminhash.near_duplicates(docs).filter("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    rows = packed(docs)
    return rows.join(gone, rows["doc_id"].cast("long") == gone["gone_id"], "left_anti").select(*columns_of(docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that hold a benchmark item go."""
    return decontaminate.decontaminate(packed(docs), table(spark, sf_dir, "benchmark")).select(*columns_of(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: the drawn sample, with topic, n_tokens, weight and probability (``mix_``... where ``docs`` has such a column)."""
    own = [F.col(f"mix.{c}").alias(f"mix_{c}" if c in docs.columns else c) for c in ("topic", "n_tokens", "weight", "probability")]
    return mixing.mix(packed(docs)).filter("mix.selected").select(*columns_of(docs), *own)


STAGES = [
    ("quality_rules", quality_stage),
    ("quality_classifier", classifier_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: Fits and raking are not expressible in SQL; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
