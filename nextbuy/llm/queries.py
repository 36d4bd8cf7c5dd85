"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from nextbuy.llm import chat, collocations, decontaminate, hyperminhash, langid, mixing, nbsvm, quality_rules, suffix_dedup, token_counts, url_rules, warc, whitening
from nextbuy.sources.tables import table


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; the files are installed on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    path = tokenizer_path("byte_bpe_50k.json")
    return chat.read_back(chat.format_turns(rows.unionByName(probe), path), path)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_archives(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    records = warc.inspected(warc.read_archives(files))
    warc.log_gaps(records)
    return warc.page_digests(records)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path("byte_bpe_50k.json"),
                                     tokenizer_path("byte_bpe_50k.tiktoken"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang"))
    return mixed.select("doc_id", "source", "lang", "mix.*")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents", "doc_id", "lang", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))
    return judged.select("doc_id", *(F.col(f"quality.{c}").alias(c) for c in (*quality_rules.COUNTS, "base_failed", "kept")))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number at the end of a url's path is the document that the page shows; that document's label marks the url."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    number = F.regexp_extract(url_rules.path_of(F.col("url")), r"/([0-9]{1,18})(?:\.html|/)?$", 1)
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    marked = pages.select("url", number.alias("n")).filter("n <> ''").select(
        "url", F.col("n").cast("long").alias("doc_id"))
    return url_rules.judge(pages, url_rules.mine(marked.join(labels, "doc_id").select("url", "bad"), risk=url_rules.RISK))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").filter(nbsvm.held_in(0, 5))
    scored = nbsvm.classify(docs, nbsvm.train(docs, labels))
    return scored.select("doc_id", (~nbsvm.held_in(0, 5)).alias("held_out"), F.col("quality_score").alias("score"),
                         (F.col("quality_score") >= nbsvm.CUTOFF).cast("int").alias("predicted"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = tokenizer_path("piece_bpe_32k.model")
    languages, probabilities = langid.train(docs.filter(nbsvm.held_in(2, 4)), model)
    found = langid.predict(docs, languages, probabilities, model)
    return found.select("doc_id", (~nbsvm.held_in(2, 4)).alias("held_out"), "lang_pred", "score")


def op10_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return cut.select("doc_id", "n_bytes", F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_chat_format, op2_warc, op3_token_counts, op4_mixing, op5_decontamination, op6_quality_rules,
                            op7_url_rules, op8_quality_classifier, op9_language_id, op10_hyperminhash, op11_suffix_dedup,
                            op12_collocations, op13_whitening)}
