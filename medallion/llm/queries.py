"""Registered queries: each numbered operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm import conversations, covertree, decontaminate, exact, language, lines, mixing, near, passages, reputation, substrings, tokens, warc
from medallion.llm.store import stored, table  # noqa: F401


#: Vocabulary of the token files.
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.tokenised(table(spark, sf_dir, "documents"), vocabulary_path())


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_spans(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from three of four documents, by their id; the fourth is held out."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(fold == 2, F.lit(False)))
    known = language.train(docs.where(fold != 2))
    found = language.measured(docs, known, ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of a page: bad if its id is labelled toxic or of low quality."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return reputation.filter_urls(table(spark, sf_dir, "pages"), outcomes)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned, _ = lines.line_dedup(table(spark, sf_dir, "documents"))
    return cleaned.select("doc.doc_id", "n_lines", "n_deleted", F.sha2("doc.text", 256).alias("text_sha256"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    report, repaired = conversations.repair(conversations.damaged(turns))
    found = conversations.merged("conv_id", report, conversations.digests(repaired), turns.select("conv_id"))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id",
        *[F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = covertree.compressed(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error").withColumn("codebooks_sha256", F.lit(covertree.digest(books)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, query in globals().items() if name.startswith("op")}
