"""A training corpus from ``documents``: each stage works on what the one before it kept.

Languages are learned from the labelled documents of the table itself; what no language explains is
dropped. Of near-duplicates the smallest doc_id stays. Documents with words of a benchmark window are
dropped. The mix repeats and cuts documents to the sources' targets. The token files are written and
read back; the result has a row per document in them.

Nulls, empty and very long texts, ties, repeated rows, empty tables and further columns are treated as
the operators of each stage say; all but the last stage return the columns they are given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medallion.llm import decontaminate, language, mixing, near, tokens
from medallion.llm.queries import vocabulary_path
from medallion.llm.store import stored, table


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.recognised(docs, language.train(docs))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.deduplicated(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.tokenised(docs, vocabulary_path())


STAGES = [
    ("language ID", identify),
    ("near-dedup", dedup),
    ("decontamination", decontaminated),
    ("mixing", mix),
    ("token files", tokenise),
]

#: Language models and files have no SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
