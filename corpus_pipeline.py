"""The corpus pipeline: from raw documents to encoded ones, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import bpe, decontam, feistel, hyperminhash, toxicity
from ledgerlens.llm.queries import DEMO_KEY, table, tokenizer_path
from ledgerlens.settings import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the classifier finds toxic; it learns from labels of the train fold."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    model = toxicity.fit(docs, labels)
    return docs.where(~toxicity.toxic_column(docs, model))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every group of near-duplicates."""
    return hyperminhash.keep_one(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of the benchmark out of the texts."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts pseudonyms in the place of personal values."""
    return feistel.pseudonymise(docs, DEMO_KEY)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, with digests of the ids and of the decoded text."""
    return bpe.encode_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", cut_benchmark),
    ("pseudonyms", hide_private),
    ("encoding", encode),
]

#: No SQL can state the classifier; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
