"""The registered queries of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import archive, bpe, brown, decontam, feistel, hyperminhash, manifest, merkle, oracle, quality, repair, sharding, suffix_dedup, toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {
    "op2_fm_decontamination": oracle.DECONTAMINATION,
    "op3_arc_to_warc": oracle.ARCHIVE,
    "op8_induced_suffix_dedup": oracle.REPEATS,
    "op9_hyperminhash": oracle.NEAR_DUPLICATES,
    "op11_merkle_manifest": oracle.MANIFEST,
    "op12_conversation_repair": oracle.REPAIR,
}

#: A key for the test tables; real ones are secrets of the caller.
DEMO_KEY = b"demonstration key, not a secret"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), 40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve")


@query
def op2_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        decontam.items_digest().alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query
def op3_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query
def op5_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_with_next(table(spark, sf_dir, "documents"))


@query
def op6_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = brown.score_documents(table(spark, sf_dir, "documents"), ~brown.held_out())
    return scored.select(
        "doc_id", brown.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        "unplaced_tokens")


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path(), ids=False)


@query
def op8_induced_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


@query
def op9_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = feistel.pseudonymise(docs, DEMO_KEY, spans="spans")
    return out.select(
        "doc_id", "text", "n_chars", F.size("spans").cast("long").alias("n_replaced"), "spans")


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.prove_documents(table(spark, sf_dir, "documents"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    return repair.repair_conversations(repair.damaged(given), given)


@query
def op13_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(~quality.held_out()))
    return quality.judge(docs, model).drop("score")
