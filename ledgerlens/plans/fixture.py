"""A ``transactions`` frame over the supplied event and order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources.transactions import normalise


def _table(spark: SparkSession, sf_dir: str, name: str, streaming: bool) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if not streaming:
        return table
    source = spark.readStream.schema(table.schema).option("pathGlobFilter", f"{name}.parquet")
    return source.parquet(sf_dir)


def transactions(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Events and orders as transactions, with deterministic labels."""
    events = _table(spark, sf_dir, "events", streaming)
    orders = _table(spark, sf_dir, "orders", streaming)
    value, kind = F.col("value"), F.col("event_type")
    fifth = F.col("event_id") % 5 == 0
    from_events = events.select(
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.concat(F.lit("E"), F.col("user_id").cast("string")).alias("user_id"),
        F.col("ts").alias("timestamp"),
        F.when(fifth, F.floor(value) * 100 + 100.0)
        .otherwise(
            F.round(value * 100, 0) + (F.col("event_id") % 100).cast("double") / 100 + 0.01
        )
        .alias("amount"),
        kind.alias("transaction_type"),
        F.when((kind == "error") & (value >= 90), "velocity")
        .when((kind == "purchase") & (value >= 90) & (value < 100), "structuring")
        .alias("suspicious_pattern"),
    )
    price = F.col("o_totalprice")
    from_orders = orders.select(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("transaction_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.col("o_orderdate").alias("timestamp"),
        price.alias("amount"),
        F.col("o_orderpriority").alias("transaction_type"),
        F.when(
            F.col("o_orderpriority").startswith("1-") & (price > 400000), "high_value"
        ).alias("suspicious_pattern"),
    )
    both = from_events.unionByName(from_orders)
    return normalise(both).withColumn("is_suspicious", F.col("suspicious_pattern").isNotNull())
