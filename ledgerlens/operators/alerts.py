"""Alert table operations as ``alerts -> alerts`` transforms and queries."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.numbering import number_rows

# Columns of the alert table.
ALERT_SCHEMA = T.StructType(
    [
        T.StructField("alert_id", T.LongType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("rules_triggered", T.StringType()),
        T.StructField("risk_score", T.IntegerType()),
        T.StructField("risk_level", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("reviewed_by", T.StringType()),
        T.StructField("reviewed_at", T.TimestampNTZType()),
        T.StructField("notes", T.StringType()),
    ]
)

REQUIRED = [
    "transaction_id", "user_id", "amount", "timestamp", "rules_triggered", "risk_score",
    "risk_level",
]
RECENT = timedelta(days=7)


def _ntz(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def to_alerts(scored: DataFrame, created_at: datetime) -> DataFrame:
    """Scored transactions in the alert layout, without ids.

    Rows lacking a required value cannot be stored and are left out.
    """
    columns = {
        "rules_triggered": F.col("rule_triggered"),
        "risk_score": F.col("final_risk_score"),
        "status": F.lit("NEW"),
        "created_at": _ntz(created_at),
    }
    fields = [f for f in ALERT_SCHEMA if f.name != "alert_id"]
    kept = {"transaction_id", "user_id", "amount", "transaction_type", "timestamp", "risk_level"}
    shaped = scored.select(
        *[
            (columns.get(f.name) if f.name in columns
             else F.col(f.name) if f.name in kept else F.lit(None))
            .cast(f.dataType).alias(f.name)
            for f in fields
        ]
    )
    return shaped.na.drop(subset=REQUIRED)


def one_per_transaction(rows: DataFrame, last: bool) -> DataFrame:
    """First or last row per transaction id in time order, as an aggregate so
    that repeats combine before the shuffle."""
    others = [c for c in rows.columns if c != "transaction_id"]
    pick = F.max_by if last else F.min_by
    order = F.struct("timestamp", "user_id", "amount", "risk_score", "rules_triggered")
    return (
        rows.groupBy("transaction_id")
        .agg(pick(F.struct(*others), order).alias("row"))
        .select("transaction_id", "row.*")
    )


def next_alert_id(alerts: DataFrame) -> int:
    top = alerts.agg(F.max("alert_id")).first()[0]
    return (top or 0) + 1


def with_alert_ids(rows: DataFrame, start: int) -> DataFrame:
    """Consecutive ids in transaction order."""
    numbered = number_rows(rows, ["transaction_id"], "alert_id", start)
    return numbered.select(*ALERT_SCHEMA.fieldNames())


def new_alerts(alerts: DataFrame, scored: DataFrame, created_at: datetime) -> DataFrame:
    """Transactions not in the table yet, one row each."""
    incoming = one_per_transaction(to_alerts(scored, created_at), last=False)
    return incoming.join(alerts.select("transaction_id"), "transaction_id", "left_anti")


def upsert_rows(alerts: DataFrame, scored: DataFrame, created_at: datetime) -> DataFrame:
    """All given transactions; of repeated ones the last."""
    return one_per_transaction(to_alerts(scored, created_at), last=True)


def rescored(alerts: DataFrame, scored: DataFrame) -> DataFrame:
    """Alerts whose score, level or rules differ from ``scored``, with the new
    ones; ids, reviews and the time of creation stay."""
    news = ["risk_score", "risk_level", "rules_triggered"]
    given = one_per_transaction(to_alerts(scored, datetime(1970, 1, 1)), last=True).select(
        "transaction_id", F.struct(*news).alias("_new")
    )
    joined = alerts.join(given, "transaction_id").filter(F.struct(*news) != F.col("_new"))
    return joined.withColumns({n: F.col(f"_new.{n}") for n in news}).select(
        *ALERT_SCHEMA.fieldNames()
    )


def merge(alerts: DataFrame, fresh: DataFrame) -> DataFrame:
    """The table with ``fresh`` rows in place of rows of the same transaction."""
    kept = alerts.join(fresh.select("transaction_id"), "transaction_id", "left_anti")
    return kept.select(*ALERT_SCHEMA.fieldNames()).unionByName(fresh)


def insert_ignore(
    alerts: DataFrame, scored: DataFrame, created_at: datetime, next_id: int | None = None
) -> DataFrame:
    """Add new transactions and keep existing alerts as they are.

    ``next_id`` may be passed by a store that remembers the highest id ever
    given out, so that ids of deleted alerts are not used again.
    """
    start = next_alert_id(alerts) if next_id is None else next_id
    return alerts.unionByName(with_alert_ids(new_alerts(alerts, scored, created_at), start))


def upsert(
    alerts: DataFrame, scored: DataFrame, created_at: datetime, next_id: int | None = None
) -> DataFrame:
    """Replace alerts of the given transactions: new id, review cleared."""
    start = next_alert_id(alerts) if next_id is None else next_id
    return merge(alerts, with_alert_ids(upsert_rows(alerts, scored, created_at), start))


def get_alerts(
    alerts: DataFrame,
    risk_level: str | None = None,
    status: str | None = None,
    user_id: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Filtered alerts, highest score and newest first."""
    for column, value in (("risk_level", risk_level), ("status", status), ("user_id", user_id)):
        if value:
            alerts = alerts.filter(F.col(column) == value)
    ordered = alerts.orderBy(F.desc("risk_score"), F.desc("created_at"), "transaction_id")
    return ordered.limit(limit) if limit else ordered


def alert_totals(alerts: DataFrame, as_of: datetime) -> DataFrame:
    """All alerts and those created in the seven days up to ``as_of``."""
    recent = F.col("created_at") >= _ntz(as_of - RECENT)
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(recent).alias("recent_alerts_7d"),
    )


def alerts_by(alerts: DataFrame, column: str) -> DataFrame:
    return alerts.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def top_alert_users(alerts: DataFrame, n: int = 10) -> DataFrame:
    return (
        alerts.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("alert_count"), F.sum("amount").alias("total_amount"))
        .orderBy(F.desc("alert_count"), "user_id")
        .limit(n)
    )


def get_alert_statistics(alerts: DataFrame, as_of: datetime) -> dict[str, DataFrame]:
    return {
        "totals": alert_totals(alerts, as_of),
        "risk_distribution": alerts_by(alerts, "risk_level"),
        "status_distribution": alerts_by(alerts, "status"),
        "top_users": top_alert_users(alerts),
    }


def update_status(alerts: DataFrame, updates: DataFrame, reviewed_at: datetime) -> DataFrame:
    """Apply reviews given as ``alert_id, status[, reviewed_by, notes]``.

    A value that is not given overwrites the old one with NULL.
    """
    given = updates.columns
    optional = [F.col(c) if c in given else F.lit(None).cast("string").alias(c)
                for c in ("reviewed_by", "notes")]
    change = updates.select(
        F.col("alert_id").cast("long"),
        F.struct("status", *optional).alias("_new"),
    )
    # One review per alert; of several the greatest is kept.
    change = change.groupBy("alert_id").agg(F.max("_new").alias("_new"))
    hit = F.col("_new").isNotNull()
    joined = alerts.join(change, "alert_id", "left").withColumns(
        {
            "status": F.when(hit, F.col("_new.status")).otherwise(F.col("status")),
            "reviewed_by": F.when(hit, F.col("_new.reviewed_by")).otherwise(F.col("reviewed_by")),
            "reviewed_at": F.when(hit, _ntz(reviewed_at)).otherwise(F.col("reviewed_at")),
            "notes": F.when(hit, F.col("_new.notes")).otherwise(F.col("notes")),
        }
    )
    return joined.select(*ALERT_SCHEMA.fieldNames())


def delete_alerts(alerts: DataFrame, ids: DataFrame) -> DataFrame:
    return alerts.join(ids.select("alert_id"), "alert_id", "left_anti").select(
        *ALERT_SCHEMA.fieldNames()
    )
