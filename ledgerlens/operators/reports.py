"""Aggregates behind the reports, charts and dashboard pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.quantiles import ACCURACY, exact_quantiles
from ledgerlens.settings import materialised
from ledgerlens.operators.scoring import get_top_risky_transactions, level_percentages

HIGH_LEVELS = ["CRITICAL", "HIGH"]
HISTOGRAM_BINS = 30
WHISKER = 1.5
# Names and order of the columns.
DASHBOARD_COLUMNS = [
    "transaction_id", "user_id", "amount", "timestamp", "rule_triggered", "final_risk_score",
    "risk_level",
]


def _side_by_side(*one_row: DataFrame) -> DataFrame:
    """Several one-row frames as one row, without a join."""
    tall = one_row[0]
    for other in one_row[1:]:
        tall = tall.unionByName(other, allowMissingColumns=True)
    return tall.agg(*[F.max(c).alias(c) for c in tall.columns])


def _percent(part: str, whole: str):
    return F.coalesce(F.try_divide(F.col(part) * 100.0, whole), F.lit(0.0))


def generate_summary_report(alerts: DataFrame, tx: DataFrame) -> DataFrame:
    """Totals of all and of flagged transactions, in one row."""
    whole = tx.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("amount").alias("total_volume"),
        F.count_distinct("user_id").alias("unique_users"),
    )
    measures = [
        F.count(F.lit(1)).alias("flagged_transactions"),
        F.sum("amount").alias("flagged_volume"),
        F.count_distinct("user_id").alias("flagged_users"),
    ]
    if "final_risk_score" in alerts.columns:
        measures += [
            F.avg("final_risk_score").alias("avg_risk_score"),
            F.max("final_risk_score").alias("max_risk_score"),
        ]
    return _side_by_side(whole, alerts.agg(*measures)).withColumn(
        "flag_rate", _percent("flagged_transactions", "total_transactions")
    )


def run_summary(tx: DataFrame, scored: DataFrame) -> DataFrame:
    """Processed, flagged and clear counts of one detection run."""
    return _side_by_side(
        tx.agg(F.count(F.lit(1)).alias("processed")),
        scored.agg(
            F.count(F.lit(1)).alias("flagged"),
            F.sum("amount").alias("flagged_amount"),
            F.avg("final_risk_score").alias("average_score"),
            F.max("final_risk_score").alias("highest_score"),
            F.count_distinct("user_id").alias("users_to_review"),
        ),
    ).withColumns(
        {
            "clear": F.col("processed") - F.col("flagged"),
            "flag_rate": _percent("flagged", "processed"),
        }
    )


def dataset_overview(tx: DataFrame, alerts: DataFrame) -> DataFrame:
    return _side_by_side(
        tx.agg(
            F.count(F.lit(1)).alias("total_transactions"),
            F.count_distinct("user_id").alias("unique_users"),
            F.sum("amount").alias("total_volume"),
        ),
        alerts.agg(F.count(F.lit(1)).alias("alerts_generated")),
    ).withColumn("alert_rate", _percent("alerts_generated", "total_transactions"))


def high_risk_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.filter(F.col("risk_level").isin(HIGH_LEVELS))


def top_risky_users(alerts: DataFrame) -> DataFrame:
    """Every user with alerts, most alerts first."""
    return (
        alerts.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.count("transaction_id").alias("alert_count"),
            F.avg("final_risk_score").alias("avg_risk_score"),
            F.max("final_risk_score").alias("max_risk_score"),
            F.sum("amount").alias("total_amount"),
        )
        .orderBy(F.desc("alert_count"), "user_id")
    )


def rule_effectiveness(alerts: DataFrame) -> DataFrame:
    """Alerts per single rule."""
    return (
        alerts.select(F.explode(F.split("rule_triggered", ", ")).alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "rule")
    )


def compliance_report(alerts: DataFrame, tx: DataFrame) -> dict[str, DataFrame]:
    return {
        "summary": generate_summary_report(alerts, tx),
        "risk_levels": level_percentages(alerts),
        "top_transactions": get_top_risky_transactions(alerts, 10),
    }


# --- charts -------------------------------------------------------------------


def level_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("risk_level").agg(F.count(F.lit(1)).alias("count"))


def score_histogram(alerts: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal bins from lowest to highest score, the last one closed; empty
    bins are included.

    Scores take few distinct values, so they are counted first and binned as
    one small collected table's worth of rows.
    """
    counts = alerts.groupBy("final_risk_score").agg(F.count(F.lit(1)).alias("n"))
    bounds = counts.agg(
        F.min("final_risk_score").alias("low"),
        F.max("final_risk_score").alias("high"),
        (F.sum(F.col("n") * F.col("final_risk_score")) / F.sum("n")).alias("mean_score"),
        F.collect_list(F.struct("final_risk_score", "n")).alias("scores"),  # <= 151 entries
    )
    width = (F.col("high") - F.col("low")) / bins
    bin_of = lambda s: F.least(
        F.coalesce(F.floor(F.try_divide(s - F.col("low"), F.col("width"))), F.lit(0)),
        F.lit(bins - 1),
    )
    in_bin = F.filter("scores", lambda s: bin_of(s["final_risk_score"]) == F.col("bin"))
    return (
        bounds.withColumn("width", width)
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .select(
            "bin",
            (F.col("low") + F.col("width") * F.col("bin")).alias("bin_start"),
            (F.col("low") + F.col("width") * (F.col("bin") + 1)).alias("bin_end"),
            F.aggregate(in_bin, F.lit(0).cast("long"), lambda t, s: t + s["n"]).alias("count"),
            "mean_score",
        )
    )


def amount_boxplot(alerts: DataFrame, accuracy: int = ACCURACY) -> DataFrame:
    """Box-plot numbers of the amount per level.

    Levels and amounts are written once, as three passes read them.
    """
    alerts = materialised(alerts.select("risk_level", "amount"), "amounts")
    quartiles = exact_quantiles(
        alerts, "amount", [0.25, 0.5, 0.75], by=["risk_level"], accuracy=accuracy
    ).select(
        "risk_level",
        *[F.col("quantiles")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))],
    )
    reach = WHISKER * (F.col("q3") - F.col("q1"))
    amount = F.col("amount")
    inside = amount.between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        alerts.join(quartiles, "risk_level")
        .groupBy("risk_level", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, amount)).alias("whisker_low"),
            F.max(F.when(inside, amount)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


# --- dashboard ----------------------------------------------------------------


def preview(tx: DataFrame, n: int = 100) -> DataFrame:
    return tx.orderBy("timestamp", "transaction_id").limit(n)


def filter_alerts(
    alerts: DataFrame,
    levels: Sequence[str] | None = None,
    min_score: int = 60,
    user_pattern: str | None = None,
) -> DataFrame:
    """Dashboard filter; the user pattern is a case-insensitive regex."""
    rows = alerts.filter(F.col("final_risk_score") >= min_score)
    if levels:
        rows = rows.filter(F.col("risk_level").isin(list(levels)))
    if user_pattern:
        rows = rows.filter(F.col("user_id").rlike(f"(?i){user_pattern}"))
    return rows.select(*DASHBOARD_COLUMNS).orderBy(F.desc("final_risk_score"), "transaction_id")


def lookup(alerts: DataFrame, transaction_id: str) -> DataFrame:
    return alerts.filter(F.col("transaction_id") == transaction_id).limit(1)


def alert_timeline(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy(F.to_date("timestamp").alias("date"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("date")
    )


def dashboard_top_users(alerts: DataFrame, n: int = 10) -> DataFrame:
    return (
        alerts.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.count("transaction_id").alias("alert_count"),
            F.avg("final_risk_score").alias("avg_risk_score"),
            F.sum("amount").alias("total_amount"),
        )
        .orderBy(F.desc("alert_count"), "user_id")
        .limit(n)
    )


# --- dataset profile ----------------------------------------------------------


def pattern_counts(tx: DataFrame) -> DataFrame:
    return (
        tx.filter(F.col("suspicious_pattern").isNotNull())
        .groupBy("suspicious_pattern")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def suspicious_rate(tx: DataFrame) -> DataFrame:
    marked = F.coalesce("is_suspicious", F.lit(False))
    return tx.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(marked).alias("suspicious_transactions"),
        (F.avg(marked.cast("int")) * 100).alias("suspicious_percent"),
    )


def describe_amount(tx: DataFrame, accuracy: int = ACCURACY) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of the amount.

    The amounts are written once, as three passes read them.
    """
    tx = materialised(tx.select("amount"), "amounts")
    basic = tx.agg(
        F.count("amount").alias("count"),
        F.avg("amount").alias("mean"),
        F.stddev_samp("amount").alias("std"),
        F.min("amount").alias("min"),
        F.max("amount").alias("max"),
    )
    quartiles = exact_quantiles(tx, "amount", [0.25, 0.5, 0.75], accuracy=accuracy).select(
        *[F.col("quantiles")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))]
    )
    return _side_by_side(basic, quartiles)
