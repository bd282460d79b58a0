"""Report outputs as directories of Parquet or CSV files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from ledgerlens.operators import reports as R
from ledgerlens.settings import materialised
from ledgerlens.sources.transactions import write_csv

# Names and order of the columns.
EXPORT_COLUMNS = [
    "transaction_id", "user_id", "amount", "timestamp", "transaction_type", "rule_triggered",
    "final_risk_score", "risk_level",
]


def alert_export(alerts: DataFrame) -> DataFrame:
    """The key columns that are present."""
    return alerts.select(*[c for c in EXPORT_COLUMNS if c in alerts.columns])


def create_alert_csv(alerts: DataFrame, path: str) -> str:
    return write_csv(alert_export(alerts), path)


def report_sheets(alerts: DataFrame, tx: DataFrame) -> dict[str, DataFrame]:
    """The five tables of the multi-sheet export."""
    sheets = {
        "summary": R.generate_summary_report(alerts, tx),
        "all_alerts": alerts,
    }
    if "risk_level" in alerts.columns:
        sheets["high_risk_alerts"] = R.high_risk_alerts(alerts)
    sheets["top_risky_users"] = R.top_risky_users(alerts)
    if "rule_triggered" in alerts.columns:
        sheets["rule_effectiveness"] = R.rule_effectiveness(alerts)
    return sheets


def _write_all(frames: dict[str, DataFrame], path: str, fmt: str) -> str:
    for name, frame in frames.items():
        if fmt == "csv":
            write_csv(frame, f"{path}/{name}")
        else:
            frame.write.mode("overwrite").format(fmt).save(f"{path}/{name}")
    return path


def export_sheets(alerts: DataFrame, tx: DataFrame, path: str, fmt: str = "parquet") -> str:
    return _write_all(report_sheets(alerts, tx), path, fmt)


def chart_tables(alerts: DataFrame) -> dict[str, DataFrame]:
    return {
        "level_counts": R.level_counts(alerts),
        "score_histogram": R.score_histogram(alerts),
        "amount_boxplot": R.amount_boxplot(alerts),
        "rule_effectiveness": R.rule_effectiveness(alerts),
    }


def generate_all_reports(
    alerts: DataFrame,
    tx: DataFrame,
    output_dir: str,
    stamp: str | None = None,
    fmt: str = "parquet",
) -> dict[str, str]:
    """Write the whole suite; returns kind -> path.

    The alerts feed a dozen tables, so they are written once and each table
    reads the columns it needs.  The summary stands in two places and is made once.
    """
    stamp = stamp or datetime.now().strftime("%Y%m%d_%H%M%S")
    root = output_dir.rstrip("/")
    alerts = materialised(alerts, "alerts")
    sheets = report_sheets(alerts, tx)
    summary = materialised(sheets["summary"], "summary")
    compliance = R.compliance_report(alerts, tx)
    return {
        "sheets": _write_all({**sheets, "summary": summary}, f"{root}/report_{stamp}", fmt),
        "csv": create_alert_csv(alerts, f"{root}/alerts_{stamp}"),
        "compliance": _write_all(
            {**compliance, "summary": summary}, f"{root}/compliance_report_{stamp}", fmt
        ),
        "charts": _write_all(chart_tables(alerts), f"{root}/charts_{stamp}", fmt),
    }
