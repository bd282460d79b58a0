from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import reports as P
from ledgerlens.operators import scoring as S

SCHEMA = (
    "transaction_id string, user_id string, amount double, timestamp timestamp_ntz, "
    "transaction_type string, rule_triggered string, risk_score int, weighted_score double"
)


@pytest.fixture
def combined(spark):
    day = lambda d: datetime(2024, 1, d)
    rows = [
        ("T1", "U1", 15000.0, day(1), "wire_transfer", "HIGH_VALUE", 30, 30.0),
        ("T1", "U1", 15000.0, day(2), "wire_transfer", "VELOCITY", 40, 48.0),
        ("T2", "U2", 25000.0, day(3), "wire_transfer", "HIGH_VALUE", 50, 50.0),
        ("T3", "U3", 9500.0, day(4), "transfer", "STRUCTURING", 50, 75.0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_smoke_values(combined):
    scored = S.calculate_cumulative_scores(combined)
    got = {
        r["transaction_id"]: (r["final_risk_score"], r["risk_level"], r["rule_triggered"])
        for r in scored.collect()
    }
    assert got == {
        "T1": (78, "HIGH", "HIGH_VALUE, VELOCITY"),
        "T2": (50, "MEDIUM", "HIGH_VALUE"),
        "T3": (75, "HIGH", "STRUCTURING"),
    }
    assert S.get_risk_distribution(scored).collect() == [
        ("LOW", 0), ("MEDIUM", 1), ("HIGH", 2), ("CRITICAL", 0),
    ]
    assert [r["transaction_id"] for r in S.get_top_risky_transactions(scored, 2).collect()] == [
        "T1", "T3",
    ]


def test_half_even_rounding_cap_and_levels(spark):
    rows = [(f"T{i}", "U", 1.0, datetime(2024, 1, 1), "x", "R", 1, w)
            for i, w in enumerate([40.5, 38.5, 30.5, 31.5, 90.5, 91.0, 500.0])]
    scored = S.calculate_cumulative_scores(spark.createDataFrame(rows, SCHEMA))
    got = [(r["final_risk_score"], r["risk_level"])
           for r in scored.orderBy("transaction_id").collect()]
    assert got == [(40, "MEDIUM"), (38, "MEDIUM"), (30, "LOW"), (32, "MEDIUM"), (90, "HIGH"),
                   (91, "CRITICAL"), (150, "CRITICAL")]


def test_custom_levels_and_negative_scores(spark):
    levels = {"LOW": (0, 30), "HIGH": (50, 90)}
    df = spark.createDataFrame([(-1,), (10,), (40,), (60,)], "s int")
    got = [r[0] for r in df.select(S.risk_level(F.col("s"), levels)).collect()]
    assert got == ["CRITICAL", "LOW", "CRITICAL", "HIGH"]


def test_weights(spark):
    df = spark.createDataFrame(
        [("STRUCTURING", 40), ("OTHER", 40), ("ROUND_NUMBERS", 45)],
        "rule_triggered string, risk_score int",
    )
    got = {r[0]: r[2] for r in S.with_weighted_score(df).collect()}
    assert got == {"STRUCTURING": 60.0, "OTHER": 40.0, "ROUND_NUMBERS": 40.5}
    other = {r[0]: r[2] for r in S.with_weighted_score(df, {"OTHER": 2.0}).collect()}
    assert other["OTHER"] == 80.0 and other["STRUCTURING"] == 40.0


def test_optional_columns_are_first_non_null(combined):
    shop = F.when(F.col("rule_triggered") == "VELOCITY", "shop")
    scored = S.calculate_cumulative_scores(combined.withColumn("merchant", shop))
    got = {r["transaction_id"]: r["merchant"] for r in scored.collect()}
    assert got == {"T1": "shop", "T2": None, "T3": None}


def test_high_risk_users_thresholds(combined):
    scored = S.calculate_cumulative_scores(combined)
    assert [r["user_id"] for r in S.get_high_risk_users(scored).collect()] == ["U1", "U3"]
    assert S.get_high_risk_users(scored, "CRITICAL").count() == 0
    assert S.get_high_risk_users(scored, "ANY").count() == 3


def test_empty_reports(combined):
    none = S.calculate_cumulative_scores(combined).filter("false")
    report = S.generate_risk_report(none).first()
    assert (report["total_flagged"], report["average_score"], report["users_flagged"]) == (0, 0, 0)
    assert [r["percentage"] for r in S.level_percentages(none).collect()] == [0.0] * 4
    tx = combined.select("transaction_id", "user_id", "amount")
    assert P.generate_summary_report(none, tx).first()["flag_rate"] == 0.0
    assert P.run_summary(tx, none).first()["clear"] == 4


def test_histogram_of_one_value_and_closed_last_bin(combined):
    scored = S.calculate_cumulative_scores(combined)
    bins = {r["bin"]: r["count"] for r in P.score_histogram(scored).collect()}
    assert len(bins) == 30 and sum(bins.values()) == 3
    assert bins[0] == 1 and bins[29] == 1  # 50 and 78
    same = P.score_histogram(scored.filter("final_risk_score = 50")).collect()
    assert sum(r["count"] for r in same) == 1


def test_dashboard_filter(combined):
    scored = S.calculate_cumulative_scores(combined)
    ids = lambda df: [r["transaction_id"] for r in df.collect()]
    assert ids(P.filter_alerts(scored)) == ["T1", "T3"]
    assert ids(P.filter_alerts(scored, ["MEDIUM"], 0)) == ["T2"]
    assert ids(P.filter_alerts(scored, None, 0, "u[12]")) == ["T1", "T2"]
    assert ids(P.lookup(scored, "T2")) == ["T2"]


def test_payload_is_the_first_known_value(spark):
    """Of several rows of an id each column comes from the first that has it, by rule and time."""
    day = lambda d: datetime(2024, 1, d)
    rows = [
        ("A", "U2", 3.0, day(2), "x", "HIGH_VALUE", 30), ("A", None, 5.0, day(1), None, "HIGH_VALUE", 50),
        ("B", None, 1.0, None, None, "HIGH_VALUE", 30), ("B", "U1", None, day(3), "y", "VELOCITY", 40),
        ("C", "U1", 2.0, day(4), "z", "VELOCITY", 40), ("C", "U1", 2.0, day(5), "a", "VELOCITY", 50),
        (None, None, 9.0, None, None, "HIGH_VALUE", 30),
    ]
    schema = SCHEMA.replace(", weighted_score double", "")
    scored = S.score_flags(spark.createDataFrame(rows, schema))
    got = {r["transaction_id"]: tuple(r)[1:7] for r in scored.collect()}
    assert got == {
        "A": ("U2", 5.0, day(1), "x", "HIGH_VALUE", 80),
        "B": ("U1", 1.0, day(3), "y", "HIGH_VALUE, VELOCITY", 70),
        "C": ("U1", 2.0, day(4), "z", "VELOCITY", 40),
        None: (None, 9.0, None, None, "HIGH_VALUE", 30),
    }
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("min_by(") == len(S.RULE_ORDER) - 1  # none for the payload
