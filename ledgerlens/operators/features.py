"""Per-transaction and per-user features for the anomaly models.

All per-user columns share one ``user_id`` shuffle and one sort.  Users with
more than ``hot_rows`` rows are split into ordered pieces that carry the rows
a trailing window looks back on, and their whole-history statistics come from
combined aggregates instead of a window.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from ledgerlens.functions.hot_keys import ROW, HotKeys, find_hot_keys, only_hot, without_hot
from ledgerlens.functions.numbering import number_rows
from ledgerlens.functions.pieces import LEAD_IN, PIECE, with_lead_in, with_piece
from ledgerlens.functions.quantiles import exact_quantiles
from ledgerlens.settings import materialised

# Upper ends of the amount bins (right-closed), rolling window
# lengths in rows, and the thresholds of the amount and frequency features.
AMOUNT_BIN_ENDS = [100, 500, 1000, 5000, 10000, 50000]
SHORT_ROWS = 7
LONG_ROWS = 30
REPORTING_LIMIT = 10_000
NEAR_LIMIT = 1_000
STRUCTURING_RANGE = (9_000, 9_999)
DORMANT_DAYS = 90

# Names of the 37 numeric features, in matrix order.
FEATURE_COLUMNS = [
    "amount", "hour", "day_of_week",
    "amount_log", "is_round_1000", "is_round_5000", "amount_bin",
    "hour_sin", "hour_cos", "is_weekend", "day_of_month", "is_business_hours", "is_late_night",
    "user_avg_amount", "user_std_amount", "user_median_amount", "user_min_amount",
    "user_max_amount", "user_amount_count", "user_total_transactions",
    "amount_vs_user_avg", "amount_diff_from_avg", "amount_zscore",
    "rolling_7d_avg", "rolling_7d_std", "rolling_30d_avg", "recent_trans_count",
    "amount_vs_rolling_7d", "amount_vs_rolling_30d",
    "dist_from_10k", "near_10k_threshold", "in_structuring_range", "has_decimals",
    "hours_since_last", "days_since_last", "is_rapid_succession", "is_dormant_reactivation",
]

#: When a row counts in its user's order: rows without a time come last.
_WHEN = "_when"
_ORDER = [_WHEN, "transaction_id"]


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def placed(df: DataFrame) -> DataFrame:
    """Rows with a user; only those have per-user features."""
    end = F.lit("9999-12-31 23:59:59").cast(df.schema["timestamp"].dataType)
    return df.filter(F.col("user_id").isNotNull()).withColumn(_WHEN, F.coalesce("timestamp", end))


# --- row-local features -----------------------------------------------------


def add_basic_features(df: DataFrame) -> DataFrame:
    amount = F.col("amount")
    bins = F.lit(len(AMOUNT_BIN_ENDS))
    for code, end in reversed(list(enumerate(AMOUNT_BIN_ENDS))):
        bins = F.when(amount <= end, code).otherwise(bins)
    return df.withColumn("amount", amount.cast("double")).withColumns(
        {
            "amount_log": F.log1p("amount"),
            "is_round_1000": _flag(amount % 1000 == 0),
            "is_round_5000": _flag(amount % 5000 == 0),
            "amount_bin": F.when(amount > 0, bins),
        }
    )


def add_type_codes(df: DataFrame) -> DataFrame:
    """``trans_type_encoded``: position among the sorted types, -1 for none."""
    if "transaction_type" not in df.columns:
        return df
    types = df.select("transaction_type").filter("transaction_type is not null").distinct()
    codes = number_rows(types, ["transaction_type"], "_code", start=0)
    return df.join(codes, "transaction_type", "left").select(
        *df.columns, F.coalesce("_code", F.lit(-1)).cast("int").alias("trans_type_encoded")
    )


def add_time_features(df: DataFrame) -> DataFrame:
    hour, weekday = F.hour("timestamp"), F.weekday("timestamp")
    angle = F.lit(2 * math.pi) * hour / 24
    return df.withColumns(
        {
            "hour": hour,
            "hour_sin": F.sin(angle),
            "hour_cos": F.cos(angle),
            "day_of_week": weekday,
            "is_weekend": _flag(weekday >= 5),
            "day_of_month": F.dayofmonth("timestamp"),
            "is_business_hours": _flag(hour.between(9, 17) & (weekday < 5)),
            "is_late_night": _flag((hour >= 23) | (hour <= 5)),
        }
    )


def add_amount_features(df: DataFrame) -> DataFrame:
    amount = F.col("amount")
    distance = F.abs(amount - REPORTING_LIMIT)
    return df.withColumns(
        {
            "dist_from_10k": distance,
            "near_10k_threshold": _flag(distance < NEAR_LIMIT),
            "in_structuring_range": _flag(amount.between(*STRUCTURING_RANGE)),
            "has_decimals": _flag(amount % 1 != 0),
        }
    )


# --- per-user features ------------------------------------------------------


def _user_stats() -> dict[str, Column]:
    return {
        "user_avg_amount": F.avg("amount"),
        "user_std_amount": F.stddev_samp("amount"),
        "user_median_amount": F.median("amount"),
        "user_min_amount": F.min("amount"),
        "user_max_amount": F.max("amount"),
        "user_amount_count": F.count("amount"),
        "user_total_transactions": F.count("transaction_id"),
    }


def _stats_by_window(df: DataFrame) -> DataFrame:
    by_user = Window.partitionBy("user_id")
    return df.withColumns({name: c.over(by_user) for name, c in _user_stats().items()})


def _stats_by_join(df: DataFrame) -> DataFrame:
    """For hot users: one row per hot user is joined back, broadcast if its size allows."""
    simple = [c.alias(n) for n, c in _user_stats().items() if n != "user_median_amount"]
    stats = df.groupBy("user_id").agg(*simple)
    medians = exact_quantiles(df, "amount", [0.5], by=["user_id"]).select(
        "user_id", F.col("quantiles")[0].alias("user_median_amount")
    )
    whole = materialised(stats.join(medians, "user_id", "left"), "user-statistics")
    return df.join(whole, "user_id")


def _against_user(df: DataFrame) -> DataFrame:
    amount, mean, std = F.col("amount"), F.col("user_avg_amount"), F.col("user_std_amount")
    return df.withColumn("user_std_amount", F.coalesce(std, F.lit(0.0))).withColumns(
        {
            "amount_vs_user_avg": F.try_divide(amount, mean + 1),
            "amount_diff_from_avg": amount - mean,
            "amount_zscore": F.when(std > 0, (amount - mean) / std).otherwise(0.0),
        }
    )


def _rolling(df: DataFrame, in_order: WindowSpec) -> DataFrame:
    short = in_order.rowsBetween(1 - SHORT_ROWS, 0)
    long = in_order.rowsBetween(1 - LONG_ROWS, 0)
    return df.withColumns(
        {
            "rolling_7d_avg": F.avg("amount").over(short),
            "rolling_7d_std": F.coalesce(F.stddev_samp("amount").over(short), F.lit(0.0)),
            "recent_trans_count": F.count(F.lit(1)).over(short).cast("double"),
            "rolling_30d_avg": F.avg("amount").over(long),
        }
    ).withColumns(
        {
            "amount_vs_rolling_7d": F.try_divide(F.col("amount"), F.col("rolling_7d_avg") + 1),
            "amount_vs_rolling_30d": F.try_divide(F.col("amount"), F.col("rolling_30d_avg") + 1),
        }
    )


def _frequency(df: DataFrame, in_order: WindowSpec) -> DataFrame:
    previous = F.lag("timestamp").over(in_order)
    df = df.withColumn("_previous", previous).withColumn(
        "time_since_last", F.col("timestamp") - F.col("_previous")
    )
    hours = F.expr("timestampdiff(MICROSECOND, _previous, timestamp)") / F.lit(3.6e9)
    return (
        df.withColumn("hours_since_last", F.coalesce(hours, F.lit(0.0)))
        .withColumn("days_since_last", F.col("hours_since_last") / 24)
        .withColumns(
            {
                # A user's first row counts as 0 hours after the last one.
                "is_rapid_succession": _flag(F.col("hours_since_last") < 1),
                "is_dormant_reactivation": _flag(F.col("days_since_last") > DORMANT_DAYS),
            }
        )
        .drop("_previous")
    )


def _over_users(
    df: DataFrame,
    hot: HotKeys | None,
    ordered: list[Callable[[DataFrame, WindowSpec], DataFrame]],
    stats: bool,
) -> DataFrame:
    """Run the ordered steps (and the user statistics) per user."""
    rows = placed(df)
    hot = find_hot_keys(rows) if hot is None else hot

    def steps(part: DataFrame, in_order: WindowSpec) -> DataFrame:
        return reduce(lambda d, step: step(d, in_order), ordered, part)

    light = without_hot(rows, hot)
    if stats:
        light = _stats_by_window(light)
    result = steps(light, Window.partitionBy("user_id").orderBy(*_ORDER))
    if hot:
        heavy = only_hot(rows, hot)
        if stats:
            heavy = _stats_by_join(heavy)
        if ordered:
            keys, order = ["user_id"], [*_ORDER, ROW]
            split = with_piece(heavy, keys, order, math.ceil(hot.rows / hot.piece_rows))
            split = with_lead_in(split, keys, order, LONG_ROWS - 1)
            split = steps(split, Window.partitionBy("user_id", PIECE).orderBy(*order))
            heavy = split.filter(~F.col(LEAD_IN)).drop(LEAD_IN, PIECE)
        result = result.unionByName(heavy.drop(ROW))
    result = result.drop(_WHEN)
    return _against_user(result) if stats else result


def add_user_features(df: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    return _over_users(df, hot, [], stats=True)


def add_rolling_features(df: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Rolling statistics; the windows are 7 and 30 *rows* despite the names."""
    return _over_users(df, hot, [_rolling], stats=False)


def add_frequency_features(df: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    return _over_users(df, hot, [_frequency], stats=False)


# --- drivers ------------------------------------------------------------------


def create_all_features(
    df: DataFrame, hot: HotKeys | None = None, type_codes: bool = True
) -> DataFrame:
    """Every feature.  Row-local ones are added after the shuffle so that only
    input columns travel through it."""
    result = _over_users(df, hot, [_frequency, _rolling], stats=True)
    result = add_amount_features(add_time_features(add_basic_features(result)))
    return add_type_codes(result) if type_codes else result


def get_feature_matrix(features: DataFrame, names: list[str] | None = None) -> DataFrame:
    """``transaction_id`` and the numeric features, missing values as 0."""
    names = names or FEATURE_COLUMNS
    numeric = [F.col(n).cast("double").alias(n) for n in names]
    return features.select("transaction_id", *numeric).na.fill(0.0, names)


def prepare_for_ml(df: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Raw transactions to feature matrix; payload columns never shuffle."""
    narrow = df.select("transaction_id", "user_id", "timestamp", "amount")
    return get_feature_matrix(create_all_features(narrow, hot, type_codes=False))
