"""Registered queries: every operator over the whole supplied tables.

Each query is ``(spark, sf_dir) -> DataFrame``.  Fractional results are
rounded because distributed sums add in varying order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import settings
from ledgerlens.functions.hot_keys import HotKeys, find_hot_keys
from ledgerlens.functions.quantiles import ACCURACY, exact_quantile, exact_quantiles
from ledgerlens.operators import alerts as A
from ledgerlens.operators import evaluation as E
from ledgerlens.operators import features as X
from ledgerlens.operators import models as M
from ledgerlens.operators import reports as P
from ledgerlens.operators import rules as R
from ledgerlens.operators import scoring as S
from ledgerlens.plans import detection as D
from ledgerlens.plans.fixture import transactions
from ledgerlens.sources import exports, model_store
from ledgerlens.sources import transactions as IO
from ledgerlens.sources.alert_store import AlertStore
from ledgerlens.streaming.alert_sink import write_alerts
from ledgerlens.streaming.rules import high_value_stream, velocity_stream

Query = Callable[[SparkSession, str], DataFrame]

# Fixed moments so that results do not depend on the clock.
FIRST_LOAD = datetime(2024, 2, 1)
SECOND_LOAD = datetime(2024, 2, 5)
REVIEWED = datetime(2024, 2, 6)
AS_OF = datetime(2024, 2, 10)

#: Users with more rows than this take the hot-user route in the ``*_skewed``
#: queries; the results must be those of the ordinary route.
FEW_ROWS = 20
#: Rows of a piece there, so that users are cut at the borders of pieces.
FEW_PIECE_ROWS = 500

#: Accuracy at which the ``*_split`` queries bracket quantiles even in small
#: groups; the results must be the same.
COARSE = 400

FLAG_COLUMNS = [
    "transaction_id", "user_id", "timestamp", "amount", "transaction_type",
    "rule_triggered", "risk_score",
]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def cents(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of amounts, to the cent."""
    return rounded(df, 2, *columns)


def single(df: DataFrame, *columns: str) -> DataFrame:
    """Averages of cents often end in a 5 that decimal rounding may turn either
    way; single precision has no such ties."""
    return df.withColumns({c: F.col(c).cast("float") for c in columns})


def heavy_users(tx: DataFrame) -> HotKeys:
    return find_hot_keys(tx, limit=FEW_ROWS, piece_rows=FEW_PIECE_ROWS)


def scored_view(spark: SparkSession, d: str) -> DataFrame:
    return D.score_transactions(transactions(spark, d))


def _scored(df: DataFrame) -> DataFrame:
    return rounded(df, 6, "weighted_score")


# --- rules ----------------------------------------------------------------------


@query
def rule_high_value(spark, d):
    return R.detect_high_value_transactions(transactions(spark, d)).select(*FLAG_COLUMNS)


@query
def rule_velocity(spark, d):
    return R.detect_velocity_anomalies(transactions(spark, d)).select(*FLAG_COLUMNS)


@query
def rule_structuring(spark, d):
    return R.detect_structuring(transactions(spark, d)).select(*FLAG_COLUMNS)


@query
def rule_dormant(spark, d):
    return R.detect_dormant_account_activity(transactions(spark, d)).select(*FLAG_COLUMNS)


@query
def rule_round_numbers(spark, d):
    return R.detect_round_number_pattern(transactions(spark, d)).select(*FLAG_COLUMNS)


@query
def rule_counts(spark, d):
    return R.rule_counts(R.all_flags(transactions(spark, d)))


@query
def combined_flags(spark, d):
    flags = S.combine_rule_results(R.run_all_rules(transactions(spark, d)))
    return rounded(flags, 6, "weighted_score").select(*FLAG_COLUMNS, "weighted_score")


@query
def combined_flags_skewed(spark, d):
    tx = transactions(spark, d)
    flags = S.with_weighted_score(R.all_flags(tx, hot=heavy_users(tx)))
    return rounded(flags, 6, "weighted_score").select(*FLAG_COLUMNS, "weighted_score")


@query
def combined_totals(spark, d):
    return S.combine_totals(R.all_flags(transactions(spark, d)))


# --- scores ---------------------------------------------------------------------


@query
def scored_transactions(spark, d):
    return _scored(scored_view(spark, d))


@query
def scored_transactions_skewed(spark, d):
    tx = transactions(spark, d)
    return _scored(D.score_transactions(tx, hot=heavy_users(tx)))


@query
def cumulative_scores(spark, d):
    flags = S.with_weighted_score(R.all_flags(transactions(spark, d)))
    return _scored(S.calculate_cumulative_scores(flags))


@query
def risk_distribution(spark, d):
    return S.get_risk_distribution(scored_view(spark, d))


@query
def top_risky(spark, d):
    return _scored(S.get_top_risky_transactions(scored_view(spark, d), 10))


@query
def high_risk_users(spark, d):
    users = S.get_high_risk_users(scored_view(spark, d))
    return cents(rounded(users, 4, "avg_risk_score"), "total_amount")


@query
def critical_risk_users(spark, d):
    users = S.get_high_risk_users(scored_view(spark, d), "CRITICAL")
    return cents(rounded(users, 4, "avg_risk_score"), "total_amount")


@query
def risk_report(spark, d):
    report = S.generate_risk_report(scored_view(spark, d))
    return cents(rounded(report, 4, "average_score"), "total_flagged_amount")


@query
def rule_combinations(spark, d):
    return S.rule_combinations(scored_view(spark, d))


@query
def top_rule_combinations(spark, d):
    return S.rule_combinations(scored_view(spark, d), 5)


@query
def level_percentages(spark, d):
    return rounded(S.level_percentages(scored_view(spark, d)), 4, "percentage")


# --- alert table ------------------------------------------------------------------


def _no_alerts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], A.ALERT_SCHEMA)


def _first_alerts(spark: SparkSession, d: str) -> DataFrame:
    """Alerts of a first run with the amount rule alone."""
    flags = R.detect_high_value_transactions(transactions(spark, d))
    return A.insert_ignore(_no_alerts(spark), S.score_flags(flags), FIRST_LOAD)


def _all_alerts(spark: SparkSession, d: str) -> DataFrame:
    """The table after a second run with all rules."""
    return A.insert_ignore(_first_alerts(spark, d), scored_view(spark, d), SECOND_LOAD)


@query
def alerts_insert_ignore(spark, d):
    return _all_alerts(spark, d)


@query
def alerts_upsert(spark, d):
    critical = scored_view(spark, d).filter("risk_level = 'CRITICAL'")
    return A.upsert(_first_alerts(spark, d), critical, SECOND_LOAD)


@query
def alerts_query(spark, d):
    return A.get_alerts(_all_alerts(spark, d), risk_level="HIGH", status="NEW", limit=100)


@query
def alert_stats_totals(spark, d):
    return A.alert_totals(_all_alerts(spark, d), AS_OF)


@query
def alert_stats_level(spark, d):
    return A.alerts_by(_all_alerts(spark, d), "risk_level")


def _reviews(alerts: DataFrame) -> DataFrame:
    return alerts.filter("risk_level = 'HIGH'").select(
        "alert_id", F.lit("UNDER_REVIEW").alias("status"), F.lit("analyst").alias("reviewed_by")
    )


@query
def alert_status_update(spark, d):
    alerts = _all_alerts(spark, d)
    return A.update_status(alerts, _reviews(alerts), REVIEWED)


@query
def alert_stats_status(spark, d):
    alerts = _all_alerts(spark, d)
    return A.alerts_by(A.update_status(alerts, _reviews(alerts), REVIEWED), "status")


@query
def alert_top_users(spark, d):
    return cents(A.top_alert_users(_all_alerts(spark, d)), "total_amount")


@query
def alert_delete(spark, d):
    alerts = _all_alerts(spark, d)
    return A.delete_alerts(alerts, alerts.filter("risk_level = 'LOW'"))


@query
def alert_table_scan(spark, d):
    """Two loads through the stored table, then its scan."""
    store = AlertStore(spark, settings.scratch_path(spark, "alerts"))
    flags = R.detect_high_value_transactions(transactions(spark, d))
    store.store_alerts(S.score_flags(flags), created_at=FIRST_LOAD)
    store.store_alerts(scored_view(spark, d), created_at=SECOND_LOAD)
    return store.read()


@query
def alert_store_changes(spark, d):
    """Insert, review, delete and replace through the stored table, then its scan."""
    store = AlertStore(spark, settings.scratch_path(spark, "alerts"))
    flags = R.detect_high_value_transactions(transactions(spark, d))
    store.store_alerts(S.score_flags(flags), created_at=FIRST_LOAD)
    scored = settings.materialised(scored_view(spark, d), "scored")
    store.store_alerts(scored, created_at=SECOND_LOAD)
    store.update_statuses(_reviews(store.read()), REVIEWED)
    store.delete_alerts(store.read().filter("risk_level = 'LOW'"))
    store.store_alerts(scored.filter("risk_level = 'CRITICAL'"), True, SECOND_LOAD)
    return store.read()


@query
def alert_store_compacted(spark, d):
    """The same table after its changes were merged into one snapshot."""
    path = settings.scratch_path(spark, "alerts")
    store = AlertStore(spark, path)
    store.store_alerts(scored_view(spark, d), created_at=FIRST_LOAD)
    store.update_statuses(_reviews(store.read()), REVIEWED)
    store.compact()
    return AlertStore(spark, path).read()


@query
def alert_store_cleared(spark, d):
    """Rows before and after clearing, and the first id given out afterwards."""
    store = AlertStore(spark, settings.scratch_path(spark, "alerts"))
    scored = settings.materialised(scored_view(spark, d), "scored")
    store.store_alerts(scored, created_at=FIRST_LOAD)
    kept = store.clear_all_alerts()
    cleared = store.clear_all_alerts(confirm=True)
    left = store.read().count()
    store.store_alerts(scored.filter("risk_level = 'CRITICAL'"), created_at=SECOND_LOAD)
    return store.read().agg(F.min("alert_id").alias("first_id"), F.count("*").alias("again")).select(
        F.lit(kept).cast("long").alias("kept"), F.lit(cleared).cast("long").alias("cleared"),
        F.lit(left).cast("long").alias("left_over"), "first_id", "again",
    )


# --- features ---------------------------------------------------------------------


@query
def features_basic(spark, d):
    df = X.add_type_codes(X.add_basic_features(transactions(spark, d)))
    return rounded(df, 6, "amount_log").select(
        "transaction_id", "amount", "amount_log", "is_round_1000", "is_round_5000", "amount_bin",
        "trans_type_encoded",
    )


@query
def features_time(spark, d):
    df = X.add_time_features(transactions(spark, d))
    return rounded(df, 6, "hour_sin", "hour_cos").select(
        "transaction_id", "hour", "hour_sin", "hour_cos", "day_of_week", "is_weekend",
        "day_of_month", "is_business_hours", "is_late_night",
    )


USER_FEATURES = [
    "user_avg_amount", "user_std_amount", "user_median_amount", "user_min_amount",
    "user_max_amount", "user_amount_count", "user_total_transactions", "amount_vs_user_avg",
    "amount_diff_from_avg", "amount_zscore",
]
AVERAGES = ["user_avg_amount", "amount_diff_from_avg", "rolling_7d_avg", "rolling_30d_avg"]
USER_ROUNDED = [
    c for c in USER_FEATURES if "count" not in c and "total" not in c and c not in AVERAGES
]
ROLLING_FEATURES = [
    "rolling_7d_avg", "rolling_7d_std", "rolling_30d_avg", "recent_trans_count",
    "amount_vs_rolling_7d", "amount_vs_rolling_30d",
]
FREQUENCY_FEATURES = [
    "hours_since_last", "days_since_last", "is_rapid_succession", "is_dormant_reactivation",
]


def _users(df: DataFrame) -> DataFrame:
    df = single(rounded(df, 4, *USER_ROUNDED), *AVERAGES[:2])
    return df.select("transaction_id", *USER_FEATURES)


def _rolling(df: DataFrame) -> DataFrame:
    df = rounded(df, 4, *[c for c in ROLLING_FEATURES if c not in AVERAGES])
    return single(df, *AVERAGES[2:]).select("transaction_id", *ROLLING_FEATURES)


def _frequency(df: DataFrame) -> DataFrame:
    return rounded(df, 6, "hours_since_last", "days_since_last").select(
        "transaction_id", *FREQUENCY_FEATURES
    )


@query
def features_user(spark, d):
    return _users(X.add_user_features(transactions(spark, d)))


@query
def features_user_skewed(spark, d):
    tx = transactions(spark, d)
    return _users(X.add_user_features(tx, heavy_users(tx)))


@query
def features_rolling(spark, d):
    return _rolling(X.add_rolling_features(transactions(spark, d)))


@query
def features_rolling_skewed(spark, d):
    tx = transactions(spark, d)
    return _rolling(X.add_rolling_features(tx, heavy_users(tx)))


@query
def features_frequency(spark, d):
    return _frequency(X.add_frequency_features(transactions(spark, d)))


@query
def features_frequency_skewed(spark, d):
    tx = transactions(spark, d)
    return _frequency(X.add_frequency_features(tx, heavy_users(tx)))


@query
def features_amount(spark, d):
    df = X.add_amount_features(transactions(spark, d))
    return rounded(df, 4, "dist_from_10k").select(
        "transaction_id", "dist_from_10k", "near_10k_threshold", "in_structuring_range",
        "has_decimals",
    )


@query
def feature_matrix(spark, d):
    matrix = X.prepare_for_ml(transactions(spark, d))
    return single(
        rounded(matrix, 4, *[c for c in X.FEATURE_COLUMNS if c not in AVERAGES]), *AVERAGES
    )


# --- models -----------------------------------------------------------------------


def _matrix(spark: SparkSession, d: str) -> DataFrame:
    return D.scaled_matrix(transactions(spark, d))


@query
def standardised_features(spark, d):
    return rounded(_matrix(spark, d), 4, *X.FEATURE_COLUMNS)


@query
def stored_scaler(spark, d):
    """Scaling with parameters that went through storage."""
    matrix = settings.materialised(X.prepare_for_ml(transactions(spark, d)))
    path = settings.scratch_path(spark, "models")
    fitted = model_store.Models(scaler=M.fit_scaler(matrix, X.FEATURE_COLUMNS))
    model_store.save_models(spark, fitted, path)
    loaded = model_store.load_models(spark, path).scaler
    return rounded(loaded.transform(matrix), 4, *X.FEATURE_COLUMNS)


#: Two given centres, so that distances have a SQL equivalent.
CENTERS = [[0.0] * len(X.FEATURE_COLUMNS), [1.0] * len(X.FEATURE_COLUMNS)]


def _distances(matrix: DataFrame, accuracy: int = ACCURACY) -> DataFrame:
    placed = M.with_centroid_distance(matrix, X.FEATURE_COLUMNS, CENTERS).select(
        "transaction_id", "cluster", "distance_to_centroid"
    )
    return M.flag_distance_outliers(placed, accuracy=accuracy)


@query
def distance_outliers(spark, d):
    return rounded(_distances(_matrix(spark, d)), 4, "distance_to_centroid")


@query
def distance_outliers_split(spark, d):
    """The same with the percentile found between two approximate ones."""
    return rounded(_distances(_matrix(spark, d), accuracy=COARSE), 4, "distance_to_centroid")


@query
def feature_importance(spark, d):
    placed = M.with_centroid_distance(_matrix(spark, d), X.FEATURE_COLUMNS, CENTERS)
    ranked = M.get_feature_importance(placed, X.FEATURE_COLUMNS, "distance_to_centroid")
    return rounded(ranked, 4, "importance")


#: Three trees of one split each, so that scores have a SQL equivalent.
STUMPS = [("amount", 5000.0, 2.0, 6.0), ("hour", 11.0, 5.0, 3.0), ("is_weekend", 0.0, 7.0, 4.0)]


def literal_forest() -> M.IsolationForest:
    at = [X.FEATURE_COLUMNS.index(name) for name, *_ in STUMPS]
    return M.IsolationForest(
        X.FEATURE_COLUMNS, M.SUBSAMPLE,
        np.array([[f, -1, -1] for f in at]), np.array([[c, 0, 0] for _, c, _, _ in STUMPS]),
        np.array([[0, low, high] for _, _, low, high in STUMPS]), M.CONTAMINATION,
    )


def _literal_predictions(tx: DataFrame) -> DataFrame:
    """Scores and flags of the literal forest, with the exact threshold."""
    model = literal_forest()
    scores = settings.materialised(model.score(X.prepare_for_ml(tx)))
    threshold = exact_quantile(scores, "ml_anomaly_score", 1 - M.CONTAMINATION)
    return replace(model, threshold=threshold).label(scores)


@query
def given_forest_flags(spark, d):
    return rounded(_literal_predictions(transactions(spark, d)), 9, "ml_anomaly_score")


@query
def stored_forest(spark, d):
    """The given forest after it went through storage."""
    path = settings.scratch_path(spark, "models")
    matrix = settings.materialised(X.prepare_for_ml(transactions(spark, d)))
    scores = settings.materialised(literal_forest().score(matrix))
    threshold = exact_quantile(scores, "ml_anomaly_score", 1 - M.CONTAMINATION)
    fitted = model_store.Models(forest=replace(literal_forest(), threshold=threshold))
    model_store.save_models(spark, fitted, path)
    loaded = model_store.load_models(spark, path).forest
    return rounded(loaded.predict(matrix), 9, "ml_anomaly_score")


def _placed(outliers: DataFrame) -> DataFrame:
    return rounded(outliers, 4, "distance_to_centroid")


@query
def stored_kmeans(spark, d):
    """Outliers by a k-means that went through storage."""
    path = settings.scratch_path(spark, "models")
    matrix = settings.materialised(_matrix(spark, d))
    fitted = model_store.Models(kmeans=M.fit_kmeans(matrix, X.FEATURE_COLUMNS))
    model_store.save_models(spark, fitted, path)
    loaded = model_store.load_models(spark, path).kmeans
    return _placed(M.predict_kmeans_outliers(loaded, matrix, X.FEATURE_COLUMNS))


@query
def given_forest_summary(spark, d):
    summary = M.forest_summary(_literal_predictions(transactions(spark, d)))
    return rounded(summary, 6, "anomaly_rate", "min_score", "max_score")


@query
def given_forest_ids(spark, d):
    return E.isolation_forest_ids(_literal_predictions(transactions(spark, d)))


@query
def given_forest_alerts(spark, d):
    """The ML flag on scored transactions."""
    tx = transactions(spark, d)
    return _scored(M.with_ml_flag(D.score_transactions(tx), _literal_predictions(tx)))


@query
def given_forest_hybrid(spark, d):
    tx = transactions(spark, d)
    both = M.with_hybrid_score(D.score_transactions(tx), _literal_predictions(tx))
    return rounded(_scored(both), 6, "hybrid_score", "ml_anomaly_score")


@query
def isolation_forest_fit(spark, d):
    """What must hold of a fitted forest, one row."""
    matrix = settings.materialised(_matrix(spark, d))
    model, scores = M.fit_isolation_forest(matrix, X.FEATURE_COLUMNS)
    inner = (model.feature >= 0).sum(axis=1)
    leaves = (model.path > 0).sum(axis=1)
    flagged = model.label(scores).filter("ml_prediction = -1").count()
    # The threshold by its rank: how many scores lie below it and up to it.
    score, rank = F.col("ml_anomaly_score"), int(0.95 * (scores.count() - 1))
    below, up_to = scores.agg(F.count_if(score < model.threshold), F.count_if(score <= model.threshold)).first()
    placed = below <= rank + 1 <= up_to and flagged == scores.count() - up_to
    row = (
        len(inner), model.per_tree, bool(np.log2(model.feature.shape[1] + 1) - 1 <= 8),
        bool((leaves == inner + 1).all()), placed, scores.count(),
        bool(0 < flagged <= 0.05 * scores.count() + 1),
    )
    return spark.createDataFrame(
        [row], "trees long, rows_per_tree long, depth_ok boolean, leaves_ok boolean, "
        "flags_ok boolean, scored long, share_ok boolean")


def nearer_elsewhere(placed, names, centers):
    """Rows to whose values another centre is nearer than that of their ``cluster``."""
    away = [sum(((F.col(n) - F.lit(float(v))) ** 2 for n, v in zip(names, c)), F.lit(0.0)) for c in centers]
    far = placed.select("cluster", F.array(*away).alias("away"))
    least = F.array_min("away")
    return far.filter(F.get("away", F.col("cluster")) > least + 1e-9 * (1 + least)).count()


def covariances(df, column, n):
    """Covariances of the ``n`` entries of an array column, a matrix."""

    def products(batches):
        rows, mean, total = 0, np.zeros(n), np.zeros((n, n))
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
            if len(values):
                own = values.mean(axis=0)
                values = values - own
                rows, mean, total = merged((rows, mean, total), (len(values), own, values.T @ values))
        yield pa.RecordBatch.from_arrays(
            [pa.array([rows]), pa.array([mean.tolist()]), pa.array([total.ravel().tolist()])], ["rows", "mean", "total"])

    def merged(a, b):
        rows, apart = a[0] + b[0], b[1] - a[1]
        share = b[0] / max(rows, 1)
        return rows, a[1] + apart * share, a[2] + b[2] + np.outer(apart, apart) * a[0] * share

    parts = df.select(column).mapInArrow(products, "rows long, mean array<double>, total array<double>").collect()
    totals = [(p["rows"], np.array(p["mean"]), np.array(p["total"]).reshape(n, n)) for p in parts]
    rows, _, total = reduce(merged, totals, (0, np.zeros(n), np.zeros((n, n))))
    return total / max(rows - 1, 1)


@query
def kmeans_fit(spark, d):
    """What must hold of a fitted k-means, one row."""
    matrix = settings.materialised(_matrix(spark, d))
    names = X.FEATURE_COLUMNS
    model = M.fit_kmeans(matrix, names)
    centers = model.centers.tolist()
    placed = M.predict_kmeans_outliers(model, matrix, names)
    own = M.with_centroid_distance(matrix, names, centers)
    means = {r["cluster"]: r for r in own.groupBy("cluster").agg(*[F.avg(n).alias(n) for n in names]).collect()}
    off = max(abs(means[c][n] - centers[c][i]) for c in means for i, n in enumerate(names))
    nearer = nearer_elsewhere(
        placed.select("transaction_id", "cluster").join(matrix, "transaction_id"), names, centers)
    sizes = M.cluster_sizes(placed)
    return sizes.agg(
        F.sum("transactions").alias("placed"), F.sum("outliers").alias("outliers"),
        F.count("*").alias("clusters"), F.round(F.sum("percentage"), 6).alias("percent"),
    ).withColumn("centres_ok", F.lit(bool(off < 0.05 and nearer == 0)))


@query
def pca_fit(spark, d):
    """What must hold of all 37 components, one row."""
    matrix = settings.materialised(_matrix(spark, d))
    names = X.FEATURE_COLUMNS
    reduced, shares = M.apply_pca(matrix, names, len(names))
    reduced = settings.materialised(reduced, "components")
    spread = covariances(reduced, "components", len(names))
    between = [float(spread[i, j]) for i in range(len(names)) for j in range(i)]
    rows, _, _, squares = M.co_moments(matrix, [(n, n) for n in names])
    whole = float((squares / np.maximum(rows - 1, 1)).sum())
    variances = spread.diagonal().tolist()
    row = (
        reduced.count(), len(variances), bool(abs(sum(variances) - whole) < 1e-6 * whole),
        bool(max(abs(c) for c in between) < 1e-6), bool(abs(sum(shares) - 1) < 1e-9),
        bool(all(a >= b - 1e-9 for a, b in zip(variances, variances[1:]))),
    )
    return spark.createDataFrame(
        [row], "rows long, components long, variance_ok boolean, uncorrelated boolean, "
        "shares_ok boolean, falling boolean")


@query
def isolation_forest_flags(spark, d):
    return rounded(D.forest_predictions(_matrix(spark, d)), 9, "ml_anomaly_score")


@query
def isolation_forest_summary(spark, d):
    summary = M.forest_summary(D.forest_predictions(_matrix(spark, d)))
    return rounded(summary, 6, "anomaly_rate", "min_score", "max_score")


@query
def kmeans_outliers(spark, d):
    return _placed(D.kmeans_outliers(_matrix(spark, d)))


@query
def kmeans_cluster_sizes(spark, d):
    return rounded(M.cluster_sizes(D.kmeans_outliers(_matrix(spark, d))), 6, "percentage")


@query
def pca_projection(spark, d):
    return M.apply_pca(_matrix(spark, d), X.FEATURE_COLUMNS)[0]


@query
def full_run(spark, d):
    """Load, rules, scores, alert table and analysis in one run."""
    store = AlertStore(spark, settings.scratch_path(spark, "full-run"))
    run = D.detect_and_store(transactions(spark, d), store, created_at=FIRST_LOAD)
    summary = cents(rounded(run.summary, 4, "average_score", "flag_rate"), "flagged_amount")
    parts = [
        summary.withColumn("stored", F.lit(run.stored).cast("long")),
        run.top_transactions.agg(F.sum("final_risk_score").alias("top_ten_score")),
        run.high_risk_users.agg(F.count("user_id").alias("high_risk_users")),
        run.rule_effectiveness.agg(F.sum("count").alias("rule_hits")),
        run.metrics.select("true_positives", "false_positives", "false_negatives"),
        run.patterns.agg(
            F.sum("detected").alias("detected_labels"), F.sum("total").alias("labels")
        ),
    ]
    # One row each.
    tagged = [p.withColumn("_one", F.lit(1)) for p in parts]
    return reduce(lambda a, b: a.join(b, "_one"), tagged).drop("_one")


@query
def ml_flagged_alerts(spark, d):
    return _scored(D.run_detection(transactions(spark, d), use_ml=True))


@query
def hybrid_score(spark, d):
    tx = transactions(spark, d)
    both = M.with_hybrid_score(D.score_transactions(tx), D.forest_predictions(D.scaled_matrix(tx)))
    return rounded(_scored(both), 6, "hybrid_score", "ml_anomaly_score")


@query
def sampled_transactions(spark, d):
    return M.sample_rows(transactions(spark, d), 10_000)


# --- evaluation -------------------------------------------------------------------


def _methods(spark: SparkSession, d: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Rules and distance outliers as methods, and their union."""
    tx = transactions(spark, d)
    hot = find_hot_keys(tx)
    rules = E.rules_based_ids(R.all_flags(tx, hot=hot))
    ml = E.kmeans_ids(_distances(D.scaled_matrix(tx, hot)))
    rules, ml = settings.materialised(rules), settings.materialised(ml)
    return tx, {E.RULES: rules, E.KMEANS: ml, E.HYBRID: E.hybrid_ids(rules, ml)}


@query
def rules_method_ids(spark, d):
    return E.rules_based_ids(R.all_flags(transactions(spark, d)))


@query
def hybrid_sets(spark, d):
    _, sets = _methods(spark, d)
    return E.hybrid_overlap(sets[E.RULES], sets[E.KMEANS])


@query
def hybrid_method_ids(spark, d):
    _, sets = _methods(spark, d)
    both = E.intersection_ids(sets[E.RULES], sets[E.KMEANS]).withColumn("both", F.lit(True))
    return sets[E.HYBRID].join(both, "transaction_id", "left").select(
        "transaction_id", F.coalesce("both", F.lit(False)).alias("high_confidence")
    )


RATES = ["precision", "recall", "f1_score", "accuracy", "efficiency"]


@query
def confusion_by_method(spark, d):
    tx, sets = _methods(spark, d)
    return rounded(E.compare_with_ground_truth(tx, sets), 6, *RATES)


@query
def best_method(spark, d):
    tx, sets = _methods(spark, d)
    return rounded(E.best_methods(E.compare_with_ground_truth(tx, sets)), 6, "value")


@query
def detection_metrics(spark, d):
    """Scored transactions against the labels."""
    tx = transactions(spark, d)
    found = {"Scored": E.flagged_ids(D.score_transactions(tx))}
    return rounded(E.compare_with_ground_truth(tx, found), 6, *RATES)


@query
def pattern_detection_rate(spark, d):
    tx = transactions(spark, d)
    return rounded(E.pattern_detection_rate(tx, D.score_transactions(tx)), 6, "detection_rate")


@query
def method_comparison(spark, d):
    """Rules, forest, k-means and hybrid against the labels."""
    return rounded(D.compare_methods(transactions(spark, d)).metrics, 6, *RATES)


# --- reports and dashboard ----------------------------------------------------------


@query
def summary_report(spark, d):
    report = P.generate_summary_report(scored_view(spark, d), transactions(spark, d))
    report = rounded(report, 4, "avg_risk_score", "flag_rate")
    return cents(report, "total_volume", "flagged_volume")


@query
def run_summary(spark, d):
    report = P.run_summary(transactions(spark, d), scored_view(spark, d))
    return cents(rounded(report, 4, "average_score", "flag_rate"), "flagged_amount")


@query
def dataset_overview(spark, d):
    report = P.dataset_overview(transactions(spark, d), scored_view(spark, d))
    return cents(rounded(report, 4, "alert_rate"), "total_volume")


@query
def high_risk_alerts(spark, d):
    return _scored(P.high_risk_alerts(scored_view(spark, d)))


@query
def top_users_report(spark, d):
    users = P.top_risky_users(scored_view(spark, d))
    return cents(rounded(users, 4, "avg_risk_score"), "total_amount")


@query
def rule_effectiveness(spark, d):
    return P.rule_effectiveness(scored_view(spark, d))


@query
def compliance_levels(spark, d):
    parts = P.compliance_report(scored_view(spark, d), transactions(spark, d))
    return rounded(parts["risk_levels"], 4, "percentage")


@query
def compliance_top(spark, d):
    parts = P.compliance_report(scored_view(spark, d), transactions(spark, d))
    return _scored(parts["top_transactions"])


@query
def level_counts(spark, d):
    return P.level_counts(scored_view(spark, d))


@query
def score_histogram(spark, d):
    bins = P.score_histogram(scored_view(spark, d))
    return rounded(bins, 4, "bin_start", "bin_end", "mean_score")


BOX = ["q1", "median", "q3"]


@query
def amount_boxplot(spark, d):
    return rounded(P.amount_boxplot(scored_view(spark, d)), 4, *BOX)


@query
def amount_boxplot_split(spark, d):
    return rounded(P.amount_boxplot(scored_view(spark, d), accuracy=COARSE), 4, *BOX)


@query
def alert_filter(spark, d):
    return P.filter_alerts(scored_view(spark, d), ["HIGH", "CRITICAL"], 75, "^c1")


@query
def transaction_preview(spark, d):
    return P.preview(transactions(spark, d))


@query
def alert_lookup(spark, d):
    return _scored(P.lookup(scored_view(spark, d), "O1"))


@query
def alert_timeline(spark, d):
    return P.alert_timeline(scored_view(spark, d))


@query
def dashboard_top_users(spark, d):
    users = P.dashboard_top_users(scored_view(spark, d))
    return cents(rounded(users, 4, "avg_risk_score"), "total_amount")


@query
def pattern_counts(spark, d):
    return P.pattern_counts(transactions(spark, d))


@query
def suspicious_rate(spark, d):
    return rounded(P.suspicious_rate(transactions(spark, d)), 4, "suspicious_percent")


DESCRIBED = ["mean", "std", "p25", "p50", "p75"]


@query
def amount_describe(spark, d):
    return rounded(P.describe_amount(transactions(spark, d)), 4, *DESCRIBED)


@query
def amount_describe_split(spark, d):
    return rounded(P.describe_amount(transactions(spark, d), accuracy=COARSE), 4, *DESCRIBED)


# --- sources and sinks ----------------------------------------------------------------


@query
def load_stats(spark, d):
    stats = IO.load_stats(transactions(spark, d))
    return cents(rounded(stats, 4, "labelled_percent"), "total_volume")


@query
def csv_round_trip(spark, d):
    """Transactions with their calendar columns, written as CSV and read back."""
    path = settings.scratch_path(spark, "transactions")
    IO.write_csv(IO.with_calendar(transactions(spark, d)), path)
    return IO.load_transactions(spark, path)


@query
def alert_csv_export(spark, d):
    path = settings.scratch_path(spark, "alert-export")
    exports.create_alert_csv(scored_view(spark, d), path)
    return IO.normalise(IO.read_csv(spark, path)).withColumn(
        "final_risk_score", F.col("final_risk_score").cast("int")
    )


@query
def report_suite_users(spark, d):
    """The users sheet of the report suite, read back."""
    path = settings.scratch_path(spark, "reports")
    suite = exports.generate_all_reports(
        scored_view(spark, d), transactions(spark, d), path, stamp="run"
    )
    users = spark.read.parquet(f"{suite['sheets']}/top_risky_users")
    return cents(rounded(users, 4, "avg_risk_score"), "total_amount")


# --- streaming ------------------------------------------------------------------------


def _run_stream(spark: SparkSession, d: str, rule: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run the rule over the tables as file streams until they are consumed."""
    stream = transactions(spark, d, streaming=True)
    out = settings.scratch_path(spark, "stream")
    running = (
        rule(stream)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{out}/rows")
    )
    running.awaitTermination()
    return spark.read.parquet(f"{out}/rows").select(*FLAG_COLUMNS)


@query
def stream_high_value(spark, d):
    return _run_stream(spark, d, high_value_stream)


@query
def stream_velocity(spark, d):
    return _run_stream(spark, d, velocity_stream)


@query
def stream_alert_sink(spark, d):
    """Streamed rule hits merged into an alert table, then the table."""
    path = settings.scratch_path(spark, "streamed-alerts")
    store = AlertStore(spark, f"{path}/table")
    flags = high_value_stream(transactions(spark, d, streaming=True))
    write_alerts(flags, store, f"{path}/checkpoint", created_at=FIRST_LOAD).awaitTermination()
    return store.read()


@query
def stream_alert_sink_two_rules(spark, d):
    """Two streamed rules, in several micro-batches, merged into one alert table."""
    path = settings.scratch_path(spark, "streamed-alerts")
    tx = transactions(spark, d)
    # Parts in time order: the velocity rule follows time.
    cuts = exact_quantiles(
        tx.select(F.unix_seconds(F.col("timestamp").cast("timestamp")).alias("t")), "t", [0.3, 0.6]
    ).first()["quantiles"]
    seconds = F.unix_seconds(F.col("timestamp").cast("timestamp"))
    part = sum((F.when(seconds > c, 1).otherwise(0) for c in cuts), F.lit(0))
    store = AlertStore(spark, f"{path}/table")
    # The files of a part are a micro-batch of both rules.
    for i in range(len(cuts) + 1):
        tx.filter(part == i).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(tx.schema).parquet(f"{path}/in")
        for rule in (high_value_stream, velocity_stream):
            checkpoint = f"{path}/{rule.__name__}"
            write_alerts(rule(stream), store, checkpoint, created_at=FIRST_LOAD).awaitTermination()
    return store.read().select("transaction_id", "rules_triggered", "risk_score", "risk_level")


def _sheet(name: str, finish: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    def read_back(spark, d):
        path = settings.scratch_path(spark, "reports")
        suite = exports.generate_all_reports(
            scored_view(spark, d), transactions(spark, d), path, stamp="run"
        )
        return finish(spark.read.parquet(f"{suite['sheets']}/{name}"))

    read_back.__name__ = f"report_suite_{name}"
    read_back.__doc__ = f"The table {name} of the report suite, read back."
    query(read_back)


_sheet("all_alerts", _scored)
_sheet("high_risk_alerts", _scored)
_sheet("rule_effectiveness")
_sheet(
    "summary",
    lambda df: cents(rounded(df, 4, "avg_risk_score", "flag_rate"), "total_volume", "flagged_volume"),
)
