"""End-to-end detection and method comparison."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from ledgerlens.functions.hot_keys import HotKeys, find_hot_keys
from ledgerlens.operators import evaluation as E
from ledgerlens.operators import models as M
from ledgerlens.operators import reports as P
from ledgerlens.operators import scoring as S
from ledgerlens.operators.features import FEATURE_COLUMNS, prepare_for_ml
from ledgerlens.operators.rules import RuleSettings, all_flags, wide_flags
from ledgerlens.settings import materialised
from ledgerlens.sources.alert_store import AlertStore


def score_transactions(
    tx: DataFrame,
    settings: RuleSettings | None = None,
    hot: HotKeys | None = None,
    weights: dict[str, float] | None = None,
    levels: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Rules, weights, scores and levels: one shuffle by user for the rules
    and one by transaction for the scores."""
    return S.score_flags(wide_flags(tx, settings, hot), weights, levels)


def run_detection(
    tx: DataFrame,
    use_ml: bool = False,
    settings: RuleSettings | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Scored transactions; with ``use_ml`` also whether the isolation forest
    found them unusual (``ml_flagged``), however few there are."""
    hot = find_hot_keys(tx) if hot is None else hot
    scored = score_transactions(tx, settings, hot)
    if not use_ml:
        return scored
    return M.with_ml_flag(scored, forest_predictions(scaled_matrix(tx, hot)))


def scaled_matrix(tx: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Scaled features, written once: fitting and scoring read them repeatedly
    and the windows behind them should run once."""
    matrix = materialised(prepare_for_ml(tx, hot))
    return M.fit_scaler(matrix, FEATURE_COLUMNS).transform(matrix)


def forest_predictions(matrix: DataFrame, contamination: float = M.CONTAMINATION) -> DataFrame:
    model, scores = M.fit_isolation_forest(matrix, FEATURE_COLUMNS, contamination)
    return model.label(scores)


def kmeans_outliers(
    matrix: DataFrame,
    n_clusters: int = M.CLUSTERS,
    percentile: float = M.OUTLIER_PERCENTILE,
    restarts: int = M.RESTARTS,
) -> DataFrame:
    model = M.fit_kmeans(matrix, FEATURE_COLUMNS, n_clusters, restarts=restarts)
    return M.predict_kmeans_outliers(model, matrix, FEATURE_COLUMNS, percentile)


@dataclass(frozen=True)
class DetectionRun:
    """What one run found, stored and measured."""

    scored: DataFrame
    stored: int
    top_transactions: DataFrame
    high_risk_users: DataFrame
    rule_effectiveness: DataFrame
    metrics: DataFrame | None
    patterns: DataFrame | None
    summary: DataFrame


def detect_and_store(
    tx: DataFrame,
    store: AlertStore,
    created_at: datetime | None = None,
    hot: HotKeys | None = None,
) -> DetectionRun:
    """Rules, scores, alert table, analysis and, if labelled, evaluation.

    The scored transactions are written once; the store and every part of the
    analysis read them, and every part is computed and written by this run.
    """
    scored = materialised(score_transactions(tx, hot=hot), "scored")
    stored = store.store_alerts(scored, overwrite=True, created_at=created_at)
    found = {"Scored": E.flagged_ids(scored)}

    def part(name: str, df: DataFrame | None) -> DataFrame | None:
        return None if df is None else materialised(df, name)

    return DetectionRun(
        scored,
        stored,
        part("top", S.get_top_risky_transactions(scored, 10)),
        part("users", S.get_high_risk_users(scored)),
        part("rules", P.rule_effectiveness(scored)),
        part("metrics", E.compare_with_ground_truth(tx, found)),
        part("patterns", E.pattern_detection_rate(tx, scored)),
        part("summary", P.run_summary(tx, scored)),
    )


@dataclass(frozen=True)
class MethodComparison:
    """Flagged ids per method and what follows from them."""

    ids: dict[str, DataFrame]
    overlap: DataFrame
    metrics: DataFrame | None
    best: DataFrame | None


def evaluate_rules_based(tx: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Ids any rule flags."""
    return E.rules_based_ids(all_flags(tx, hot=hot))


def evaluate_isolation_forest(
    matrix: DataFrame, contamination: float = M.CONTAMINATION
) -> DataFrame:
    """Ids the forest finds unusual in a ``scaled_matrix``."""
    return E.isolation_forest_ids(forest_predictions(matrix, contamination))


def evaluate_kmeans(
    matrix: DataFrame,
    n_clusters: int = M.CLUSTERS,
    percentile: float = M.OUTLIER_PERCENTILE,
) -> DataFrame:
    """Ids far from their cluster in a ``scaled_matrix``."""
    return E.kmeans_ids(kmeans_outliers(matrix, n_clusters, percentile))


def compare_methods(
    tx: DataFrame,
    contamination: float = M.CONTAMINATION,
    n_clusters: int = M.CLUSTERS,
    percentile: float = M.OUTLIER_PERCENTILE,
    hot: HotKeys | None = None,
) -> MethodComparison:
    """Rules, forest, k-means and hybrid against the labels."""
    hot = find_hot_keys(tx) if hot is None else hot
    matrix = scaled_matrix(tx, hot)
    # Narrow, and each feeds several results.
    rules = materialised(evaluate_rules_based(tx, hot), "rules-ids")
    forest = materialised(evaluate_isolation_forest(matrix, contamination), "forest-ids")
    clusters = materialised(evaluate_kmeans(matrix, n_clusters, percentile), "kmeans-ids")
    ids = {
        E.RULES: rules,
        E.FOREST: forest,
        E.KMEANS: clusters,
        E.HYBRID: E.hybrid_ids(rules, forest),
    }
    metrics = E.compare_with_ground_truth(tx, ids)
    return MethodComparison(
        ids,
        E.hybrid_overlap(rules, forest),
        metrics,
        None if metrics is None else E.best_methods(metrics),
    )


def top_risky(tx: DataFrame, n: int = 10) -> DataFrame:
    """The flagship query: the riskiest transactions."""
    return S.get_top_risky_transactions(score_transactions(tx), n)
