"""Compare detection methods with each other and with labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the methods.
RULES = "Rules-Based"
FOREST = "Isolation Forest"
KMEANS = "K-Means Clustering"
HYBRID = "Hybrid (Rules + ML)"

# Fixed value: F1 above which a single method is recommended.
GOOD_F1 = 0.7

METRICS = ["precision", "recall", "f1_score"]


def flagged_ids(flags: DataFrame, condition: Column | None = None) -> DataFrame:
    """Distinct ids of flagged rows."""
    rows = flags if condition is None else flags.filter(condition)
    return rows.select("transaction_id").filter(F.col("transaction_id").isNotNull()).distinct()


def rules_based_ids(flags: DataFrame) -> DataFrame:
    return flagged_ids(flags)


def isolation_forest_ids(predictions: DataFrame) -> DataFrame:
    return flagged_ids(predictions, F.col("ml_prediction") == -1)


def kmeans_ids(outliers: DataFrame) -> DataFrame:
    return flagged_ids(outliers, F.col("is_outlier"))


def hybrid_ids(rules: DataFrame, ml: DataFrame) -> DataFrame:
    """Flagged by either."""
    return rules.select("transaction_id").unionByName(ml.select("transaction_id")).distinct()


def intersection_ids(rules: DataFrame, ml: DataFrame) -> DataFrame:
    """Flagged by both: the high-confidence set."""
    return rules.select("transaction_id").intersect(ml.select("transaction_id"))


def _memberships(sets: dict[str, DataFrame]) -> DataFrame:
    """One row per id with a boolean per set; a single shuffle for all sets."""
    tagged = [
        ids.select("transaction_id", *[F.lit(other == name).alias(other) for other in sets])
        for name, ids in sets.items()
    ]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("transaction_id")
        .agg(*[F.bool_or(name).alias(name) for name in sets])
    )


def hybrid_overlap(rules: DataFrame, ml: DataFrame) -> DataFrame:
    """Sizes of both, only-one and union sets."""
    both = F.col("rules") & F.col("ml")
    return _memberships({"rules": rules, "ml": ml}).agg(
        F.count_if(F.col("rules") & ~F.col("ml")).alias("rules_only"),
        F.count_if(F.col("ml") & ~F.col("rules")).alias("ml_only"),
        F.count_if(both).alias("both"),
        F.count(F.lit(1)).alias("total_flagged"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def compare_with_ground_truth(tx: DataFrame, methods: dict[str, DataFrame]) -> DataFrame | None:
    """Confusion counts and metrics per method, in the order given.

    The sets are compared by id, while true negatives count rows.  ``None``
    without an ``is_suspicious`` column.
    """
    if "is_suspicious" not in tx.columns:
        return None
    names = {name: f"m{i}" for i, name in enumerate(methods)}
    truth = tx.select(
        "transaction_id",
        F.coalesce("is_suspicious", F.lit(False)).alias("truth"),
        *[F.lit(False).alias(c) for c in names.values()],
        F.lit(1).alias("rows"),
    )
    tagged = [
        ids.select(
            "transaction_id",
            F.lit(False).alias("truth"),
            *[F.lit(other == name).alias(c) for other, c in names.items()],
            F.lit(0).alias("rows"),
        )
        for name, ids in methods.items()
    ]
    per_id = (
        reduce(DataFrame.unionByName, tagged, truth)
        .groupBy("transaction_id")
        .agg(
            F.bool_or("truth").alias("truth"),
            *[F.bool_or(c).alias(c) for c in names.values()],
            F.sum("rows").alias("rows"),
        )
    )
    counts = [F.sum("rows").alias("n")]
    for c in names.values():
        counts += [
            F.count_if(F.col(c) & F.col("truth")).alias(f"{c}_tp"),
            F.count_if(F.col(c) & ~F.col("truth")).alias(f"{c}_fp"),
            F.count_if(~F.col(c) & F.col("truth")).alias(f"{c}_fn"),
        ]
    table = F.array(
        *[
            F.struct(
                F.lit(i).alias("method_order"),
                F.lit(name).alias("method"),
                F.col(f"{c}_tp").alias("true_positives"),
                F.col(f"{c}_fp").alias("false_positives"),
                F.col(f"{c}_fn").alias("false_negatives"),
                F.col("n"),
            )
            for i, (name, c) in enumerate(names.items())
        ]
    )
    tp, fp, fn, tn = (
        F.col(c)
        for c in ("true_positives", "false_positives", "false_negatives", "true_negatives")
    )
    precision, recall = F.col("precision"), F.col("recall")
    return (
        per_id.agg(*counts)
        .select(F.inline(table))
        .withColumn("flagged", tp + fp)
        .withColumn("true_negatives", F.col("n") - tp - fp - fn)
        .withColumn("precision", _ratio(tp, tp + fp))
        .withColumn("recall", _ratio(tp, tp + fn))
        .withColumn("f1_score", _ratio(2 * precision * recall, precision + recall))
        .withColumn("accuracy", _ratio(tp + tn, F.col("n")))
        .withColumn("efficiency", _ratio(tp, F.col("flagged")))
        .drop("n")
    )


def pattern_detection_rate(tx: DataFrame, detected: DataFrame) -> DataFrame | None:
    """Detected share of each labelled pattern, by distinct id."""
    if not {"is_suspicious", "suspicious_pattern"} <= set(tx.columns):
        return None
    labelled = (
        tx.filter(F.col("is_suspicious") & F.col("suspicious_pattern").isNotNull())
        .select("transaction_id", "suspicious_pattern")
        .distinct()
    )
    found = flagged_ids(detected).withColumn("found", F.lit(True))
    return (
        labelled.join(found, "transaction_id", "left")
        .groupBy("suspicious_pattern")
        .agg(F.count("found").alias("detected"), F.count(F.lit(1)).alias("total"))
        .withColumn("detection_rate", _ratio(F.col("detected"), F.col("total")))
    )


def best_methods(comparison: DataFrame) -> DataFrame:
    """The first best method per metric, and what that suggests."""
    best = [
        F.max_by(F.struct("method", m), F.struct(m, -F.col("method_order"))).alias(m)
        for m in METRICS
    ]
    advice = (
        F.when(F.col("f1_score.method") == HYBRID, "hybrid")
        .when(F.col("f1_score.f1_score") > GOOD_F1, "single_method")
        .otherwise("tune")
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(f"{m}.method").alias("method"),
                F.col(f"{m}.{m}").alias("value"),
            )
            for m in METRICS
        ]
    )
    return (
        comparison.agg(*best)
        .withColumn("recommendation", advice)
        .select(F.explode(rows).alias("b"), "recommendation")
        .select("b.*", "recommendation")
    )
