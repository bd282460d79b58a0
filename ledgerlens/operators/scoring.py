"""Weighted scores per transaction and the summaries built on them."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.rules import HIGH_VALUE, RULE_ORDER, widen
from ledgerlens.sources.transactions import OPTIONAL

# Rule weights, level ranges (both ends inclusive) and the cap.
RULE_WEIGHTS = {
    "HIGH_VALUE": 1.0,
    "VELOCITY": 1.2,
    "STRUCTURING": 1.5,
    "DORMANT_REACTIVATION": 1.1,
    "ROUND_NUMBERS": 0.9,
}
RISK_LEVELS = {
    "LOW": (0, 30),
    "MEDIUM": (31, 60),
    "HIGH": (61, 90),
    "CRITICAL": (91, float("inf")),
}
FALLBACK_LEVEL = "CRITICAL"
SCORE_CAP = 150

PAYLOAD = ["user_id", "amount", "timestamp", "transaction_type"]


def rule_weight(rule: Column, weights: dict[str, float] | None = None) -> Column:
    """The rule's weight, 1.0 for a rule not listed."""
    pairs = (weights or RULE_WEIGHTS).items()
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs)])
    return F.coalesce(F.try_element_at(table, rule), F.lit(1.0))


def risk_level(
    score: Column, levels: dict[str, tuple[float, float]] | None = None
) -> Column:
    """First level whose range holds the score; CRITICAL where none does."""
    result = None
    for name, (low, high) in (levels or RISK_LEVELS).items():
        hit = score.between(F.lit(low), F.lit(high))
        result = F.when(hit, name) if result is None else result.when(hit, name)
    return result.otherwise(FALLBACK_LEVEL)


def with_weighted_score(flags: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    weight = rule_weight(F.col("rule_triggered"), weights)
    return flags.withColumn("weighted_score", F.col("risk_score") * weight)


def combine_rule_results(
    results: dict[str, DataFrame], weights: dict[str, float] | None = None
) -> DataFrame:
    """Union of all rule results with ``weighted_score``."""
    union = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), results.values()
    )
    return with_weighted_score(union, weights)


def combine_totals(combined: DataFrame) -> DataFrame:
    return combined.agg(
        F.count(F.lit(1)).alias("flag_records"),
        F.count_distinct("transaction_id").alias("unique_transactions"),
    )


def _rule_rank(rule: Column) -> Column:
    return F.array_position(F.array(*[F.lit(r) for r in RULE_ORDER]), rule)


def _firsts(columns: list[str], order: Column) -> list[Column]:
    """First non-null value of each column in the given order."""
    return [F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns]


def _finish(
    grouped: DataFrame, extra: list[str], levels: dict[str, tuple[float, float]] | None
) -> DataFrame:
    """From rule list and score sums to the scored layout."""
    final = F.least(F.bround("weighted_score", 0).cast("int"), F.lit(SCORE_CAP))
    return (
        grouped.withColumn("final_risk_score", final)
        .withColumn("rules_triggered_count", F.size("rules"))
        .withColumn("rule_triggered", F.array_join("rules", ", "))
        .withColumn("risk_level", risk_level(F.col("final_risk_score"), levels))
        .select(
            "transaction_id", *PAYLOAD, "rule_triggered",
            F.col("risk_score").cast("int").alias("risk_score"), "weighted_score",
            *extra, "final_risk_score", "rules_triggered_count", "risk_level",
        )
    )


def calculate_cumulative_scores(
    combined: DataFrame, levels: dict[str, tuple[float, float]] | None = None
) -> DataFrame:
    """One row per transaction with the sum of its weighted scores.

    The rule set holds at most one entry per rule, so every buffer is small
    and copies of an id combine before the shuffle.
    """
    extra = [c for c in OPTIONAL if c in combined.columns]
    grouped = combined.groupBy("transaction_id").agg(
        *_firsts(PAYLOAD + extra, F.struct(_rule_rank(F.col("rule_triggered")), "timestamp", "user_id", "amount", "transaction_type")),
        F.array_sort(F.collect_set("rule_triggered")).alias("rules"),
        F.sum("risk_score").alias("risk_score"),
        F.sum("weighted_score").alias("weighted_score"),
    )
    return _finish(grouped, extra, levels)


def score_flags(
    flags: DataFrame,
    weights: dict[str, float] | None = None,
    levels: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Score flags straight from the rules, wide or long.

    Same result as de-duplicating, weighting and scoring in turn, in one
    ``transaction_id`` shuffle of one row per flagged transaction.
    """
    wide = flags if HIGH_VALUE in flags.columns else widen(flags)
    weights = {**RULE_WEIGHTS, **(weights or {})}
    extra = [c for c in OPTIONAL if c in wide.columns]
    first_rule = F.coalesce(
        *[F.when(F.col(r).isNotNull(), i) for i, r in enumerate(RULE_ORDER)]
    )
    # The order holds the payload, so of rows without nulls one entry does for all of it.
    order = F.struct(first_rule.alias("first_rule"), "timestamp", "user_id", "amount", "transaction_type")
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in PAYLOAD])
    payload = [F.min(F.when(whole, order)).alias("_whole")] + [
        F.min(F.when(~whole & F.col(c).isNotNull(), order)).alias(f"_{c}") for c in PAYLOAD
    ]
    # The amount rule keeps repeats of an id, the others their first row.
    seen = F.struct("user_id", "timestamp", "amount", "transaction_type")
    per_rule = [F.sum(HIGH_VALUE).alias(HIGH_VALUE)] + [
        F.min_by(r, F.when(F.col(r).isNotNull(), seen)).alias(r)
        for r in RULE_ORDER
        if r != HIGH_VALUE
    ]
    grouped = wide.groupBy("transaction_id").agg(*payload, *_firsts(extra, order), *per_rule)
    grouped = grouped.withColumns({c: F.least("_whole", f"_{c}")[c] for c in PAYLOAD})

    def total(term):
        return reduce(
            lambda a, b: a + b, [F.coalesce(term(r), F.lit(0)) for r in RULE_ORDER]
        )

    hit_rules = F.array_compact(
        F.array(*[F.when(F.col(r).isNotNull(), r) for r in sorted(RULE_ORDER)])
    )
    summed = grouped.withColumns(
        {
            "rules": hit_rules,
            "risk_score": total(F.col),
            "weighted_score": total(lambda r: F.col(r) * F.lit(float(weights.get(r, 1.0)))),
        }
    )
    return _finish(summed, extra, levels)


# --- summaries ----------------------------------------------------------------


def get_risk_distribution(
    scored: DataFrame, levels: list[str] | None = None
) -> DataFrame:
    """Count per level, zero where a level is absent."""
    names = levels or list(RISK_LEVELS)
    counts = scored.agg(*[F.count_if(F.col("risk_level") == n).alias(n) for n in names])
    pairs = F.array(
        *[F.struct(F.lit(n).alias("risk_level"), F.col(n).alias("count")) for n in names]
    )
    return counts.select(F.inline(pairs))


def get_top_risky_transactions(scored: DataFrame, n: int = 10) -> DataFrame:
    return scored.orderBy(F.desc("final_risk_score"), "transaction_id").limit(n)


def get_high_risk_users(scored: DataFrame, threshold: str = "HIGH") -> DataFrame:
    """Profile of users with at least one transaction at or above the level."""
    wanted = {"HIGH": ["HIGH", "CRITICAL"], "CRITICAL": ["CRITICAL"]}.get(threshold)
    rows = scored.filter(F.col("risk_level").isin(wanted)) if wanted else scored
    return (
        rows.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.count("transaction_id").alias("flagged_transaction_count"),
            F.avg("final_risk_score").alias("avg_risk_score"),
            F.max("final_risk_score").alias("max_risk_score"),
            F.sum("final_risk_score").alias("total_risk_score"),
            F.sum("amount").alias("total_amount"),
            F.mode("risk_level", True).alias("primary_risk_level"),
        )
        .orderBy(F.desc("total_risk_score"), "user_id")
    )


def generate_risk_report(scored: DataFrame) -> DataFrame:
    """One row of totals; zeros when nothing was flagged.

    The median is exact: scores are capped integers, so its buffer holds few
    distinct values.
    """
    zero = F.lit(0)
    return scored.agg(
        F.count(F.lit(1)).alias("total_flagged"),
        F.coalesce(F.avg("final_risk_score"), zero).alias("average_score"),
        F.coalesce(F.median("final_risk_score"), zero).alias("median_score"),
        F.coalesce(F.max("final_risk_score"), zero).alias("max_score"),
        F.count_distinct("user_id").alias("users_flagged"),
        F.coalesce(F.sum("amount"), zero).alias("total_flagged_amount"),
    )


def rule_combinations(scored: DataFrame, n: int | None = None) -> DataFrame:
    """Transactions per combination of rules, most frequent first."""
    counts = (
        scored.groupBy("rule_triggered")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "rule_triggered")
    )
    return counts.limit(n) if n else counts


def level_percentages(scored: DataFrame) -> DataFrame:
    """Each level's count and share of all flagged transactions, gravest first."""
    names = list(reversed(RISK_LEVELS))
    counts = scored.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(F.col("risk_level") == n).alias(n) for n in names],
    )
    share = lambda n: F.coalesce(F.try_divide(F.col(n) * 100.0, "_total"), F.lit(0.0))
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("risk_level"),
                F.col(n).alias("count"),
                share(n).alias("percentage"),
            )
            for n in names
        ]
    )
    return counts.select(F.inline(rows))
