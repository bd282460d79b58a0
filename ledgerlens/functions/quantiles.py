"""Exact quantiles by iterated selection, without a large group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.settings import materialised

#: Ranks of the approximate quantiles are off by one in this number at most.
ACCURACY = 100_000
#: A bracket reaches this many such errors to either side of the wanted rank.
REACH = 20
#: Distinct values of a bracket that one task sorts at most; more are narrowed down first.
SORTED = 50_000
#: Slices that a round of narrowing cuts a bracket's values into.
SLICES = 1_024

_BRACKET = ["i", "at", "low", "high", "least", "most"]


def _same(keys: Sequence[str]) -> Column:
    """Equality of keys with their renamed copies; null equals null."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    return left.join(renamed, _same(keys), how).drop(*[f"_{k}" for k in keys])


def _counts(data: DataFrame, keys: list[str], brackets: DataFrame | list) -> DataFrame:
    """Rows per distinct value inside each bracket, and below it (value NULL).

    ``brackets`` are rows per key, or a short list if there is no key.
    """
    if keys:
        placed = _joined(data, brackets, keys)
    else:
        literal = F.array(
            *[F.struct(*[F.lit(b[c]).alias(c) for c in _BRACKET]) for b in brackets]
        )
        placed = data.select("value", F.inline(literal))
    inside = F.when(F.col("value") >= F.col("low"), F.col("value"))
    return (
        placed.filter(F.col("value") <= F.col("high"))
        .groupBy(*keys, *_BRACKET, inside.alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _missed(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Brackets that do not hold their ranks, widened on the side where these lie."""
    below = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
    under, over = F.floor("at") < F.col("below"), F.ceil("at") >= F.col("total")
    return (
        counted.groupBy(*keys, *_BRACKET)
        .agg(below.alias("below"), F.sum("n").alias("total"))
        .filter(under | over)
        .withColumns(
            {
                "low": F.when(under, F.col("least")).otherwise(F.col("low")),
                "high": F.when(over, F.col("most")).otherwise(F.col("high")),
            }
        )
        .select(*keys, *_BRACKET)
    )


def _slice(cuts: Column, value: Column) -> Column:
    """Number of cuts below ``value``, by halving."""
    halves = [1 << bit for bit in range(SLICES.bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.array(*[F.lit(h) for h in halves]),
        F.lit(0),
        lambda low, h: F.when(F.get(cuts, low + h - 1) < value, low + h).otherwise(low),
    )


def _narrowed(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Keep the slices of each bracket that hold its ranks.

    Cuts lie evenly among the distinct values, so whatever their distribution a
    round leaves about two in ``SLICES`` of them.
    """
    group = [*keys, "i"]
    shares = [j / SLICES for j in range(1, SLICES)]
    cuts = counted.groupBy(*group).agg(
        F.percentile_approx("value", shares, 10 * SLICES).alias("cuts")
    )
    place = F.when(F.col("value").isNull(), -1).otherwise(_slice(F.col("cuts"), F.col("value")))
    placed = _joined(counted, cuts, group).withColumn("slice", place).drop("cuts")
    # At most SLICES + 1 rows per bracket.
    ordered = Window.partitionBy(*group).orderBy("slice")
    kept = (
        placed.groupBy(*group, "slice")
        .agg(F.sum("n").alias("m"), F.first("at").alias("rank"))
        .withColumn("to", F.sum("m").over(ordered))
        .withColumn("from", F.col("to") - F.col("m"))
        .filter((F.col("slice") >= 0) & (F.col("from") <= F.ceil("rank")) & (F.col("to") > F.floor("rank")))
        .select(*group, "slice", "from")
    )
    inside = _joined(placed, kept, [*group, "slice"])
    first = Window.partitionBy(*group).orderBy("from")
    below = _joined(
        counted.groupBy(*keys, *_BRACKET).agg(F.lit(None).cast("double").alias("value")),
        kept.withColumn("_nr", F.row_number().over(first)).filter("_nr = 1").drop("_nr", "slice"),
        group,
    ).withColumnRenamed("from", "n")
    return inside.select(counted.columns).unionByName(below.select(counted.columns))


def _values(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Interpolated values at the ranks of bounded brackets."""
    # Values below the bracket are one row, which sorts first.
    ordered = Window.partitionBy(*keys, "i").orderBy(F.col("value").asc_nulls_first())
    ranked = counted.withColumn("to", F.sum("n").over(ordered)).withColumn(
        "from", F.col("to") - F.col("n")
    )

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("from") <= rank) & (rank < F.col("to")), F.col("value")))

    return (
        ranked.groupBy(*keys, "i", "at")
        .agg(
            value_at(F.floor("at")).alias("low_value"),
            value_at(F.ceil("at")).alias("high_value"),
        )
        .withColumn("share", F.col("at") - F.floor("at"))
        .withColumn(
            "q",
            F.col("low_value") + (F.col("high_value") - F.col("low_value")) * F.col("share"),
        )
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("i", "q"))).alias("qs"))
        .select(*keys, F.col("qs.q").alias("quantiles"))
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = ACCURACY,
) -> DataFrame:
    """``by`` columns plus ``quantiles array<double>``, linearly interpolated.

    The first pass brackets every wanted rank between two approximate quantiles
    (between minimum and maximum in groups too small for these).  The second
    counts, combined map-side, what lies below a bracket and every distinct
    value inside it, a share of ``2 * REACH / accuracy`` of the group, and
    writes that table.  It tells whether the ranks do lie in their brackets; the
    others are widened and counted again.  Brackets of more than ``SORTED``
    values are narrowed, reading only the written table, so no task ever sorts
    more than that.  The jobs run when this is called.
    """
    keys = list(by)
    data = df.filter(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("value")
    )
    slack, few = REACH / accuracy, 2 * accuracy // max(REACH, 1)
    shares = [min(max(p + d, 0.0), 1.0) for p in probs for d in (-slack, slack)]
    # Grouping by a constant keeps an empty input without a row.
    stats = data.groupBy(*(keys or [F.lit(0).alias("_all")])).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
        F.percentile_approx("value", shares, accuracy).alias("near"),
    )

    def bracket(i: int, p: float) -> Column:
        whole = F.col("n") < few
        low = F.lit(True) if p - slack <= 0 else whole
        high = F.lit(True) if p + slack >= 1 else whole
        return F.struct(
            F.lit(i).alias("i"),
            (F.lit(float(p)) * (F.col("n") - 1)).alias("at"),
            F.when(low, F.col("least")).otherwise(F.col("near")[2 * i]).alias("low"),
            F.when(high, F.col("most")).otherwise(F.col("near")[2 * i + 1]).alias("high"),
            "least",
            "most",
        )

    brackets = stats.select(*keys, F.inline(F.array(*[bracket(i, p) for i, p in enumerate(probs)])))
    if not keys:
        brackets = brackets.collect()  # one per wanted quantile
        if not brackets:
            return df.sparkSession.createDataFrame([], "quantiles array<double>")
    counted = materialised(_counts(data, keys, brackets), "quantiles")
    missed = materialised(_missed(counted, keys), "quantiles")
    if not missed.isEmpty():
        again = _counts(data, keys, missed if keys else missed.collect())
        good = _joined(counted, missed.select(*keys, "i"), [*keys, "i"], "left_anti")
        counted = materialised(good.select(again.columns).unionByName(again), "quantiles")
    while not counted.groupBy(*keys, "i").count().filter(F.col("count") > SORTED + 1).isEmpty():
        counted = materialised(_narrowed(counted, keys), "quantiles")
    return _values(counted, keys)


def exact_quantile(
    df: DataFrame, value: str, prob: float, accuracy: int = ACCURACY
) -> float | None:
    """One global quantile, as a number on the driver."""
    row = exact_quantiles(df, value, [prob], accuracy=accuracy).first()
    return None if row is None or row["quantiles"] is None else row["quantiles"][0]
