"""Consecutive row numbers without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.settings import materialised

# monotonically_increasing_id keeps the partition above bit 33 and the
# position inside the partition below it.
_POSITION_BITS = 33


def number_rows(df: DataFrame, order: list[str], name: str, start: int = 1) -> DataFrame:
    """Number rows ``start, start+1, ...`` in ``order``.

    One range shuffle sorts the rows; writing them fixes where each row sits,
    so the per-partition offsets stay valid if a task is run again.  The rows
    are written before it too: a range shuffle reads its input twice, the first
    time for its borders.
    """
    placed = materialised(
        materialised(df, "to-number").repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", _POSITION_BITS))
        .withColumn("_pos", F.col("_place") - F.shiftleft("_part", _POSITION_BITS))
    )
    # One row per partition of the shuffle.
    sizes = placed.groupBy("_part").agg((F.max("_pos") + 1).alias("n")).orderBy("_part").collect()
    offsets, total = [], start
    for row in sizes:
        offsets.append((row["_part"], total))
        total += row["n"]
    first = df.sparkSession.createDataFrame(offsets, "_part long, _first long")
    return (
        placed.join(F.broadcast(first), "_part")
        .withColumn(name, F.col("_first") + F.col("_pos"))
        .drop("_place", "_part", "_pos", "_first")
    )
