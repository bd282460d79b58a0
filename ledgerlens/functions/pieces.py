"""Split ordered rows of heavy keys into contiguous pieces.

A window over a heavy key would put all its rows into one task.  Here the rows
are range partitioned by key and order, a piece is one such partition, and
windows run per (key, piece).  Rows that a trailing window must look back at
are carried over the border in front of a piece ("lead-in" rows).  Nothing of
this passes the driver, and the number of pieces grows with the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.settings import materialised

PIECE = "_piece"
LEAD_IN = "_lead_in"


def with_piece(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], pieces: int
) -> DataFrame:
    """Write the rows with the number of their piece, of about equal sizes.

    Where the partitioner cuts affects balance and never results.
    """
    ranged = df.repartitionByRange(max(1, pieces), *keys, *order)
    return materialised(ranged.withColumn(PIECE, F.spark_partition_id()), "pieces")


def _borders(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """Pieces of a key whose last rows a later piece needs: ``_to``, and how many rows lie ``_between``.

    A piece needs the one before it; it also needs earlier ones if all those in
    between are so small that they do not fill its window.  There is one row
    per key and piece, and a round per piece further back.
    """
    sizes = materialised(df.groupBy(*keys, PIECE).agg(F.count(F.lit(1)).alias("_size")), "piece-sizes")
    start = sizes.select(*keys, PIECE, F.col(PIECE).alias("_at"), F.lit(0).cast("long").alias("_between"))
    following = sizes.select(*keys, (F.col(PIECE) - 1).alias("_at"), "_size")
    found = []
    while True:
        found.append(materialised(start.join(following, [*keys, "_at"]), "piece-borders"))
        start = found[-1].select(
            *keys, PIECE, (F.col("_at") + 1).alias("_at"), (F.col("_between") + F.col("_size")).alias("_between")
        ).filter(F.col("_between") < rows)
        if start.isEmpty():
            return reduce(DataFrame.unionByName, found).select(
                *keys, PIECE, (F.col("_at") + 1).alias("_to"), "_between"
            )


def with_lead_in(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int
) -> DataFrame:
    """Copy the ``rows`` rows before each piece of a key into it, marked ``_lead_in``.

    Only the last ``rows`` rows of every piece can be needed by a later one;
    the group limit trims them map-side.
    """
    latest = Window.partitionBy(*keys, PIECE).orderBy(*[F.desc(c) for c in order])
    tails = df.withColumn("_from_end", F.row_number().over(latest)).filter(F.col("_from_end") <= rows)
    copies = (
        tails.join(_borders(df, keys, rows), [*keys, PIECE])
        .filter(F.col("_from_end") <= rows - F.col("_between"))
        .withColumn(PIECE, F.col("_to"))
        .select(*df.columns)
    )
    return df.withColumn(LEAD_IN, F.lit(False)).unionByName(
        copies.withColumn(LEAD_IN, F.lit(True))
    )
