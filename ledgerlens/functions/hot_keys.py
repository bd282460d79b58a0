"""Keys too heavy for one task, and how rows are divided around them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import settings


@dataclass(frozen=True)
class HotKeys:
    """The keys with more than ``limit`` rows, as a written table of keys.

    The table never passes the driver, and joins with it carry no hint: it is
    broadcast while its size allows, and shuffled beyond that.
    """

    key: str
    limit: int
    keys: DataFrame | None = None
    #: Rows of all these keys together.
    rows: int = 0
    #: Rows aimed at per piece when these keys are split in order.
    piece_rows: int = 1

    def __bool__(self) -> bool:
        return self.keys is not None


def find_hot_keys(
    df: DataFrame, key: str = "user_id", limit: int | None = None, piece_rows: int | None = None
) -> HotKeys:
    """Count rows per key (combined map-side) and keep the heavy ones."""
    limit = limit or settings.hot_key_rows(df.sparkSession)
    heavy = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > limit)
    )
    rows = heavy.agg(F.sum("n")).first()[0]
    if not rows:
        return HotKeys(key, limit)
    table = settings.materialised(heavy.select(key), "hot-keys")
    return HotKeys(key, limit, table, rows, piece_rows or max(limit // settings.PIECES_PER_LIMIT, 1))


def without_hot(df: DataFrame, hot: HotKeys) -> DataFrame:
    if not hot:
        return df
    return df.join(hot.keys, hot.key, "left_anti")


#: Number given to each written row of a hot key; tells copies apart.
ROW = "_row"


def only_hot(df: DataFrame, hot: HotKeys) -> DataFrame:
    """The hot keys' rows with a fixed row number, written once.

    The routes for hot keys read them several times and should not scan the
    whole input for each.  The number lets even identical rows be split.
    """
    rows = df.join(hot.keys, hot.key, "left_semi")
    return settings.materialised(rows.withColumn(ROW, F.monotonically_increasing_id()), "hot-rows")


def by_weight(
    df: DataFrame,
    hot: HotKeys,
    light: Callable[[DataFrame], DataFrame],
    heavy: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Apply ``light`` to ordinary keys and ``heavy`` to hot ones, then union.

    Without hot keys only the ``light`` branch is planned.
    """
    result = light(without_hot(df, hot))
    if not hot:
        return result
    return result.unionByName(heavy(only_hot(df, hot).drop(ROW)))
