"""Sharding along a Hilbert curve over several metadata dimensions.

Every dimension is quantised to equally filled cells, the cells' position on the
Hilbert curve is the sort key, and the sorted rows are cut into runs.  Rows close in
all dimensions end up close in a file, so minima and maxima prune on each of them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.numbering import number_rows
from ledgerlens.llm.common import small_batches

#: Bits per dimension: 64 cells each.
BITS = 6
#: Relative error of the cell limits is one in this number.
ACCURACY = 10_000


def hilbert_index(coordinates: list[np.ndarray], bits: int) -> np.ndarray:
    """Positions on the curve through a grid of ``2 ** bits`` cells per dimension.

    Vectorised form of Skilling's transform ("Programming the Hilbert curve", 2004).
    """
    x = [np.asarray(c, dtype=np.int64).copy() for c in coordinates]
    n = len(x)
    if n == 1:
        return x[0]
    level = 1 << (bits - 1)
    while level > 1:
        below = level - 1
        for i in range(n):
            high = (x[i] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(high, x[0] ^ below, x[0] ^ swap)
            x[i] = x[i] ^ swap
        level >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn = np.where((x[n - 1] & level) != 0, turn ^ (level - 1), turn)
        level >>= 1
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | (((x[i] ^ turn) >> bit) & 1)
    return index


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.StringType, T.BinaryType))


def ordinal(df: DataFrame, name: str) -> Column:
    """A value in the order of the column, null lowest; a string is its bytes behind one more."""
    kind = df.schema[name].dataType
    column = F.col(name)
    if is_text(df, name):
        return F.coalesce(F.concat(F.lit(b"\1"), column.cast("binary")), F.lit(b""))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        value = F.unix_micros(column.cast("timestamp"))
    elif isinstance(kind, T.BooleanType):
        value = column.cast("long")
    else:
        value = column.cast("double")
    return F.coalesce(value, F.lit(-(1 << 62)).cast(value_type(kind)))


def value_type(kind: T.DataType) -> str:
    longs = (T.TimestampType, T.TimestampNTZType, T.DateType, T.BooleanType)
    return "long" if isinstance(kind, longs) else "double"


def text_limits(df: DataFrame, values: list[Column], shares: list[float], total: int) -> list[np.ndarray]:
    """Cell limits of binary columns: distinct values are counted and sorted by range.

    A task names a value each time a share of ``1 / ACCURACY`` of the rows is passed, so the
    driver gets at most twice that many values per column, and some per task.
    """
    step = max(1, total // ACCURACY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = 0, None
        for batch in batches:
            dims, texts, counts = (c.to_pylist() for c in batch.columns)
            out = []
            for dim, value, n in zip(dims, texts, counts):
                # What is held goes to the value before, also where a column ends.
                if last is not None and (held >= step or held + n > step or last[0] != dim):
                    out.append((*last, held))
                    held = 0
                last, held = (dim, value), held + n
            yield made(out)
        if last is not None:
            yield made([(*last, held)])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["dim", "value", "n"])

    pairs = df.select(F.posexplode(F.array(*values)).alias("dim", "value"))
    counted = pairs.groupBy("dim", "value").agg(F.count("*").alias("n"))
    ordered = counted.repartitionByRange("dim", "value").sortWithinPartitions("dim", "value")
    points = sorted((r["dim"], bytes(r["value"]), r["n"]) for r in
                    ordered.mapInArrow(run, "dim int, value binary, n long").collect())
    limits = []
    for i in range(len(values)):
        own = [p for p in points if p[0] == i]
        reached = np.cumsum([p[2] for p in own])
        at = np.searchsorted(reached, [s * total for s in shares]) if own else []
        limits.append(np.array([own[min(k, len(own) - 1)][1] for k in at], dtype=object))
    return limits


def with_curve_index(df: DataFrame, dimensions: list[str], bits: int = BITS) -> DataFrame:
    """Adds ``curve``, the Hilbert index over the quantised dimensions.

    Cell limits are approximate quantiles of all rows; numbers need one pass for all, strings
    a sort of their distinct values.  A value that is very common fills several cells; a
    number takes the last of them, a string the first.
    """
    small_batches(df.sparkSession)
    cells = 1 << bits
    shares = [i / cells for i in range(1, cells)]
    values = [ordinal(df, d) for d in dimensions]
    text = [i for i, d in enumerate(dimensions) if is_text(df, d)]
    row = df.agg(
        F.count("*").alias("total"),
        *(F.percentile_approx(c, shares, ACCURACY).alias(f"q{i}") for i, c in enumerate(values) if i not in text)
    ).first()
    limits = {i: np.array(row[f"q{i}"] or [], dtype=float) for i in range(len(values)) if i not in text}
    if text:
        limits |= zip(text, text_limits(df, [values[i] for i in text], shares, row["total"]))

    def cell(i: int, column: pd.Series) -> np.ndarray:
        if i not in text:
            return np.searchsorted(limits[i], column.to_numpy(dtype=float), side="right")
        code, distinct = pd.factorize(column)
        return np.array([bisect_left(limits[i], v) for v in distinct], dtype=np.int64)[code]

    @F.pandas_udf("long")
    def curve(columns: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index([cell(i, columns.iloc[:, i]) for i in range(columns.shape[1])], bits))

    packed = F.struct(*(c.alias(f"d{i}") for i, c in enumerate(values)))
    return df.withColumn("curve", curve(packed))


def cut_runs(df: DataFrame, order: list[str], shards: int) -> DataFrame:
    """Adds ``shard`` and ``slot``: runs of the given order whose sizes differ by one at most.

    ``order`` should tell rows apart; rows equal in it are numbered arbitrarily.
    """
    numbered = number_rows(df, order, "_rank", start=0)
    total = numbered.count()
    first = F.expr(f"(_shard * {total}L + {shards - 1}) div {shards}")
    return (
        numbered.withColumn("_shard", F.expr(f"(_rank * {shards}L) div {max(total, 1)}L"))
        .withColumn("slot", F.col("_rank") - first)
        .withColumn("shard", F.col("_shard").cast("int"))
        .drop("_rank", "_shard")
    )


def shard_documents(
    docs: DataFrame, shards: int = 40, dimensions: tuple[str, ...] = ("source", "lang", "size", "doc_id")
) -> DataFrame:
    """``doc_id, size, text_crc32, curve, shard, slot`` for every row.

    Only these narrow columns are sorted; the texts do not travel.  A null text has 16
    bytes and the checksum of an empty text; a null in a dimension is its lowest value.
    Repeated rows keep a place each.  An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    extra = [d for d in dimensions if d not in ("size", "doc_id", "text")]
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *(F.col(d).alias(f"dim_{d}") for d in extra),
    )
    names = [f"dim_{d}" if d in extra else d for d in dimensions]
    placed = with_curve_index(narrow, names).select("doc_id", "size", "text_crc32", "curve")
    return cut_runs(placed, ["curve", "doc_id", "text_crc32", "size"], shards)


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Write whole rows of ``docs`` (unique ``doc_id``) as one folder per shard, in slot order."""
    where = placed.select("doc_id", "shard", "slot")
    (
        docs.join(where, "doc_id")
        .repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
