"""Transaction input: schema, normalisation, CSV/Parquet scans and sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("counterparty", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("is_suspicious", T.BooleanType()),
        T.StructField("suspicious_pattern", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
    ]
)

REQUIRED = ["transaction_id", "user_id", "timestamp", "amount", "transaction_type"]
OPTIONAL = ["merchant", "counterparty", "location", "description"]


def normalise(df: DataFrame) -> DataFrame:
    """Cast known columns to the fixed types; NaN amounts become NULL.

    In Spark ``NaN > x`` is true, so a NaN left in place would trip every
    threshold rule.
    """
    known = {f.name: f.dataType for f in TRANSACTION_SCHEMA}
    columns = []
    for name in df.columns:
        column = F.col(name)
        if name in known:
            column = column.cast(known[name])
        if name == "amount":
            column = F.when(~F.isnan(column), column)
        columns.append(column.alias(name))
    return df.select(*columns)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TRANSACTION_SCHEMA,
    multiline: bool = False,
    escaped: bool = False,
) -> DataFrame:
    """CSV scan with a header, typed by name without an inference pass.

    Files are split between tasks at line ends.  Files of other programs whose
    quoted values hold line breaks need ``multiline``, which reads every file
    in one task; files written with ``breaks="escape"`` need ``escaped``.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    names = reader.csv(path).columns
    known = {f.name: f for f in schema}
    typed = T.StructType([known.get(n, T.StructField(n, T.StringType())) for n in names])
    rows = reader.schema(typed).csv(path)
    return _on_strings(rows, _unescape) if escaped else rows


def load_transactions(
    spark: SparkSession, path: str, fmt: str = "csv", multiline: bool = False, escaped: bool = False
) -> DataFrame:
    if fmt == "csv":
        return normalise(read_csv(spark, path, multiline=multiline, escaped=escaped))
    return normalise(spark.read.format(fmt).load(path))


def _on_strings(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: change(F.col(c)) for c in text}) if text else df


# A backslash is doubled before line breaks turn into letters behind one.  On the
# way back a text is cut at the doubled ones, found from the left, so that what
# follows a backslash within a piece is a letter.
def _escape(column: Column) -> Column:
    for old, new in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        column = F.replace(column, F.lit(old), F.lit(new))
    return column


def _unescape(column: Column) -> Column:
    def breaks(piece: Column) -> Column:
        for old, new in (("\\n", "\n"), ("\\r", "\r")):
            piece = F.replace(piece, F.lit(old), F.lit(new))
        return piece

    return F.array_join(F.transform(F.split(column, r"\\\\", -1), breaks), "\\")


def _refuse(column: Column) -> Column:
    broken = F.raise_error(F.lit("a value holds a line break; write with breaks='escape'"))
    return F.when(column.rlike("[\r\n]"), broken.cast("string")).otherwise(column)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", breaks: str = "refuse") -> str:
    """CSV sink; one file per partition under ``path``.

    A line break inside a value would split its row for readers that split
    files, so such values are refused, or with ``breaks="escape"`` written as
    a backslash and a letter, or with ``breaks="keep"`` as they are.
    """
    change = {"refuse": _refuse, "escape": _escape, "keep": lambda c: c}[breaks]
    writer = _on_strings(df, change).write.mode(mode).option("header", True).option("escape", '"')
    # The default format drops microseconds.
    writer.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return path


def with_calendar(df: DataFrame) -> DataFrame:
    """The date, hour and weekday (0 = Monday) stored with each transaction."""
    return df.withColumns(
        {
            "date": F.to_date("timestamp"),
            "hour": F.hour("timestamp"),
            "day_of_week": F.weekday("timestamp"),
        }
    )


def load_stats(tx: DataFrame) -> DataFrame:
    """One row: period, users, volume and, if labelled, the suspicious share."""
    stats: list[Column] = [
        F.count(F.lit(1)).alias("total_transactions"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
        F.count_distinct("user_id").alias("unique_users"),
        F.sum("amount").alias("total_volume"),
    ]
    if "is_suspicious" in tx.columns:
        stats += [
            F.count_if("is_suspicious").alias("labelled_suspicious"),
            (F.avg(F.col("is_suspicious").cast("int")) * 100).alias("labelled_percent"),
        ]
    return tx.agg(*stats)
