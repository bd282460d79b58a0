"""Repeatable uniform samples of a fixed size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HASH = "_hash"
#: Leading hex digits of the hash that are counted first: 4,096 counts.
_DIGITS = 3


def lowest_hashes(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """The ``n`` rows with the lowest hash of ``key:seed`` (MD5), plus ``_hash``.

    A top-n keeps ``n`` candidates from every input partition.  The rows are
    therefore counted by the first digits of their hash, and only those up to
    the digits that hold the n-th row are ordered.
    """
    hashed = df.withColumn(HASH, F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))))
    lead = F.substring(HASH, 1, _DIGITS)
    counts = sorted(hashed.groupBy(lead.alias("lead")).count().collect(), key=lambda r: r[0] or "")
    seen, bound = 0, None
    for row in counts:  # at most 16 ** _DIGITS, and one for null keys
        seen, bound = seen + row["count"], row["lead"]
        if seen >= n:
            break
    if bound is not None:
        hashed = hashed.filter(F.col(HASH).isNull() | (lead <= bound))
    return hashed.orderBy(HASH, key).limit(n)
