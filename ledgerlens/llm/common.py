"""Helpers shared by the text operators: batches, words and 64-bit hashes in numpy."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.settings import scratch_path

#: Rows of an Arrow batch, so that a Python worker holds a few MB of text at a time.
BATCH_ROWS = 500
#: Bytes of text that one vectorised step works on; a longer text is a step of its own.
STEP_BYTES = 1 << 20

#: The hashes below are polynomials over the integers modulo this prime, at a point drawn once.
#: Modulo a power of two, texts of a regular build (Thue-Morse words) would meet at any base.
PRIME = (1 << 61) - 1
BASE = 0x0D3C_21B7_9F4A_7C15
INVERSE = pow(BASE, -1, PRIME)
#: Spans from this many bytes on are hashed by BLAKE2b, which has no limit of length.
LONG_SPAN = 1 << 24
_POWERS: dict[str, np.ndarray] = {}

#: ASCII upper case to lower case, byte by byte; other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words that are cut at white space only.
SPACE_WORD = np.ones(256, dtype=bool)
SPACE_WORD[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words of ASCII letters and digits (after lower-casing) and anything not ASCII.
ALNUM_WORD = np.zeros(256, dtype=bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x61:0x7B] = ALNUM_WORD[0x80:] = True


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of the Arrow batches that this session sends to Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder (zstd Parquet) and read them from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_n_chars(df: DataFrame) -> DataFrame:
    """Bring ``n_chars``, if there is one, in line with ``text``."""
    if "n_chars" not in df.columns:
        return df
    return df.withColumn("n_chars", F.length("text").cast(df.schema["n_chars"].dataType))


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of numbers below ``PRIME``, modulo ``PRIME``."""
    half, low = np.uint64(32), np.uint64(0xFFFFFFFF)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    middle, least = a1 * b0 + a0 * b1, a0 * b0
    # 2 ** 64 is 8 here, and 2 ** 61 is 1.
    total = a1 * b1 * np.uint64(8) + (middle >> np.uint64(29)) + ((middle & np.uint64(0x1FFFFFFF)) << half)
    return _below(total + (least & np.uint64(PRIME)) + (least >> np.uint64(61)))


def _below(x: np.ndarray) -> np.ndarray:
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(61))
    return np.where(x >= np.uint64(PRIME), x - np.uint64(PRIME), x)


def powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The low 31 and the high bits of at least ``n`` powers of the base, and powers of its inverse."""
    if len(_POWERS.get("down", ())) < n:
        size = 1 << max(16, int(n).bit_length())
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.ones(1, dtype=np.uint64)
            while len(steps) < size:
                steps = np.concatenate([steps, times(steps, np.uint64(pow(base, len(steps), PRIME)))])
            _POWERS[name] = steps
        up = _POWERS.pop("up")
        _POWERS["low"], _POWERS["high"] = up & np.uint64(0x7FFFFFFF), up >> np.uint64(31)
    return _POWERS["low"], _POWERS["high"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits; a bijection."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string or binary column and n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if "string" in str(column.type) else b"")
    _, starts, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(starts, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def word_spans(
    data: np.ndarray, offsets: np.ndarray, word: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of words, and the n + 1 word offsets of the texts."""
    inside = word[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    cut = offsets[:-1][full]
    first[cut] = inside[cut]
    cut = offsets[1:][full] - 1
    last[cut] = inside[cut]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, offsets)


class Sums:
    """Running sums over the bytes of a text, of which ``span_hash`` takes differences."""

    def __init__(self, data: np.ndarray):
        low, high, self.down = powers(len(data) + 1)
        value = data.astype(np.uint64)
        value += np.uint64(1)
        self.data = data
        # A sum of products wraps, but differences over fewer than LONG_SPAN bytes are exact.
        self.low, self.high = (np.zeros(len(data) + 1, dtype=np.uint64) for _ in range(2))
        np.cumsum(value * low[: len(data)], out=self.low[1:])
        value *= high[: len(data)]
        np.cumsum(value, out=self.high[1:])


def prefix_hash(data: np.ndarray) -> Sums:
    return Sums(data)


def span_hash(sums: Sums, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes from ``start`` to ``end``, wherever they stand.

    Two different spans of n bytes agree for n in 2 ** 61 bases at most.
    """
    high = _below(sums.high[end] - sums.high[start])
    # Times 2 ** 31, a rotation modulo PRIME.
    high = ((high & np.uint64((1 << 30) - 1)) << np.uint64(31)) | (high >> np.uint64(30))
    value = times(_below(_below(sums.low[end] - sums.low[start]) + high), sums.down[start])
    size = end - start
    for i in np.flatnonzero(size >= LONG_SPAN):
        found = hashlib.blake2b(sums.data[start[i] : end[i]].tobytes(), digest_size=8).digest()
        value[i] = int.from_bytes(found, "little") & PRIME
    return mix(value | ((size.astype(np.uint64) & np.uint64(7)) << np.uint64(61)))


def files(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI that workers on any machine can open."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def read_file(uri: str) -> bytes:
    fs, path = files(uri)
    with fs.open_input_stream(path, compression=None) as f:
        return f.read()


def write_table(uri: str, table: pa.Table) -> None:
    """Write an Arrow file (zstd) to the shared folder; it appears under its name when it is whole."""
    fs, path = files(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    part = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part, compression=None) as out:
        with pa.ipc.new_file(out, table.schema, options=options) as writer:
            writer.write_table(table)
    fs.move(part, path)


def read_table(uri: str) -> pa.Table:
    return pa.ipc.open_file(pa.py_buffer(read_file(uri))).read_all()


def dealt(df: DataFrame, key: str, then: str, tasks: int) -> DataFrame:
    """Rows of a key together and sorted, for ``by_key``."""
    return df.repartition(tasks, key).sortWithinPartitions(key, then)


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``start[i], start[i] + 1, ...`` (``count[i]`` numbers) one after another."""
    ends = np.cumsum(count)
    return np.repeat(start - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


def by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """Rows of sorted batches, gathered by their first column."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and row[0] != key:
                yield key, rows
                rows = []
            key = row[0]
            rows.append(row[1:])
    if rows:
        yield key, rows
