"""K-means with all restarts in one pass per iteration.

The points are packed once into blocks of numbers.  A pass scans the blocks for every restart
that still moves: each task adds up its points per restart and cluster, the sums are combined
in a shuffle, and only the sums of all points reach the driver.  Seeds are drawn by hashes of
the row ids, so the same rows give the same model however they are partitioned.

A task holds a few blocks at a time, however many its partition has.  The blocks lie on the
executors' disks and are handed to Python one by one as an RDD; as rows of a table they would
fill the heap, and an Arrow batch, which Spark cuts by the number of rows, would hold hundreds.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Defaults of the method.
CLUSTERS = 5
RESTARTS = 10
MAX_ITERATIONS = 300
SEED = 42

#: A restart has converged when its centres moved by this much, as a sum of squares.
TOLERANCE = 1e-4
#: Costs this close, as a share, count as equal; the first restart among them is taken.
SAME_COST = 1e-6
#: Points of a block.
_BLOCK = 4_096
#: Lossless and fast to undo.
_CODEC = "lz4"
#: Points whose distances to all centres are worked out at a time.
_SLICE = 1_024
#: Hex digits of a hash that make a number between 0 and 1.
_DIGITS = 13


@dataclass(frozen=True)
class KMeansModel:
    """Centres in ascending order of their coordinates, and the sum of squared distances to them."""

    names: list[str]
    centers: np.ndarray
    cost: float


def shift_of(seed: int, draw: int) -> int:
    """How far a draw moves the keys of the rows around their range."""
    return int(hashlib.md5(f"{seed}:{draw}".encode(), usedforsecurity=False).hexdigest()[:_DIGITS], 16)


def _pressed(x: np.ndarray) -> bytes:
    """Points feature by feature, compressed without loss: every pass hands all blocks to Python."""
    raw = np.ascontiguousarray(x.T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec=_CODEC, asbytes=True)


def _points(block: bytes, width: int) -> np.ndarray:
    raw = pa.decompress(pa.py_buffer(block)[8:], int.from_bytes(block[:8], "little"), codec=_CODEC)
    return np.ascontiguousarray(np.frombuffer(raw).reshape(width, -1).T)


def _packed(matrix: DataFrame, names: list[str]) -> RDD:
    """Blocks of points: a number from the MD5 of each row's id, and the features of the rows."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]).astype(np.float64)
            at = range(0, len(x), _BLOCK)
            keys, points = [keys[i : i + _BLOCK].tobytes() for i in at], [_pressed(x[i : i + _BLOCK]) for i in at]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(points, pa.binary())], ["keys", "points"])

    digits = F.substring(F.md5(F.coalesce(F.col("transaction_id").cast("string"), F.lit(""))), 1, _DIGITS)
    chosen = matrix.select(F.conv(digits, 16, 10).cast("long"), *[F.col(n).cast("double") for n in names])
    # As bytes of Python's own: those of a row take up to twice the room when pickled.
    return chosen.mapInArrow(pack, "keys binary, points binary").rdd.map(lambda row: (bytes(row[0]), bytes(row[1])))


def _squared(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of centres (rows) to points (columns)."""
    away = centers @ x.T
    away *= -2.0
    away += (x**2).sum(axis=1)[None, :]
    away += (centers**2).sum(axis=1)[:, None]
    return np.maximum(away, 0.0, out=away)


def _slices(x: np.ndarray) -> Iterator[np.ndarray]:
    """Points of a block, a few at a time so that their distances stay in the processor's cache."""
    return (x[i : i + _SLICE] for i in range(0, len(x), _SLICE))


def _faster(a: tuple[float, int, bytes], b: tuple[float, int, bytes]) -> tuple[float, int, bytes]:
    """The greater of two candidates of a draw; as in SQL, no number exceeds all numbers."""
    return max(a, b, key=lambda found: (math.isnan(found[0]), 0.0 if math.isnan(found[0]) else found[0], *found[1:]))


def _seeds(blocks: RDD, width: int, k: int, seeds: Sequence[int]) -> np.ndarray:
    """Starting centres (restart x centre x feature), drawn with odds in proportion to squared distance.

    Of exponential variables divided by the squared distance to the nearest centre so far, the
    smallest wins; the first centre is drawn evenly.  A task names one candidate per restart.
    Without points there are no centres.
    """
    chosen = np.zeros((len(seeds), 0, width))
    for draw in range(k):
        now = chosen

        def race(part: Iterator[tuple[bytes, bytes]]) -> Iterator[tuple[int, tuple[float, int, bytes]]]:
            best: list[tuple[float, int, bytes] | None] = [None] * len(seeds)
            for keys, points in part:
                keys, x = np.frombuffer(keys, np.int64), _points(points, width)
                if draw:
                    least = np.concatenate([
                        _squared(few, now.reshape(-1, width)).reshape(len(seeds), draw, -1).min(axis=1)
                        for few in _slices(x)
                    ], axis=1)
                for r, seed in enumerate(seeds):
                    drawn = ((keys + shift_of(seed, draw)) % 16**_DIGITS + 0.5) / 16**_DIGITS
                    speed = (least[r] if draw else 1.0) / -np.log(drawn)
                    i = int(speed.argmax())
                    found = (float(speed[i]), int(keys[i]), x[i].tobytes())
                    if best[r] is None or found > best[r]:
                        best[r] = found
            return ((r, b) for r, b in enumerate(best) if b is not None)

        won = dict(blocks.mapPartitions(race).reduceByKey(_faster, len(seeds)).collect())  # one per restart
        if not won:
            break
        points = np.array([np.frombuffer(won[r][2]) for r in range(len(seeds))])
        chosen = np.concatenate([chosen, points[:, None, :]], axis=1)
    return chosen


def _pass(blocks: RDD, centers: np.ndarray, move: bool) -> tuple[np.ndarray, np.ndarray]:
    """Costs of the restarts and, with ``move``, the means of their clusters; an empty cluster stays."""
    restarts, k, width = centers.shape

    def add(part: Iterator[tuple[bytes, bytes]]) -> Iterator[tuple[int, np.ndarray]]:
        # Per restart and cluster: sums of coordinates, number of points, sum of squared distances.
        total = np.zeros((restarts, k, width + 2))
        flat = centers.reshape(-1, width)
        for _, points in part:
            for x in _slices(_points(points, width)):
                away = _squared(x, flat).reshape(restarts, k, len(x))
                least = away.min(axis=1)
                own, free = np.zeros(away.shape), np.ones(least.shape, dtype=bool)
                for j in range(k):  # of equally near centres the first
                    near = (away[:, j] == least) & free
                    own[:, j] = near
                    free &= ~near
                own[:, 0] += free  # distances that are no number
                if move:
                    total[:, :, :width] += (own.reshape(-1, len(x)) @ x).reshape(restarts, k, width)
                total[:, :, width] += own.sum(axis=2)
                total[:, :, width + 1] += (own @ least[:, :, None])[:, :, 0]
        return enumerate(total)

    # One table of numbers per restart, as large as its model.
    sums = dict(blocks.mapPartitions(add).reduceByKey(np.add, restarts).collect())
    total = np.array([sums[r] for r in range(restarts)])
    n = total[:, :, width : width + 1]
    means = np.where(n > 0, total[:, :, :width] / np.maximum(n, 1), centers)
    return total[:, :, width + 1].sum(axis=1), means


def fit_kmeans(
    matrix: DataFrame,
    names: Sequence[str],
    n_clusters: int = CLUSTERS,
    random_state: int = SEED,
    restarts: int = RESTARTS,
    max_iterations: int = MAX_ITERATIONS,
) -> KMeansModel:
    """The cheapest of ``restarts`` runs over rows of ``transaction_id`` and the features.

    All runs share every scan of the points; those that have converged drop out of it.  A
    matrix without rows has centres at zero; with fewer distinct points than clusters, centres
    repeat.  The blocks are kept on disk, and lost ones are packed again.
    """
    names, width = list(names), len(names)
    blocks = _packed(matrix, names).persist(StorageLevel.DISK_ONLY)
    try:
        centers = _seeds(blocks, width, n_clusters, [random_state + r for r in range(restarts)])
        if not centers.size:
            return KMeansModel(names, np.zeros((n_clusters, width)), 0.0)
        moving = np.arange(restarts)
        for _ in range(max_iterations):
            _, means = _pass(blocks, centers[moving], True)
            shift = ((means - centers[moving]) ** 2).sum(axis=(1, 2))
            centers[moving] = means
            moving = moving[shift > TOLERANCE]
            if not len(moving):
                break
        costs, _ = _pass(blocks, centers, False)
    finally:
        blocks.unpersist()
    best = int(np.flatnonzero(costs <= costs.min() * (1 + SAME_COST))[0])
    order = np.lexsort(centers[best].T[::-1])
    return KMeansModel(names, centers[best][order], float(costs[best]))
