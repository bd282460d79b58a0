"""Scaling, isolation forest, k-means outliers, PCA and their helpers.

Models are fitted by Spark jobs; what reaches the driver is the fitted
parameters, whose size depends on the number of features, trees and clusters
and not on the data.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions.quantiles import ACCURACY, exact_quantile
from ledgerlens.functions.sampling import HASH, lowest_hashes
from ledgerlens.operators.clustering import (  # noqa: F401  part of this module's interface
    CLUSTERS, MAX_ITERATIONS, RESTARTS, SEED, KMeansModel, fit_kmeans,
)
from ledgerlens.settings import materialised

# Defaults of the models.
TREES = 100
SUBSAMPLE = 256
CONTAMINATION = 0.05
OUTLIER_PERCENTILE = 95
ML_WEIGHT = 10

_EULER = 0.5772156649015329
#: A feature whose values in a node lie within this is constant there, but for rounding.
LEAST_RANGE = 1e-9
#: Leaf path lengths are multiples of this, a power of two.
PATH_STEP = 2.0**-20


# --- standard scaling -------------------------------------------------------


@dataclass(frozen=True)
class Scaler:
    """Per-feature mean and population deviation."""

    names: list[str]
    means: list[float]
    deviations: list[float]

    def transform(self, matrix: DataFrame) -> DataFrame:
        """Scale the feature columns; a constant feature becomes 0."""
        scaled = {
            n: (F.col(n) - F.lit(m)) / F.lit(s if s > 0 else 1.0)
            for n, m, s in zip(self.names, self.means, self.deviations)
        }
        return matrix.withColumns(scaled)


def _centred(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Deviations from the mean, and the mean; those of equal values are exactly 0."""
    base = x[0] if np.isfinite(x[0]) else 0.0
    away = x - base
    shift = away.mean()
    return away - shift, base + shift


def _co_moments(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float, float]:
    """Pairs, means of both, and the sum of products of the deviations."""
    if not len(x):
        return 0.0, 0.0, 0.0, 0.0
    dx, mx = _centred(x)
    dy, my = (dx, mx) if y is x else _centred(y)
    return float(len(x)), mx, my, float(dx @ dy)


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Co-moments (4 x columns) of the rows of both."""
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    dx, dy = b[1] - a[1], b[2] - a[2]
    both = np.array([n, a[1] + dx * share, a[2] + dy * share, a[3] + b[3] + dx * dy * a[0] * share])
    return np.where(a[0] == 0, b, np.where(b[0] == 0, a, both))


def co_moments(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> np.ndarray:
    """Rows, two means and the sum of products of deviations, for pairs of columns where neither is null.

    As SQL aggregates, dozens of them outgrow compiled code and are interpreted row by row.  A task
    adds up its batches and returns one row of numbers.
    """
    names = list(dict.fromkeys(n for pair in pairs for n in pair))
    at = [(names.index(a), names.index(b)) for a, b in pairs]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, len(at)))
        for batch in batches:
            there = [c.is_valid().to_numpy(zero_copy_only=False) if c.null_count else None for c in batch.columns]
            values = [c.to_numpy(zero_copy_only=False) for c in batch.columns]

            def part(i: int, j: int) -> tuple[float, float, float, float]:
                kept = [there[c] for c in (i, j) if there[c] is not None]
                if not kept:
                    return _co_moments(values[i], values[j])
                kept = np.logical_and.reduce(kept)
                x = values[i][kept]
                return _co_moments(x, x if i == j else values[j][kept])

            total = _merged(total, np.array([part(i, j) for i, j in at]).reshape(-1, 4).T)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()])], ["total"])

    chosen = df.select(*[F.col(n).cast("double").alias(f"c{i}") for i, n in enumerate(names)])
    parts = chosen.mapInArrow(add, "total array<double>").collect()  # one row per task
    totals = [np.array(p["total"]).reshape(4, len(at)) for p in parts]
    return reduce(_merged, totals, np.zeros((4, len(at))))


def fit_scaler(matrix: DataFrame, names: Sequence[str]) -> Scaler:
    names = list(names)
    rows, means, _, squares = co_moments(matrix, [(n, n) for n in names])
    deviations = np.sqrt(squares / np.maximum(rows, 1))
    return Scaler(names, means.tolist(), deviations.tolist())


# --- isolation forest -------------------------------------------------------


def average_path(n) -> np.ndarray:
    """Mean depth of an unsuccessful search in a tree of ``n`` rows."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3)
    value = 2.0 * (np.log(big - 1.0) + _EULER) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, value, np.where(n == 2, 1.0, 0.0))


def _leaf_path(level: int, rows: int) -> float:
    """Path length of a leaf, in steps whose sums over trees are exact in any order."""
    return math.floor((level + float(average_path(rows))) / PATH_STEP + 0.5) * PATH_STEP


def _node_draw(seed: int, tree: int, node: int) -> tuple[int, float]:
    """A whole number and one between 0 and 1 from the MD5 of ``seed:tree:node``."""
    digits = hashlib.md5(f"{seed}:{tree}:{node}".encode(), usedforsecurity=False).hexdigest()
    return int(digits[:8], 16), (int(digits[8:21], 16) + 0.5) / 16**13


def _grow_tree(rows: np.ndarray, depth: int, seed: int, tree: int) -> pd.DataFrame:
    """One isolation tree in heap layout: node i has children 2i+1 and 2i+2.

    A node's hash picks one of the features that vary in it and where to cut
    its range, so a tree depends on its rows, its number and the seed only.
    """
    nodes = []
    pending = [(0, 0, np.arange(len(rows)))]
    while pending:
        node, level, members = pending.pop()
        part = rows[members]
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high - low > LEAST_RANGE)
        if level == depth or len(usable) == 0:
            nodes.append((node, -1, 0.0, _leaf_path(level, len(members))))
            continue
        pick, share = _node_draw(seed, tree, node)
        feature = int(usable[pick % len(usable)])
        cut = low[feature] + share * (high[feature] - low[feature])
        if cut >= high[feature]:  # rounding reached the top; keep both sides filled
            cut = low[feature]
        left = part[:, feature] <= cut
        nodes.append((node, feature, cut, 0.0))
        pending.append((2 * node + 1, level + 1, members[left]))
        pending.append((2 * node + 2, level + 1, members[~left]))
    return pd.DataFrame(nodes, columns=["node", "feature", "cut", "path"])


def _forest_sample(matrix: DataFrame, trees: int, seed: int) -> tuple[DataFrame, int]:
    """Training rows with their ``tree`` and the number of rows per tree.

    The lowest hashes are a uniform sample in one pass, of at most
    ``trees * SUBSAMPLE`` rows.  Each tree takes the next slice of their order,
    starting over at the end when the input is smaller, so a tree never holds a
    row twice.
    """
    sample = lowest_hashes(matrix, "transaction_id", trees * SUBSAMPLE, seed)
    sample = materialised(sample, "forest-sample")
    n = sample.count()
    per_tree = min(SUBSAMPLE, n)
    place = F.row_number().over(Window.orderBy(HASH, "transaction_id")) - 1
    slots = F.sequence("_place", F.lit(trees * per_tree - 1), F.lit(n))
    chosen = (
        sample.withColumn("_place", place)
        .withColumn("_slot", F.explode(slots))
        .withColumn("tree", F.expr(f"_slot div {per_tree}"))
    )
    return chosen, per_tree


@dataclass(frozen=True)
class IsolationForest:
    """Fitted trees as (trees x nodes) tables in heap layout."""

    names: list[str]
    per_tree: int
    feature: np.ndarray
    cut: np.ndarray
    path: np.ndarray
    contamination: float
    threshold: float | None = None

    def _complete(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The tables with every leaf handed down to the lowest level, so that all walks are equally long."""
        feature, cut, path = self.feature.copy(), self.cut, self.path.astype(float)
        for node in range((feature.shape[1] - 1) // 2):
            leaf = feature[:, node] < 0
            for child in (2 * node + 1, 2 * node + 2):
                feature[leaf, child] = -1
                path[leaf, child] = path[leaf, node]
        return np.maximum(feature, 0), cut, path

    def score_column(self) -> Column:
        feature, cut, path = self._complete()
        trees, size = feature.shape
        steps = int(math.log2(size + 1)) - 1
        norm = float(average_path(self.per_tree)) or 1.0

        @F.pandas_udf("double")
        def anomaly(features: pd.DataFrame) -> pd.Series:
            n = len(features)
            # Feature by feature in one row of numbers; a tree at a time stays in the processor's cache.
            x = np.ascontiguousarray(features.to_numpy(dtype=float).T).ravel()
            row, total = np.arange(n), np.zeros(n)
            for f, c, p in zip(feature * n, cut, path):
                node = np.zeros(n, dtype=np.intp)
                for _ in range(steps):
                    right = x.take(f.take(node) + row) > c.take(node)
                    node = 2 * node + 1 + right
                total += p.take(node)
            return pd.Series(np.power(2.0, -(total / trees) / norm))

        return anomaly(F.struct(*self.names))

    def score(self, matrix: DataFrame) -> DataFrame:
        """``transaction_id`` and ``ml_anomaly_score``, higher = more unusual."""
        return matrix.select("transaction_id", self.score_column().alias("ml_anomaly_score"))

    def predict(self, matrix: DataFrame) -> DataFrame:
        """Adds ``ml_prediction``: -1 above the training threshold, else 1."""
        return self.label(self.score(matrix))

    def label(self, scores: DataFrame) -> DataFrame:
        unusual = F.col("ml_anomaly_score") > F.lit(self.threshold)
        return scores.withColumn("ml_prediction", F.when(unusual, -1).otherwise(1))


def _forest_from_nodes(nodes: pd.DataFrame, names, per_tree, trees, contamination, threshold=None):
    depth = max(1, math.ceil(math.log2(max(per_tree, 2))))
    size = 2 ** (depth + 1) - 1
    feature = np.full((trees, size), -1, dtype=np.int64)
    cut = np.zeros((trees, size))
    path = np.zeros((trees, size))
    at = (nodes["tree"].to_numpy(), nodes["node"].to_numpy())
    feature[at], cut[at], path[at] = nodes["feature"], nodes["cut"], nodes["path"]
    return IsolationForest(list(names), per_tree, feature, cut, path, contamination, threshold)


def fit_isolation_forest(
    matrix: DataFrame,
    names: Sequence[str],
    contamination: float = CONTAMINATION,
    random_state: int = SEED,
    trees: int = TREES,
) -> tuple[IsolationForest, DataFrame]:
    """Grow the forest (one task group per tree) and set its threshold.

    Returns the model and the training scores, which are written once because
    the threshold and the predictions both read them.
    """
    names = list(names)
    chosen, per_tree = _forest_sample(matrix, trees, random_state)
    depth = max(1, math.ceil(math.log2(max(per_tree, 2))))

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tree = _grow_tree(pdf[names].to_numpy(dtype=float), depth, random_state, int(key[0]))
        return tree.assign(tree=int(key[0]))

    nodes = (
        chosen.select("tree", *names)
        .groupBy("tree")
        .applyInPandas(grow, "node long, feature long, cut double, path double, tree long")
        .toPandas()  # at most trees * (2 * SUBSAMPLE - 1) rows
    )
    model = _forest_from_nodes(nodes, names, per_tree, trees, contamination)
    scores = materialised(model.score(matrix))
    threshold = exact_quantile(scores, "ml_anomaly_score", 1 - contamination)
    return replace(model, threshold=threshold), scores


def forest_summary(predictions: DataFrame) -> DataFrame:
    """Training summary: counts, anomaly rate and score range."""
    unusual = F.col("ml_prediction") == -1
    return predictions.agg(
        F.count(F.lit(1)).alias("samples"),
        F.count_if(unusual).alias("anomalies"),
        (F.avg(unusual.cast("int")) * 100).alias("anomaly_rate"),
        F.min("ml_anomaly_score").alias("min_score"),
        F.max("ml_anomaly_score").alias("max_score"),
    )


# --- k-means ----------------------------------------------------------------


def with_centroid_distance(
    matrix: DataFrame, names: Sequence[str], centers: Sequence[Sequence[float]]
) -> DataFrame:
    """``cluster`` and Euclidean ``distance_to_centroid`` to the nearest of the given centres.

    Batches of rows against all centres: as columns, the terms of features times centres
    outgrow generated code.
    """
    middle = np.asarray(centers, dtype=float)

    @F.pandas_udf("cluster int, distance_to_centroid double")
    def nearest(features: pd.DataFrame) -> pd.DataFrame:
        x = features.to_numpy(dtype=float)
        away = np.stack([((x - c) ** 2).sum(axis=1) for c in middle], axis=1)
        own = away.argmin(axis=1)
        distance = np.sqrt(away[np.arange(len(x)), own])
        return pd.DataFrame({"cluster": own.astype(np.int32), "distance_to_centroid": distance})

    doubles = [F.col(n).cast("double").alias(f"f{i}") for i, n in enumerate(names)]
    return matrix.withColumn("_near", nearest(F.struct(*doubles))).select(*matrix.columns, "_near.*")


def flag_distance_outliers(
    distances: DataFrame, percentile: float = OUTLIER_PERCENTILE, accuracy: int = ACCURACY
) -> DataFrame:
    """``is_outlier``: distance above its exact percentile.

    The distances are written once: the percentile and the flags read them.
    """
    distances = materialised(distances, "distances")
    threshold = exact_quantile(distances, "distance_to_centroid", percentile / 100, accuracy)
    return distances.withColumn(
        "is_outlier", F.col("distance_to_centroid") > F.lit(threshold)
    )


def predict_kmeans_outliers(
    model: KMeansModel,
    matrix: DataFrame,
    names: Sequence[str],
    percentile: float = OUTLIER_PERCENTILE,
) -> DataFrame:
    """``transaction_id, cluster, distance_to_centroid, is_outlier``."""
    placed = with_centroid_distance(matrix, names, model.centers.tolist()).select(
        "transaction_id", "cluster", "distance_to_centroid"
    )
    return flag_distance_outliers(placed, percentile)


def cluster_sizes(clustered: DataFrame) -> DataFrame:
    """Rows, share and outliers of each cluster."""
    whole = Window.partitionBy()  # over one row per cluster
    return (
        clustered.groupBy("cluster")
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.count_if("is_outlier").alias("outliers"),
        )
        .withColumn("percentage", F.col("transactions") * 100.0 / F.sum("transactions").over(whole))
    )


# --- PCA --------------------------------------------------------------------


def apply_pca(
    matrix: DataFrame, names: Sequence[str], n_components: int = 10
) -> tuple[DataFrame, list[float]]:
    """``transaction_id`` with ``components array<double>``, and the share of
    variance each component explains.

    The loading of a component that is largest in size (of equal ones the first) is positive.
    """
    names = list(names)
    centred = matrix.withColumns(
        {n: F.col(n) - F.lit(m) for n, m in zip(names, fit_scaler(matrix, names).means)}
    )
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(centred)
    model = PCA(k=min(n_components, len(names)), inputCol="features", outputCol="reduced").fit(
        vectors
    )
    loadings = model.pc.toArray()
    largest = loadings[np.abs(loadings).argmax(axis=0), np.arange(loadings.shape[1])]
    signs = F.array(*[F.lit(-1.0 if v < 0 else 1.0) for v in largest])
    signed = F.zip_with(vector_to_array("reduced"), signs, lambda value, sign: value * sign)
    reduced = model.transform(vectors).select("transaction_id", signed.alias("components"))
    return reduced, model.explainedVariance.toArray().tolist()


# --- importance, flags, hybrid score, sample --------------------------------


def get_feature_importance(
    scored_matrix: DataFrame, names: Sequence[str], score: str, n_top: int | None = None
) -> DataFrame:
    """Absolute correlation of each feature with the score, highest first.

    One pass computes all of them; a constant feature has none (NULL).
    """
    names = list(names)
    moments = co_moments(scored_matrix, [(n, n) for n in [*names, score]] + [(n, score) for n in names])
    mean = moments[3] / np.where(moments[0] > 0, moments[0], np.nan)
    own, covariance = np.sqrt(mean[: len(names) + 1]), mean[len(names) + 1 :]
    spread = own[:-1] * own[-1]
    found = [
        None if not k or not c or s == 0 else float(abs(v / s))
        for k, c, s, v in zip(moments[0], moments[0][len(names) + 1 :], spread, covariance)
    ]
    values = ", ".join(f"`{n}` double" for n in names)
    row = scored_matrix.sparkSession.createDataFrame([found], values)
    pairs = F.array(
        *[F.struct(F.lit(n).alias("feature"), F.col(n).alias("importance")) for n in names]
    )
    ranked = row.select(F.inline(pairs)).orderBy(F.desc_nulls_last("importance"), "feature")
    return ranked.limit(n_top) if n_top else ranked


def with_ml_flag(scored: DataFrame, predictions: DataFrame) -> DataFrame:
    """``ml_flagged``: the forest also found this scored transaction unusual."""
    unusual = (
        predictions.filter(F.col("ml_prediction") == -1)
        .select("transaction_id")
        .distinct()
        .withColumn("ml_flagged", F.lit(True))
    )
    return scored.join(unusual, "transaction_id", "left").withColumn(
        "ml_flagged", F.coalesce("ml_flagged", F.lit(False))
    )


def with_hybrid_score(scored: DataFrame, scores: DataFrame) -> DataFrame:
    """``hybrid_score``: rule score plus ten times the anomaly score."""
    once = scores.groupBy("transaction_id").agg(F.max("ml_anomaly_score").alias("ml_anomaly_score"))
    return scored.join(once, "transaction_id").withColumn(
        "hybrid_score", F.col("final_risk_score") + ML_WEIGHT * F.col("ml_anomaly_score")
    )


def sample_rows(df: DataFrame, n: int, random_state: int = SEED) -> DataFrame:
    """A repeatable uniform sample of ``n`` rows: the lowest seeded hashes."""
    return lowest_hashes(df, "transaction_id", n, random_state).drop(HASH)
