"""Save and load fitted models: their parameters as Parquet."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.models import IsolationForest, KMeansModel, Scaler


@dataclass(frozen=True)
class Models:
    scaler: Scaler | None = None
    forest: IsolationForest | None = None
    kmeans: KMeansModel | None = None


def save_models(spark: SparkSession, models: Models, path: str) -> None:
    """Write every fitted model; the others are left out."""
    root = path.rstrip("/")
    if models.scaler:
        s = models.scaler
        rows = list(zip(range(len(s.names)), s.names, s.means, s.deviations))
        spark.createDataFrame(
            rows, "position int, name string, mean double, deviation double"
        ).write.mode("overwrite").parquet(f"{root}/scaler")
    if models.forest:
        f = models.forest
        trees, size = f.feature.shape
        nodes = [
            (t, n, int(f.feature[t, n]), float(f.cut[t, n]), float(f.path[t, n]))
            for t in range(trees)
            for n in range(size)
        ]
        spark.createDataFrame(
            nodes, "tree int, node int, feature int, cut double, path double"
        ).write.mode("overwrite").parquet(f"{root}/isolation_forest/nodes")
        spark.createDataFrame(
            [(f.names, f.per_tree, f.contamination, f.threshold)],
            "names array<string>, per_tree int, contamination double, threshold double",
        ).write.mode("overwrite").parquet(f"{root}/isolation_forest/settings")
    if models.kmeans:
        k = models.kmeans
        rows = [(i, c, k.names, k.cost) for i, c in enumerate(k.centers.tolist())]
        spark.createDataFrame(
            rows, "cluster int, center array<double>, names array<string>, cost double"
        ).write.mode("overwrite").parquet(f"{root}/kmeans")


def _load(kind: str, loader):
    try:
        return loader()
    except (AnalysisException, OSError) as missing:
        warnings.warn(f"{kind} not found: {missing}", stacklevel=3)
        return None


def _load_scaler(spark: SparkSession, root: str) -> Scaler:
    rows = spark.read.parquet(f"{root}/scaler").orderBy("position").collect()
    return Scaler(
        [r["name"] for r in rows], [r["mean"] for r in rows], [r["deviation"] for r in rows]
    )


def _load_forest(spark: SparkSession, root: str) -> IsolationForest:
    nodes = (
        spark.read.parquet(f"{root}/isolation_forest/nodes")
        .orderBy("tree", "node")
        .select("tree", "node", "feature", F.col("cut"), "path")
        .toPandas()
    )
    settings = spark.read.parquet(f"{root}/isolation_forest/settings").first()
    shape = (int(nodes["tree"].max()) + 1, int(nodes["node"].max()) + 1)
    table = lambda c, kind: np.ascontiguousarray(nodes[c].to_numpy(dtype=kind).reshape(shape))
    return IsolationForest(
        list(settings["names"]), settings["per_tree"],
        table("feature", np.int64), table("cut", float), table("path", float),
        settings["contamination"], settings["threshold"],
    )


def _load_kmeans(spark: SparkSession, root: str) -> KMeansModel:
    rows = spark.read.parquet(f"{root}/kmeans").orderBy("cluster").collect()
    return KMeansModel(list(rows[0]["names"]), np.array([r["center"] for r in rows]), rows[0]["cost"])


def load_models(spark: SparkSession, path: str) -> Models:
    """Read what is there; a missing model is only a warning."""
    root = path.rstrip("/")
    return Models(
        _load("scaler", lambda: _load_scaler(spark, root)),
        _load("isolation forest", lambda: _load_forest(spark, root)),
        _load("k-means", lambda: _load_kmeans(spark, root)),
    )
