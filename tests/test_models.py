import hashlib
import math
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import clustering
from ledgerlens.operators import models as M
from ledgerlens.sources import model_store

NAMES = [f"f{i}" for i in range(6)]


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(0)
    return np.vstack([rng.normal(size=(950, 6)), rng.normal(size=(50, 6)) * 3 + 5])


@pytest.fixture(scope="module")
def matrix(spark, points):
    rows = [(f"T{i:04d}", *map(float, p)) for i, p in enumerate(points)]
    schema = "transaction_id string, " + ", ".join(f"{n} double" for n in NAMES)
    return spark.createDataFrame(rows, schema).persist()


@pytest.fixture(scope="module")
def forest(matrix):
    return M.fit_isolation_forest(matrix, NAMES)


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaler = M.fit_scaler(df, ["a", "b"])
    got = [tuple(r) for r in scaler.transform(df).orderBy("a").collect()]
    assert np.allclose(got, [(-1.22474487, 0), (0, 0), (1.22474487, 0)])
    # Re-use on other data.
    other = spark.createDataFrame([(2.0, 6.0)], "a double, b double")
    assert tuple(scaler.transform(other).first()) == (0.0, 1.0)


def test_average_path():
    assert np.allclose(M.average_path([1, 2]), [0, 1])
    harmonic = np.log(255) + 0.5772156649
    assert np.isclose(M.average_path(256), 2 * harmonic - 2 * 255 / 256)


def test_forest_flags_the_planted_outliers(forest, points):
    model, scores = forest
    labelled = {r["transaction_id"]: r for r in model.label(scores).collect()}
    flagged = {k for k, r in labelled.items() if r["ml_prediction"] == -1}
    planted = {f"T{i:04d}" for i in range(950, 1000)}
    assert len(labelled) == 1000 and abs(len(flagged) - 50) <= 1
    assert len(flagged & planted) >= 45
    values = [r["ml_anomaly_score"] for r in labelled.values()]
    assert 0 < min(values) and max(values) < 1
    assert np.isclose(model.threshold, np.quantile(values, 0.95))


def test_forest_is_repeatable(forest, matrix):
    model, scores = forest
    again, other = M.fit_isolation_forest(matrix.repartition(5), NAMES)
    assert again.threshold == model.threshold
    assert scores.exceptAll(other).count() == 0
    changed, _ = M.fit_isolation_forest(matrix, NAMES, random_state=7)
    assert changed.threshold != model.threshold


def test_forest_trees_hold_distinct_rows(matrix):
    chosen, per_tree = M._forest_sample(matrix, 100, 42)
    sizes = chosen.groupBy("tree").agg(
        F.count("*").alias("n"), F.count_distinct("transaction_id").alias("d")
    ).collect()
    assert len(sizes) == 100 and all(r["n"] == r["d"] == per_tree == 256 for r in sizes)
    few, per_tree = M._forest_sample(matrix.limit(40), 10, 42)
    assert per_tree == 40 and few.count() == 400
    many, _ = M._forest_sample(matrix, 2, 42)
    assert many.select("transaction_id").distinct().count() == 512


def test_forest_matches_tree_walk(forest, points):
    model, scores = forest
    got = {r["transaction_id"]: r["ml_anomaly_score"] for r in scores.collect()}
    for i in (0, 500, 999):
        depths = []
        for t in range(model.feature.shape[0]):
            node = 0
            while model.feature[t, node] >= 0:
                right = points[i, model.feature[t, node]] > model.cut[t, node]
                node = 2 * node + 1 + int(right)
            depths.append(model.path[t, node])
        want = 2 ** (-np.mean(depths) / float(M.average_path(256)))
        assert np.isclose(got[f"T{i:04d}"], want)


def test_nodes_follow_from_their_hashes(spark):
    rows = np.array([[0.0, 5.0, 1.0], [1.0, 5.0, 9.0], [4.0, 5.0, 2.0], [4.0, 5.0 + 1e-12, 2.0]])
    tree = M._grow_tree(rows, 2, 42, 7).set_index("node")
    digits = hashlib.md5(b"42:7:0").hexdigest()
    feature = [0, 2][int(digits[:8], 16) % 2]
    low, high = rows[:, feature].min(), rows[:, feature].max()
    cut = low + (int(digits[8:21], 16) + 0.5) / 16**13 * (high - low)
    assert tree.loc[0, "feature"] == feature and tree.loc[0, "cut"] == cut
    # The last two rows differ by rounding only, so they end in one leaf; paths are exact steps.
    assert all(p / M.PATH_STEP == int(p / M.PATH_STEP) for p in tree["path"])
    assert len(M._grow_tree(rows[2:], 8, 42, 0)) == 1


def test_constant_rows_make_a_single_leaf(spark):
    df = spark.createDataFrame([(f"T{i}", 1.0) for i in range(20)], "transaction_id string, a double")
    model, scores = M.fit_isolation_forest(df, ["a"], trees=3)
    assert {r["ml_prediction"] for r in model.label(scores).collect()} == {1}


def test_forest_summary(forest):
    model, scores = forest
    row = M.forest_summary(model.label(scores)).first()
    assert row["samples"] == 1000 and abs(row["anomaly_rate"] - 5) < 0.2
    assert row["min_score"] < row["max_score"]


def test_kmeans_distances_and_outliers(matrix, points):
    model = M.fit_kmeans(matrix, NAMES, n_clusters=3, restarts=3)
    assert model.names == NAMES and model.centers.tolist() == sorted(model.centers.tolist())
    out = M.predict_kmeans_outliers(model, matrix, NAMES).toPandas().set_index("transaction_id")
    centers = model.centers
    distances = np.linalg.norm(points[:, None] - centers[None], axis=2)
    got = out.sort_index()
    assert np.allclose(got["distance_to_centroid"], distances.min(axis=1))
    assert (got["cluster"].to_numpy() == distances.argmin(axis=1)).all()
    threshold = np.percentile(distances.min(axis=1), 95)
    assert (got["is_outlier"].to_numpy() == (distances.min(axis=1) > threshold)).all()


def lloyd(x, centers):
    """K-means by hand from given seeds; the centres and the cost."""
    while True:
        own = ((x[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        fresh = np.array([x[own == j].mean(axis=0) if (own == j).any() else c for j, c in enumerate(centers)])
        moved, centers = ((fresh - centers) ** 2).sum(), fresh
        if moved <= clustering.TOLERANCE:
            away = ((x[:, None] - centers[None]) ** 2).sum(axis=2).min(axis=1)
            return centers, away.sum()


def seeds(x, k, seed):
    """The draws by hashes, one after another."""
    keys = [int(hashlib.md5(f"T{i:04d}".encode()).hexdigest()[:13], 16) for i in range(len(x))]
    chosen = []
    for draw in range(k):
        shift = clustering.shift_of(seed, draw)
        time = np.array([-math.log(((key + shift) % 16**13 + 0.5) / 16**13) for key in keys])
        odds = np.min([((x - c) ** 2).sum(axis=1) for c in chosen], axis=0) if chosen else 1.0
        chosen.append(x[(odds / time).argmax()])
    return np.array(chosen)


def test_kmeans_keeps_the_cheapest_restart(matrix, points):
    runs = [lloyd(points, seeds(points, 4, 42 + r)) for r in range(4)]
    model = M.fit_kmeans(matrix, NAMES, 4, restarts=4)
    costs = [cost for _, cost in runs]
    assert np.isclose(model.cost, min(costs))
    assert np.allclose(model.centers, sorted(runs[int(np.argmin(costs))][0].tolist()))


def test_kmeans_does_not_depend_on_partitions(matrix):
    one, other = (M.fit_kmeans(m, NAMES, 5, restarts=3) for m in (matrix.coalesce(1), matrix.repartition(9)))
    assert np.allclose(one.centers, other.centers) and np.isclose(one.cost, other.cost)


def test_restarts_share_every_scan(matrix, monkeypatch):
    scans, scan = [], clustering._pass
    monkeypatch.setattr(clustering, "_pass", lambda blocks, centers, move: scans.append(len(centers)) or scan(blocks, centers, move))
    alone = []
    for r in range(3):
        scans.clear()
        M.fit_kmeans(matrix, NAMES, 4, random_state=42 + r, restarts=1)
        alone.append(len(scans))
    scans.clear()
    M.fit_kmeans(matrix, NAMES, 4, restarts=3)
    # As many scans as the slowest restart needs; those that have converged leave.
    assert len(scans) == max(alone) and sum(scans[:-1]) == sum(alone) - 3
    assert scans[:-1] == sorted(scans[:-1], reverse=True) and scans[-1] == 3


def test_kmeans_of_few_rows(spark):
    schema = "transaction_id string, a double, b double"
    assert M.fit_kmeans(spark.createDataFrame([], schema), ["a", "b"]).centers.tolist() == [[0.0, 0.0]] * 5
    rows = [(f"T{i}", float(i % 2), 1.0) for i in range(6)] + [(None, 0.0, 1.0)]
    model = M.fit_kmeans(spark.createDataFrame(rows, schema), ["a", "b"], 3)
    assert model.cost == 0 and {tuple(c) for c in model.centers} == {(0.0, 1.0), (1.0, 1.0)}


def test_cluster_sizes(spark):
    df = spark.createDataFrame([(0, True), (0, False), (1, False), (1, False)],
                               "cluster int, is_outlier boolean")
    got = {r["cluster"]: tuple(r)[1:] for r in M.cluster_sizes(df).collect()}
    assert got == {0: (2, 1, 50.0), 1: (2, 0, 50.0)}


def test_pca_explains_the_same_variance_as_svd(matrix, points):
    reduced, shares = M.apply_pca(matrix, NAMES, 3)
    centred = points - points.mean(axis=0)
    singular = np.linalg.svd(centred, compute_uv=False) ** 2
    assert np.allclose(shares, (singular / singular.sum())[:3])
    got = np.array([r["components"] for r in reduced.orderBy("transaction_id").collect()])
    assert got.shape == (1000, 3) and np.allclose(got.mean(axis=0), 0, atol=1e-9)
    assert np.allclose((got**2).sum(axis=0), singular[:3])
    assert len(M.apply_pca(matrix, NAMES, 50)[1]) == 6
    # Components with their signs: of the loadings, the largest in size is positive.
    loadings = np.linalg.svd(centred, full_matrices=False)[2][:3].T
    loadings = loadings * np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(3)])
    assert np.allclose(got, centred @ loadings)


def test_importance_masks_constant_features(spark):
    rows = [(float(i), 2.0 * i, 1.0, float(i % 2)) for i in range(10)]
    df = spark.createDataFrame(rows, "score double, a double, constant double, b double")
    got = [tuple(r) for r in M.get_feature_importance(df, ["b", "constant", "a"], "score").collect()]
    assert got[0][0] == "a" and np.isclose(got[0][1], 1.0)
    assert got[-1] == ("constant", None)
    assert M.get_feature_importance(df, ["a", "b"], "score", 1).count() == 1


def test_flags_hybrid_score_and_sample(spark, matrix):
    scored = spark.createDataFrame([("T1", 70), ("T2", 40)], "transaction_id string, final_risk_score int")
    ml = spark.createDataFrame(
        [("T1", -1, 0.5), ("T2", 1, 0.25), ("T9", -1, 0.9)],
        "transaction_id string, ml_prediction int, ml_anomaly_score double",
    )
    flags = {r[0]: r["ml_flagged"] for r in M.with_ml_flag(scored, ml).collect()}
    assert flags == {"T1": True, "T2": False}
    hybrid = {r[0]: r["hybrid_score"] for r in M.with_hybrid_score(scored, ml).collect()}
    assert hybrid == {"T1": 75.0, "T2": 42.5}
    picked = sorted(r[0] for r in M.sample_rows(matrix, 50).collect())
    assert len(picked) == 50 == len(set(picked))
    assert picked == sorted(r[0] for r in M.sample_rows(matrix.repartition(3), 50).collect())


def test_models_survive_storage(spark, matrix, forest, tmp_path):
    model, scores = forest
    kmeans = M.fit_kmeans(matrix, NAMES, n_clusters=2, restarts=1)
    saved = model_store.Models(M.fit_scaler(matrix, NAMES), model, kmeans)
    model_store.save_models(spark, saved, str(tmp_path / "m"))
    loaded = model_store.load_models(spark, str(tmp_path / "m"))
    assert loaded.scaler == saved.scaler
    assert loaded.forest.threshold == model.threshold
    assert loaded.forest.score(matrix).exceptAll(scores).count() == 0
    assert loaded.kmeans.centers.tolist() == kmeans.centers.tolist()
    assert (loaded.kmeans.names, loaded.kmeans.cost) == (kmeans.names, kmeans.cost)
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        nothing = model_store.load_models(spark, str(tmp_path / "none"))
    assert nothing == model_store.Models() and len(seen) >= 3


@pytest.mark.parametrize("n", [0, 1, 50])
def test_few_rows_still_get_the_flag(make_tx, n):
    from ledgerlens.plans import detection as D

    tx = make_tx([(f"T{i:02d}", f"U{i % 3}", i, 20000.0 + i) for i in range(n)])
    got = D.run_detection(tx, use_ml=True)
    assert "ml_flagged" in got.columns and got.count() == n
    assert got.filter("ml_flagged is null").count() == 0


def test_saved_models_score_as_before(spark, matrix, forest, tmp_path):
    model, _ = forest
    clusters = M.fit_kmeans(matrix, NAMES, 3, restarts=1)
    model_store.save_models(spark, model_store.Models(forest=model, kmeans=clusters), str(tmp_path / "m"))
    loaded = model_store.load_models(spark, str(tmp_path / "m"))
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(loaded.forest.predict(matrix)) == key(model.predict(matrix))
    assert loaded.kmeans.centers.tolist() == clusters.centers.tolist()


def test_scaler_and_importance_are_one_pass_without_sql_aggregates(spark, monkeypatch):
    rows = [(float(i), None if i % 7 == 0 else float(i * i % 11), 0.1, float(3 * i % 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double, s double").repartition(5)
    wanted = df.selectExpr(
        *[f"avg({n})" for n in "abc"], *[f"stddev_pop({n})" for n in "abc"],
        "abs(covar_pop(a, s) / (stddev_pop(a) * stddev_pop(s)))", "abs(covar_pop(b, s) / (stddev_pop(b) * stddev_pop(s)))",
    ).first()
    monkeypatch.setattr(M.F, "stddev_pop", None)
    scaler = M.fit_scaler(df, ["a", "b", "c"])
    assert [*scaler.means, *scaler.deviations] == pytest.approx(list(wanted)[:6])
    assert scaler.deviations[2] == 0
    found = {r["feature"]: r["importance"] for r in M.get_feature_importance(df, ["a", "b", "c"], "s").collect()}
    assert [found["a"], found["b"]] == pytest.approx(list(wanted)[6:]) and found["c"] is None


def test_kmeans_blocks_are_compressed_without_loss():
    x = np.column_stack([np.arange(4096.0) % 24, np.repeat(np.linspace(0, 1, 64), 64), np.random.default_rng(1).normal(size=4096)])
    block = clustering._pressed(x)
    assert len(block) < x.nbytes / 2 and (clustering._points(block, 3) == x).all()


def test_kmeans_holds_few_blocks_of_a_partition_at_a_time(spark, monkeypatch):
    df = spark.range(60_000, numPartitions=1).selectExpr(
        "concat('T', id) as transaction_id", *[f"rand({i}) as c{i}" for i in range(4)])
    unpack, scan, kept = clustering._points, clustering._pass, []

    def stored():
        return {i.id(): (i.memSize(), i.diskSize()) for i in spark.sparkContext._jsc.sc().getRDDStorageInfo() if i.isCached()}

    def watched(block, width):
        import gc

        lists = [x for x in gc.get_objects() if type(x) is list]
        assert not any(sum(type(b) is bytes and len(b) > 50_000 for b in x) > 4 for x in lists)
        return unpack(block, width)

    def looked_at(blocks, centers, move):
        kept.extend(sizes for i, sizes in stored().items() if i not in before)
        return scan(blocks, centers, move)

    before = stored()

    monkeypatch.setattr(clustering, "_points", watched)
    monkeypatch.setattr(clustering, "_pass", looked_at)
    model = M.fit_kmeans(df, [f"c{i}" for i in range(4)], 2, restarts=2, max_iterations=2)
    assert model.centers.shape == (2, 4) and 0 < model.cost < 60_000
    assert kept and all(memory == 0 and disk > 60_000 * 4 * 8 / 2 for memory, disk in kept)
    assert stored().keys() <= before.keys()


def test_draws_take_no_number_as_the_greatest():
    nan = (math.nan, 1, b"b")
    assert clustering._faster(nan, (9.0, 5, b"a")) is nan and clustering._faster((9.0, 5, b"a"), nan) is nan
    assert clustering._faster((2.0, 1, b"b"), (2.0, 3, b"a")) == (2.0, 3, b"a")


def test_leaves_are_handed_down_to_the_lowest_level():
    feature = np.array([[0, -1, 1, 0, 0, -1, -1]])
    forest = M.IsolationForest(["a", "b"], 4, feature, np.zeros((1, 7)), np.array([[0, 5.0, 0, 0, 0, 2.0, 3.0]]), 0.1)
    assert forest._complete()[2][0, 3:].tolist() == [5.0, 5.0, 2.0, 3.0]


def test_covariances_come_from_one_pass(spark):
    from ledgerlens.plans.catalog import covariances

    x = np.random.default_rng(3).normal(size=(300, 3)) * [1, 5, 0] + [1e6, -3, 2]
    df = spark.createDataFrame([(row.tolist(),) for row in x], "c array<double>").repartition(7)
    assert np.allclose(covariances(df, "c", 3), np.cov(x.T), atol=1e-6)
