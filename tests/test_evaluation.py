import pytest

from ledgerlens.operators import evaluation as E
from ledgerlens.plans import detection as D


@pytest.fixture
def ids(spark):
    return lambda *names: spark.createDataFrame([(n,) for n in names], "transaction_id string")


@pytest.fixture
def labelled(spark):
    rows = [("a", True, "p"), ("b", True, "p"), ("c", True, "q"), ("d", False, None),
            ("e", None, None), ("e", False, None)]
    return spark.createDataFrame(
        rows, "transaction_id string, is_suspicious boolean, suspicious_pattern string"
    )


def test_confusion_counts(labelled, ids):
    methods = {"x": ids("a", "d", "e"), "none": ids("z").filter("false"),
               "all": ids("a", "b", "c")}
    got = {r["method"]: r for r in E.compare_with_ground_truth(labelled, methods).collect()}
    x = got["x"]
    assert (x["true_positives"], x["false_positives"], x["false_negatives"], x["true_negatives"]) == (1, 2, 2, 1)
    assert (x["flagged"], round(x["precision"], 6), round(x["recall"], 6)) == (3, 0.333333, 0.333333)
    assert x["accuracy"] == pytest.approx(2 / 6) and x["efficiency"] == x["precision"]
    none = got["none"]
    assert (none["precision"], none["recall"], none["f1_score"], none["true_negatives"]) == (0, 0, 0, 3)
    assert got["all"]["f1_score"] == 1.0


def test_missing_labels_give_nothing(labelled, ids):
    bare = labelled.select("transaction_id")
    assert E.compare_with_ground_truth(bare, {"x": ids("a")}) is None
    assert E.pattern_detection_rate(bare, ids("a")) is None


def test_pattern_rates(labelled, ids):
    got = {r[0]: tuple(r)[1:] for r in E.pattern_detection_rate(labelled, ids("a", "d")).collect()}
    assert got == {"p": (1, 2, 0.5), "q": (0, 1, 0.0)}


def test_hybrid_sets(ids):
    rules, ml = ids("a", "b", "c"), ids("c", "d")
    assert tuple(E.hybrid_overlap(rules, ml).first()) == (2, 1, 1, 4)
    assert sorted(r[0] for r in E.hybrid_ids(rules, ml).collect()) == ["a", "b", "c", "d"]
    assert [r[0] for r in E.intersection_ids(rules, ml).collect()] == ["c"]


def test_best_method_takes_the_first_of_ties(labelled, ids):
    best = lambda methods: {
        r["metric"]: r for r in
        E.best_methods(E.compare_with_ground_truth(labelled, methods)).collect()}
    tie = best({E.RULES: ids("a", "b", "c"), E.HYBRID: ids("a", "b", "c")})
    assert {r["method"] for r in tie.values()} == {E.RULES}
    assert {r["recommendation"] for r in tie.values()} == {"single_method"}
    hybrid = best({E.RULES: ids("a"), E.HYBRID: ids("a", "b", "c")})
    assert hybrid["f1_score"]["method"] == E.HYBRID
    assert hybrid["precision"]["method"] == E.RULES
    assert hybrid["recall"]["recommendation"] == "hybrid"
    assert best({E.RULES: ids("d")})["recall"]["recommendation"] == "tune"


def test_ml_flag_marks_the_unusual(make_tx):
    more = make_tx([(f"T{i:03d}", f"U{i % 3}", i * 7, 20000 + i if i else 900000) for i in range(150)])
    got = D.run_detection(more, use_ml=True)
    assert got.count() == 150
    assert 1 <= got.filter("ml_flagged").count() <= 10


def test_method_comparison_end_to_end(make_tx):
    from pyspark.sql import functions as F

    tx = make_tx([(f"T{i:03d}", f"U{i % 5}", i * 5, 50 + i if i % 40 else 70000) for i in range(300)])
    tx = tx.withColumn("is_suspicious", F.col("amount") > 10000)
    result = D.compare_methods(tx)
    metrics = {r["method"]: r for r in result.metrics.collect()}
    assert list(metrics) == [E.RULES, E.FOREST, E.KMEANS, E.HYBRID]
    assert metrics[E.HYBRID]["recall"] == 1.0
    assert metrics[E.FOREST]["flagged"] == 15
    overlap = result.overlap.first()
    assert overlap["total_flagged"] == metrics[E.HYBRID]["flagged"]
    assert result.best.count() == 3
