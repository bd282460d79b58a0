"""Registered queries against their SQL at the smallest scale."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerlens.functions.hot_keys import find_hot_keys
from ledgerlens.operators import evaluation as E
from ledgerlens.operators import features as X
from ledgerlens.operators import rules as R
from ledgerlens.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

RUN = [
    "combined_flags", "combined_flags_skewed", "scored_transactions_skewed", "alerts_upsert",
    "feature_matrix", "distance_outliers_split", "best_method", "amount_boxplot_split",
    "full_run", "stream_alert_sink", "stream_alert_sink_two_rules", "alert_store_changes",
    "alert_store_cleared", "given_forest_hybrid", "stored_forest", "stored_kmeans", "kmeans_cluster_sizes",
    "isolation_forest_flags", "method_comparison", "sampled_transactions", "amount_describe_split",
]
NO_SQL = {"pca_projection"}


def table(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    same = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted((tuple(repr(same(r[i])) for i in order) for r in rows))


def test_every_query_but_the_known_ones_has_sql():
    queries, sql = set(entry.queries()), set(entry.oracle_sql())
    assert sql <= queries and (queries & set(catalog.REGISTRY)) - sql == NO_SQL


def test_entry_returns_the_riskiest(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 10
    assert [r["final_risk_score"] for r in rows] == sorted(
        (r["final_risk_score"] for r in rows), reverse=True)


@pytest.mark.parametrize("name", RUN)
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for source in ("events", "orders"):
        duck.execute(f"create view {source} as select * from '{SF}/{source}.parquet'")
    want = duck.sql(entry.oracle_sql()[name])
    df = entry.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(want.columns)
    assert table(df.collect(), df.columns) == table(want.fetchall(), want.columns)


@pytest.mark.parametrize(
    "name", ["combined_flags_skewed", "summary_report", "risk_distribution", "score_histogram",
             "confusion_by_method", "high_risk_users", "distance_outliers", "distance_outliers_split",
             "amount_boxplot", "amount_boxplot_split"])
def test_plans_have_no_cross_product(spark, name):
    plan = catalog.REGISTRY[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|NestedLoop", plan)


def test_scans_read_only_the_needed_columns(spark):
    plan = catalog.REGISTRY["risk_distribution"](spark, SF)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in text and "props" not in text and "o_orderstatus" not in text


def test_pca_fit_looks_at_all_pairs(spark, monkeypatch):
    fit = catalog.M.apply_pca
    assert catalog.pca_fit(spark, SF).first()["uncorrelated"]

    def repeated(*args):
        # The third component is the first again; its neighbours are still uncorrelated with it.
        reduced, shares = fit(*args)
        swap = "transform(components, (x, i) -> if(i = 2, components[0], x))"
        return reduced.selectExpr("transaction_id", f"{swap} as components"), shares

    monkeypatch.setattr(catalog.M, "apply_pca", repeated)
    assert not catalog.pca_fit(spark, SF).first()["uncorrelated"]


def test_kmeans_fit_asks_for_the_nearest_centre(spark, monkeypatch):
    predict = catalog.M.predict_kmeans_outliers
    assert catalog.kmeans_fit(spark, SF).first()["centres_ok"]

    def one_elsewhere(*args):
        placed = predict(*args)
        least = placed.selectExpr("min(transaction_id)").first()[0]
        other = f"if(transaction_id = '{least}', (cluster + 1) % 5, cluster)"
        return placed.withColumn("cluster", catalog.F.expr(other).cast("int"))

    monkeypatch.setattr(catalog.M, "predict_kmeans_outliers", one_elsewhere)
    assert not catalog.kmeans_fit(spark, SF).first()["centres_ok"]


def test_methods_look_for_heavy_users_once(make_tx, monkeypatch, tmp_path):
    tx = make_tx([(f"T{i:02d}", f"U{i % 3}", i, 5000.0 * (1 + i % 4)) for i in range(60)])
    monkeypatch.setattr(catalog, "transactions", lambda spark, d: tx)
    searches = []
    for module in (catalog, R, X):
        monkeypatch.setattr(module, "find_hot_keys", lambda df: searches.append(df) or find_hot_keys(df))
    _, sets = catalog._methods(tx.sparkSession, str(tmp_path))
    assert len(searches) == 1
    assert {r[0] for r in sets[E.RULES].collect()} == {r["transaction_id"] for r in R.all_flags(tx).collect()}
