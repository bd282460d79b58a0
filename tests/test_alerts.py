from datetime import datetime, timedelta

import pytest

from ledgerlens.operators import alerts as A
from ledgerlens.sources import alert_store
from ledgerlens.sources.alert_store import AlertStore, Conflict

JAN = datetime(2024, 1, 1)
SCHEMA = (
    "transaction_id string, user_id string, amount double, transaction_type string, "
    "timestamp timestamp_ntz, rule_triggered string, final_risk_score int, risk_level string"
)


@pytest.fixture
def scored(spark):
    def build(*rows):
        full = [(t, u, a, "wire", JAN + timedelta(days=i), "HIGH_VALUE", s, l)
                for i, (t, u, a, s, l) in enumerate(rows)]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture
def smoke(scored):
    return scored(("T1", "U1", 15000.0, 78, "HIGH"), ("T2", "U2", 25000.0, 50, "MEDIUM"),
                  ("T3", "U1", 9500.0, 95, "CRITICAL"))


@pytest.fixture
def store(spark, tmp_path):
    return AlertStore(spark, str(tmp_path / "alerts"))


def by_id(df):
    return {r["transaction_id"]: r for r in df.collect()}


def test_insert_skips_known_transactions(store, smoke, scored):
    assert store.read().count() == 0
    assert store.store_alerts(smoke, created_at=JAN) == 3
    more = scored(("T3", "U9", 1.0, 1, "LOW"), ("T4", "U4", 5.0, 33, "MEDIUM"))
    assert store.store_alerts(more, created_at=JAN) == 1
    assert store.store_alerts(more, created_at=JAN) == 0
    rows = by_id(store.read())
    assert {t: r["alert_id"] for t, r in rows.items()} == {"T1": 1, "T2": 2, "T3": 3, "T4": 4}
    assert rows["T3"]["user_id"] == "U1" and rows["T3"]["status"] == "NEW"
    assert rows["T1"]["created_at"] == JAN and rows["T1"]["rules_triggered"] == "HIGH_VALUE"


def test_upsert_resets_reviews_and_gives_new_ids(store, smoke, scored):
    store.store_alerts(smoke, created_at=JAN)
    assert store.update_alert_status(1, "CLOSED", "ann", "fine", JAN)
    newer = scored(("T1", "U1", 1.0, 40, "MEDIUM"), ("T1", "U1", 2.0, 45, "MEDIUM"))
    assert store.store_alerts(newer, overwrite=True, created_at=JAN + timedelta(days=1)) == 1
    row = by_id(store.read())["T1"]
    assert (row["alert_id"], row["status"], row["reviewed_by"], row["notes"]) == (4, "NEW", None, None)
    assert row["amount"] == 2.0  # the last of repeated rows
    assert store.read().count() == 3


def test_rows_that_cannot_be_stored_are_skipped(store, spark):
    rows = [("T1", None, 1.0, "wire", JAN, "R", 1, "LOW"), (None, "U", 1.0, "wire", JAN, "R", 1, "LOW"),
            ("T2", "U", None, "wire", JAN, "R", 1, "LOW"), ("T3", "U", 1.0, None, JAN, "R", 1, "LOW")]
    assert store.store_alerts(spark.createDataFrame(rows, SCHEMA)) == 1
    assert set(by_id(store.read())) == {"T3"}


def test_first_of_repeated_rows_is_inserted(store, scored):
    store.store_alerts(scored(("T", "U", 1.0, 1, "LOW"), ("T", "U", 2.0, 2, "LOW")))
    assert by_id(store.read())["T"]["amount"] == 1.0


def test_status_update_overwrites_with_null(store, smoke):
    store.store_alerts(smoke, created_at=JAN)
    assert store.update_alert_status(2, "UNDER_REVIEW", "ann", "look", JAN)
    row = by_id(store.read())["T2"]
    assert (row["status"], row["reviewed_by"], row["reviewed_at"], row["notes"]) == (
        "UNDER_REVIEW", "ann", JAN, "look")
    assert store.update_alert_status(2, "CLOSED")
    row = by_id(store.read())["T2"]
    assert (row["status"], row["reviewed_by"], row["notes"]) == ("CLOSED", None, None)
    assert not store.update_alert_status(99, "CLOSED")


def test_many_status_updates_in_one_rewrite(store, smoke, spark):
    store.store_alerts(smoke)
    updates = spark.createDataFrame([(1, "CLOSED"), (3, "FALSE_POSITIVE"), (9, "CLOSED")],
                                    "alert_id int, status string")
    assert store.update_statuses(updates) == 2
    assert {t: r["status"] for t, r in by_id(store.read()).items()} == {
        "T1": "CLOSED", "T2": "NEW", "T3": "FALSE_POSITIVE"}


def test_queries(store, smoke, scored):
    store.store_alerts(smoke, created_at=JAN)
    store.store_alerts(scored(("T4", "U1", 1.0, 78, "HIGH")), created_at=JAN + timedelta(days=9))
    ids = lambda df: [r["transaction_id"] for r in df.collect()]
    assert ids(store.get_alerts()) == ["T3", "T4", "T1", "T2"]
    assert ids(store.get_alerts(risk_level="HIGH")) == ["T4", "T1"]
    assert ids(store.get_alerts(user_id="U1", limit=2)) == ["T3", "T4"]
    assert ids(store.get_alerts(status="CLOSED")) == []
    assert len(ids(store.get_alerts(risk_level="", limit=0))) == 4
    stats = store.get_alert_statistics(as_of=JAN + timedelta(days=10))
    assert tuple(stats["totals"].first()) == (4, 1)
    assert {r[0]: r[1] for r in stats["risk_distribution"].collect()} == {
        "HIGH": 2, "MEDIUM": 1, "CRITICAL": 1}
    assert [tuple(r) for r in stats["status_distribution"].collect()] == [("NEW", 4)]
    assert [tuple(r) for r in stats["top_users"].collect()] == [("U1", 3, 24501.0), ("U2", 1, 25000.0)]


def test_delete_and_clear_never_reuse_ids(store, smoke, scored):
    store.store_alerts(smoke)
    assert store.delete_alert(3) and not store.delete_alert(3)
    assert set(by_id(store.read())) == {"T1", "T2"}
    store.store_alerts(scored(("T5", "U5", 1.0, 1, "LOW")))
    assert by_id(store.read())["T5"]["alert_id"] == 4
    assert store.clear_all_alerts() == 0 and store.read().count() == 3
    assert store.clear_all_alerts(confirm=True) == 3 and store.read().count() == 0
    store.store_alerts(scored(("T6", "U6", 1.0, 1, "LOW")))
    assert by_id(store.read())["T6"]["alert_id"] == 5


def test_rows_without_a_commit_are_ignored(store, smoke, monkeypatch):
    store.store_alerts(smoke)

    def die(self, number, entry):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(AlertStore, "_claim", die)
        with pytest.raises(RuntimeError):
            store.update_alert_status(1, "CLOSED")
    assert {r["status"] for r in store.read().collect()} == {"NEW"}
    assert store.update_alert_status(2, "CLOSED") and store._next_id() == 4


def test_reopening_keeps_the_table(store, smoke, spark):
    store.store_alerts(smoke)
    assert AlertStore(spark, store.path).read().count() == 3


def test_transforms_without_a_store(spark, smoke):
    none = spark.createDataFrame([], A.ALERT_SCHEMA)
    first = A.insert_ignore(none, smoke, JAN)
    assert first.schema == A.ALERT_SCHEMA
    again = A.upsert(first, smoke.filter("transaction_id = 'T1'"), JAN)
    assert {t: r["alert_id"] for t, r in by_id(again).items()} == {"T1": 4, "T2": 2, "T3": 3}
    assert A.delete_alerts(again, again.filter("alert_id = 4")).count() == 2


def rows_written(store):
    return [store.spark.read.parquet(store._commit(n).path).count() for n in store._numbers()]


def test_one_review_writes_one_row_and_compacting_keeps_the_table(store, smoke):
    store.store_alerts(smoke, created_at=JAN)
    assert store.update_alert_status(2, "CLOSED", "ann", "ok", JAN)
    assert store.delete_alert(3)
    assert rows_written(store) == [0, 3, 1, 1]
    before = sorted(store.read().collect())
    assert [(r["alert_id"], r["status"]) for r in before] == [(1, "NEW"), (2, "CLOSED")]
    store.compact()
    assert sorted(store.read().collect()) == before and len(store._log()) == 1
    assert store.store_alerts(smoke, created_at=JAN) == 1
    assert by_id(store.read())["T3"]["alert_id"] == 4


def test_overwrite_replaces_only_given_rows(store, smoke, scored):
    store.store_alerts(smoke, created_at=JAN)
    store.update_alert_status(1, "CLOSED", "ann")
    assert store.store_alerts(scored(("T1", "U1", 1.0, 99, "CRITICAL")), True, JAN) == 1
    rows = by_id(store.read())
    assert (rows["T1"]["alert_id"], rows["T1"]["status"], rows["T1"]["risk_score"]) == (4, "NEW", 99)
    assert rows["T2"]["alert_id"] == 2 and len(rows) == 3
    assert rows_written(store)[-1] == 2  # the new row and the end of the old one


def test_rescoring_keeps_ids_and_reviews(store, smoke, scored):
    store.store_alerts(smoke, created_at=JAN)
    store.update_alert_status(2, "CLOSED", "ann")
    assert store.rescore(scored(("T9", "U", 1.0, 10, "LOW"), ("T2", "U2", 25000.0, 70, "HIGH")), JAN, "s.1") == 2
    row = by_id(store.read())["T2"]
    assert (row["alert_id"], row["status"], row["risk_score"], row["risk_level"]) == (2, "CLOSED", 70, "HIGH")
    assert by_id(store.read())["T9"]["alert_id"] == 4
    assert store.applied("s.1") and not store.applied("s.2")
    assert store.rescore(scored(("T2", "U2", 25000.0, 70, "HIGH")), JAN) == 0


def test_two_writers_lose_nothing(spark, store, smoke, scored, monkeypatch):
    store.store_alerts(smoke, created_at=JAN)
    other, write, tries = AlertStore(spark, store.path), AlertStore._write, []

    def overtaken(self, log, *rest):
        if self is store:
            tries.append(log[-1].number)
            if len(tries) == 1:  # the other writer commits in between
                assert other.store_alerts(scored(("T8", "U8", 1.0, 1, "LOW")), created_at=JAN) == 1
                assert other.update_alert_status(1, "CLOSED", "bob", None, JAN)
        write(self, log, *rest)

    monkeypatch.setattr(AlertStore, "_write", overtaken)
    assert store.store_alerts(scored(("T9", "U9", 1.0, 1, "LOW"), ("T8", "U8", 1.0, 1, "LOW")), created_at=JAN) == 1
    rows = by_id(store.read())
    assert {t: r["alert_id"] for t, r in rows.items()} == {"T1": 1, "T2": 2, "T3": 3, "T8": 4, "T9": 5}
    assert rows["T1"]["status"] == "CLOSED" and len(tries) == 2
    with pytest.raises(Conflict):
        store._claim(store._numbers()[-1], "{}")


def test_reading_does_not_shuffle_the_untouched_rows(store, smoke, scored):
    store.store_alerts(smoke, created_at=JAN)
    store.update_alert_status(2, "CLOSED", "ann")
    store.store_alerts(scored(("T9", "U", 1.0, 10, "LOW")), created_at=JAN)
    plan = store.read()._jdf.queryExecution().executedPlan().toString()
    rest, changed = plan.split("BroadcastHashJoin", 1)[1].split("max_by", 1)
    # The only exchanges are that of the changed ids, broadcast, and of the changed rows, grouped.
    assert "LeftAnti" in rest and "Exchange hashpartitioning" not in rest
    assert plan.count("Exchange hashpartitioning") == 1


def test_many_changes_are_compacted_by_themselves(store, smoke, monkeypatch):
    monkeypatch.setattr(alert_store, "COMPACT_AFTER", 4)
    store.store_alerts(smoke, created_at=JAN)
    for k in range(7):
        store.update_alert_status(1 + k % 3, f"S{k}", "ann")
        assert len(store._log()) <= 4
    assert {r["alert_id"]: r["status"] for r in store.read().collect()} == {1: "S6", 2: "S4", 3: "S5"}
    assert store.applied("x.-1") and not store.applied("x.0")
