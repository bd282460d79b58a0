from datetime import datetime

import pytest

from ledgerlens.operators import reports as P
from ledgerlens.plans import detection as D
from ledgerlens.sources import exports
from ledgerlens.sources import transactions as IO


def test_csv_columns_are_typed_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "amount,transaction_id,timestamp,user_id,is_suspicious,extra,description\n"
        '12.5,T1,2024-01-02 03:04:05.000006,U1,True,e,"says ""hi"", twice"\n'
        "nan,T2,2024-01-02 03:04:05,U1,False,,\n"
        ",T3,,,,,\n"
    )
    rows = {r["transaction_id"]: r for r in
            IO.load_transactions(spark, str(tmp_path / "t.csv")).collect()}
    assert rows["T1"]["timestamp"] == datetime(2024, 1, 2, 3, 4, 5, 6)
    assert rows["T1"]["is_suspicious"] is True and rows["T1"]["amount"] == 12.5
    assert rows["T1"]["description"] == 'says "hi", twice'
    assert rows["T2"]["amount"] is None and rows["T2"]["timestamp"] == datetime(2024, 1, 2, 3, 4, 5)
    assert rows["T3"]["user_id"] is None and rows["T3"]["extra"] is None


def test_csv_round_trip_keeps_microseconds(spark, make_tx, tmp_path):
    tx = make_tx([("T1", "U", datetime(2024, 1, 1, 1, 1, 1, 123456), 0.1 + 0.2)])
    back = IO.load_transactions(spark, IO.write_csv(tx, str(tmp_path / "out")))
    assert back.collect() == tx.collect()


def test_calendar_and_load_stats(make_tx):
    from pyspark.sql import functions as F

    tx = make_tx([("T1", "U", 0, 1), ("T2", "V", 30, 2)]).withColumn("is_suspicious", F.lit(True))
    first = IO.with_calendar(tx).orderBy("transaction_id").first()
    assert (str(first["date"]), first["hour"], first["day_of_week"]) == ("2024-01-01", 0, 0)
    stats = IO.load_stats(tx).first()
    assert (stats["total_transactions"], stats["unique_users"], stats["labelled_percent"]) == (2, 2, 100.0)
    assert "labelled_percent" not in IO.load_stats(tx.drop("is_suspicious")).columns


def test_report_suite(spark, make_tx, tmp_path):
    tx = make_tx([(f"T{i}", f"U{i % 3}", i, 9000 + 3000 * i) for i in range(40)])
    scored = D.run_detection(tx)
    paths = exports.generate_all_reports(scored, tx, str(tmp_path), stamp="s")
    assert set(paths) == {"sheets", "csv", "compliance", "charts"}
    sheets = ["summary", "all_alerts", "high_risk_alerts", "top_risky_users", "rule_effectiveness"]
    sizes = {s: spark.read.parquet(f"{paths['sheets']}/{s}").count() for s in sheets}
    assert sizes["summary"] == 1 and sizes["all_alerts"] == scored.count()
    assert sizes["top_risky_users"] == 3
    exported = IO.read_csv(spark, paths["csv"])
    assert exported.columns == exports.EXPORT_COLUMNS and exported.count() == scored.count()
    assert spark.read.parquet(f"{paths['compliance']}/top_transactions").count() == 10
    assert spark.read.parquet(f"{paths['charts']}/score_histogram").count() == 30
    as_csv = exports.export_sheets(scored, tx, str(tmp_path / "c"), fmt="csv")
    assert IO.read_csv(spark, f"{as_csv}/summary").count() == 1


def test_export_takes_the_columns_present(make_tx):
    tx = make_tx([("T", "U", 0, 1)])
    assert exports.alert_export(tx).columns == [
        "transaction_id", "user_id", "amount", "timestamp", "transaction_type"]


def test_boxplot_numbers(spark):
    rows = [("HIGH", float(v)) for v in [1, 2, 3, 4, 5, 100]] + [("LOW", 7.0)]
    df = spark.createDataFrame(rows, "risk_level string, amount double")
    for accuracy in (100_000, 40):
        got = {r[0]: tuple(r)[1:] for r in P.amount_boxplot(df, accuracy).collect()}
        assert got == {"HIGH": (2.25, 3.5, 4.75, 1.0, 5.0, 1), "LOW": (7.0, 7.0, 7.0, 7.0, 7.0, 0)}


def test_line_breaks_inside_values(spark, tmp_path):
    texts = ["one\ntwo", "a\r\nb", "back\\slash", "\\n", "\\\\n\n", 'quo"te, comma', "plain", None, "\ue000", "\\\ue000n", "end\\", "\\\\", "\n\\\r\\n"]
    rows = [(f"T{i:02d}", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "transaction_id string, description string")
    with pytest.raises(Exception, match="line break"):
        IO.write_csv(df, str(tmp_path / "refused"))
    IO.write_csv(df, str(tmp_path / "escaped"), breaks="escape")
    got = IO.load_transactions(spark, str(tmp_path / "escaped"), escaped=True)
    assert sorted(map(tuple, got.collect())) == sorted(rows)
    IO.write_csv(df.coalesce(1), str(tmp_path / "kept"), breaks="keep")
    got = {r[0]: r[1] for r in IO.read_csv(spark, str(tmp_path / "kept"), multiline=True).collect()}
    assert got["T00"] == "one\ntwo" and len(got) == len(texts)


def test_every_table_of_the_suite_is_read_back(spark, make_tx, tmp_path):
    tx = make_tx([(f"T{i:02d}", f"U{i % 3}", i, 5000.0 * (1 + i % 4)) for i in range(60)])
    scored = D.score_transactions(tx)
    suite = exports.generate_all_reports(scored, tx, str(tmp_path), stamp="x")
    sheets = exports.report_sheets(scored, tx)
    for name, frame in sheets.items():
        back = spark.read.parquet(f"{suite['sheets']}/{name}")
        assert back.columns == frame.columns and back.count() == frame.count(), name
    assert IO.read_csv(spark, suite["csv"]).count() == scored.count()


def test_suite_reads_alerts_and_transactions_once(spark, make_tx, tmp_path):
    rows = [(f"T{i:02d}", f"U{i % 3}", i, 5000.0 * (1 + i % 4)) for i in range(60)]
    read = {name: spark.sparkContext.accumulator(0) for name in ("alerts", "tx")}

    def counted(df, name):
        def count(batches):
            for batch in batches:
                read[name].add(batch.num_rows)
                yield batch
        return df.mapInArrow(count, df.schema)

    tx = make_tx(rows)
    scored = D.score_transactions(tx)
    n = scored.count()
    paths = exports.generate_all_reports(counted(scored, "alerts"), counted(tx, "tx"), str(tmp_path), stamp="o")
    assert {name: a.value for name, a in read.items()} == {"alerts": n, "tx": len(rows)}
    for folder in (paths["sheets"], paths["compliance"]):
        assert spark.read.parquet(f"{folder}/summary").first()["flagged_transactions"] == n
