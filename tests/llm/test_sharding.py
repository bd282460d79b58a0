import zlib
from itertools import product

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.llm import sharding


def test_curve_visits_every_cell_and_moves_one_step():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(product(range(1 << bits), repeat=dims)))
        index = sharding.hilbert_index([cells[:, i] for i in range(dims)], bits)
        assert sorted(index) == list(range(len(cells)))
        path = cells[np.argsort(index)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check(docs, shards):
    rows = sharding.shard_documents(docs, shards).collect()
    given = docs.select("doc_id", "text").collect()
    want = sorted((str(d), 16 + len((t or "").encode()), zlib.crc32((t or "").encode())) for d, t in given)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == want
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert not rows or max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    runs = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in runs] == sorted(r["curve"] for r in rows)


def test_runs_are_whole_even_and_in_curve_order(odd_docs, make_docs):
    check(odd_docs, 7)
    check(odd_docs.unionAll(odd_docs), 100)
    check(make_docs(["same"] * 50), 3)
    check(make_docs([]), 4)
    check(make_docs(["a", None], [None, None]), 2)


def test_files_prune_on_every_dimension(spark):
    docs = spark.range(4096).selectExpr(
        "id as doc_id", "'t' as text", "concat('s', lpad(id div 64, 2, '0')) as source",
        "concat('l', lpad(id % 64, 2, '0')) as lang")
    placed = sharding.shard_documents(docs, 16, ("source", "lang")).join(docs.select("doc_id", "source", "lang"), "doc_id")
    spread = placed.groupBy("shard").agg({"source": "count"}).collect()
    assert [r[1] for r in spread] == [256] * 16
    for column in ("source", "lang"):
        per = placed.groupBy("shard").agg(F.count_distinct(column)).collect()
        assert max(r[1] for r in per) <= 32  # of 64 values


def test_files_prune_on_strings_with_a_common_beginning(spark):
    docs = spark.range(4096).selectExpr(
        "id as doc_id", "'t' as text", "concat('https://www.', lpad(id div 64, 2, '0')) as source",
        "concat('common_crawl_', lpad(id % 64, 2, '0')) as lang")
    placed = sharding.shard_documents(docs, 16, ("source", "lang")).join(docs.select("doc_id", "source", "lang"), "doc_id")
    for column in ("source", "lang"):
        per = placed.groupBy("shard").agg(F.count_distinct(column)).collect()
        assert max(r[1] for r in per) <= 32  # of 64 values


def test_limits_of_strings_are_quantiles(spark):
    rows = [(f"https://{i * i % 1009:05d}",) for i in range(3000)] + [("https://00004",)] * 500 + [(None,), ("",), ("\u00e9\U0001f600",)]
    df = spark.createDataFrame(rows, "s string").repartition(5)
    shares = [i / 64 for i in range(1, 64)]
    found = sharding.text_limits(df, [sharding.ordinal(df, "s")] * 2, shares, len(rows))
    given = sorted(b"" if r[0] is None else b"\1" + r[0].encode() for r in rows)
    want = [given[int(np.ceil(s * len(rows))) - 1] for s in shares]
    assert [list(f) for f in found] == [want, want]


def test_shards_are_written_whole(odd_docs, tmp_path, spark):
    docs = odd_docs.drop("shard", "size").where("doc_id is not null")
    placed = sharding.shard_documents(docs, 5)
    sharding.write_shards(docs, placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count()
    assert back.select("shard").distinct().count() == 5
