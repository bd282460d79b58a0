import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions import quantiles
from ledgerlens.functions.hot_keys import find_hot_keys, only_hot, without_hot
from ledgerlens.functions.numbering import number_rows
from ledgerlens.functions.pieces import LEAD_IN, PIECE, with_lead_in, with_piece
from ledgerlens.functions.quantiles import exact_quantile, exact_quantiles
from ledgerlens.functions.sampling import lowest_hashes


def test_hot_keys_are_split_off(spark):
    df = spark.createDataFrame([("a",)] * 9 + [("b",)] * 2 + [(None,)] * 9, "user_id string")
    hot = find_hot_keys(df, limit=5)
    assert [r[0] for r in hot.keys.collect()] == ["a"] and hot.rows == 9
    assert not find_hot_keys(df, limit=9)
    assert only_hot(df, hot).count() == 9
    assert without_hot(df, hot).count() == 11  # rows without a key stay


@pytest.mark.parametrize("pieces", [1, 3, 40, 400])
def test_windows_over_pieces_equal_whole_windows(spark, pieces):
    rng = random.Random(pieces)
    rows = [(rng.choice("aaab"), rng.randrange(300), i, rng.random()) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, t int, id int, v double")
    keys, order = ["k"], ["t", "id"]

    def add(d, by):
        w = Window.partitionBy(*by).orderBy(*order)
        return d.withColumn("prev", F.lag("v").over(w)).withColumn(
            "n", F.count("v").over(w.rowsBetween(-9, 0))
        ).withColumn("m", F.max("v").over(w.rowsBetween(-9, 0)))

    # With 400 pieces, a window reaches over several of them.
    placed = with_piece(df, keys, order, pieces)
    assert placed.select(PIECE).distinct().count() > 0.8 * pieces
    split = add(with_lead_in(placed, keys, order, 9), [*keys, PIECE]).filter(~F.col(LEAD_IN))
    result = lambda d: {r["id"]: (r["prev"], r["n"], r["m"]) for r in d.collect()}
    assert result(split) == result(add(df, keys))
    assert split.count() == 2000


@pytest.mark.parametrize("accuracy", [100, 400, 100_000])
def test_exact_quantiles_match_numpy(spark, accuracy):
    rng = random.Random(accuracy)
    groups = {
        "ties": [rng.choice([1.0, 2.0, 2.0, 9.5]) for _ in range(400)],
        "wide": [rng.gauss(0, 1e6) for _ in range(999)],
        "one": [3.25],
        "same": [7.0] * 300,
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("wide", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0, 0.05, 0.25, 0.5, 0.75, 0.95, 1]
    got = {r["g"]: r["quantiles"] for r in exact_quantiles(df, "v", probs, ["g"], accuracy).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert np.allclose(got[g], np.quantile(vs, probs), rtol=1e-12)
    everything = [v for vs in groups.values() for v in vs]
    assert np.isclose(exact_quantile(df, "v", 0.9, accuracy), np.quantile(everything, 0.9))


def test_quantile_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    assert exact_quantile(df, "v", 0.5) is None


def test_rows_are_numbered_in_order(spark):
    df = spark.range(5000).select(F.format_string("k%05d", 4999 - F.col("id")).alias("k"))
    got = number_rows(df.repartition(7), ["k"], "n", start=10).orderBy("k").collect()
    assert [r["n"] for r in got] == list(range(10, 5010))


def test_hash_sample_is_exact_and_repeatable(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    plain = df.orderBy(F.md5(F.concat("k", F.lit(":42"))), "k").limit(100)
    ids = lambda d: sorted(r["k"] for r in d.collect())
    assert ids(lowest_hashes(df, "k", 100, 42)) == ids(plain)
    assert ids(lowest_hashes(df, "k", 100, 42)) == ids(lowest_hashes(df.repartition(9), "k", 100, 42))
    assert lowest_hashes(df, "k", 5000, 42).count() == 3000
    assert lowest_hashes(df.limit(0), "k", 5, 42).count() == 0
    same = df.withColumn("k", F.lit("x"))
    assert lowest_hashes(same, "k", 10, 42).count() == 10


@pytest.fixture
def spread(spark):
    rng = np.random.default_rng(3)
    groups = {"many": rng.normal(size=4000), "ties": rng.integers(0, 5, 3000).astype(float),
              "steep": np.exp(rng.normal(size=2500) * 20), None: rng.random(700), "one": np.array([2.5])}
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    return groups, spark.createDataFrame(rows, "g string, v double").repartition(6)


PROBS = [0.0, 0.05, 0.5, 0.95, 1.0]


def _same_as_numpy(groups, df, accuracy):
    got = {r["g"]: r["quantiles"] for r in exact_quantiles(df, "v", PROBS, ["g"], accuracy).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert np.allclose(got[g], np.quantile(values, PROBS), rtol=1e-12)
    everything = np.concatenate(list(groups.values()))
    assert np.allclose(exact_quantiles(df, "v", PROBS, accuracy=accuracy).first()["quantiles"],
                       np.quantile(everything, PROBS), rtol=1e-12)


def test_pieces_stay_at_one_size_while_rows_grow(spark):
    largest = []
    for n in (3_000, 30_000):
        # One key has nine tenths of the rows, and its times repeat.
        df = spark.range(n).selectExpr(
            "if(id % 10 = 0, concat('k', id % 100), 'hot') as k", "pmod(hash(id), 500) as t", "id")
        hot = find_hot_keys(df, "k", limit=500, piece_rows=300)
        placed = with_piece(only_hot(df, hot), ["k"], ["t", "id"], -(-hot.rows // hot.piece_rows))
        sizes = [r["count"] for r in placed.groupBy(PIECE).count().collect()]
        assert sum(sizes) == n * 9 // 10 and abs(len(sizes) - n * 9 // 3_000) <= 1
        largest.append(max(sizes))
        borders = with_lead_in(placed, ["k"], ["t", "id"], 29).filter(LEAD_IN).groupBy(PIECE).count().collect()
        assert len(borders) == len(sizes) - 1 and {r["count"] for r in borders} == {29}
    assert max(largest) <= 2 * 300


def test_brackets_that_miss_their_rank_are_widened(spread, monkeypatch):
    groups, df = spread
    missed = []
    look = quantiles._missed
    monkeypatch.setattr(quantiles, "_missed", lambda *a: missed.append(look(*a).count()) or look(*a))
    # No reach and a rough estimate: the bracket is one value beside the rank.
    monkeypatch.setattr(quantiles, "REACH", 0)
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda c, shares, a: F.array(*[F.max(c)] * len(shares)))
    _same_as_numpy(groups, df, 10)
    assert all(n >= 3 for n in missed) and len(missed) == 2


def test_large_brackets_are_narrowed(spread, monkeypatch):
    groups, df = spread
    rounds = []
    narrow = quantiles._narrowed

    def counting(counted, keys):
        rounds.append(counted.groupBy(*keys, "i").count().agg(F.max("count")).first()[0])
        return narrow(counted, keys)

    monkeypatch.setattr(quantiles, "_narrowed", counting)
    monkeypatch.setattr(quantiles, "SORTED", 40)
    monkeypatch.setattr(quantiles, "SLICES", 8)
    _same_as_numpy(groups, df, 100_000)
    # A round leaves about two of eight slices of the values.
    assert rounds[:2] == [4000, 550] and all(b < 0.3 * a for a, b in zip(rounds, rounds[1:]))


def test_numbered_rows_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    rows = spark.range(1000).selectExpr("cast(id as string) as k").repartition(4).mapInPandas(count, "k string")
    numbered = number_rows(rows, ["k"], "nr")
    assert [r["k"] for r in numbered.orderBy("nr").collect()] == sorted(map(str, range(1000)))
    assert made.value == 1000
