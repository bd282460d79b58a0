"""Features against pandas, on both routes."""

import random
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import START

from ledgerlens.functions.hot_keys import HotKeys, find_hot_keys
from ledgerlens.operators import features as X

NO_HOT = HotKeys("user_id", 10**9)


def expected(pdf):
    pdf = pdf.dropna(subset=["user_id"])
    pdf = pdf.sort_values(["user_id", "timestamp", "transaction_id"]).reset_index(drop=True)
    by = pdf.groupby("user_id")
    out = pdf[["transaction_id", "amount"]].copy()
    hour, weekday = pdf.timestamp.dt.hour, pdf.timestamp.dt.dayofweek
    out["hour"], out["day_of_week"] = hour, weekday
    out["amount_log"] = np.log1p(pdf.amount)
    out["is_round_1000"] = pdf.amount % 1000 == 0
    out["is_round_5000"] = pdf.amount % 5000 == 0
    out["amount_bin"] = np.digitize(pdf.amount, [100, 500, 1000, 5000, 10000, 50000], right=True)
    out["hour_sin"], out["hour_cos"] = np.sin(2 * np.pi * hour / 24), np.cos(2 * np.pi * hour / 24)
    out["is_weekend"], out["day_of_month"] = weekday >= 5, pdf.timestamp.dt.day
    out["is_business_hours"] = hour.between(9, 17) & (weekday < 5)
    out["is_late_night"] = (hour >= 23) | (hour <= 5)
    mean, std = by.amount.transform("mean"), by.amount.transform("std").fillna(0)
    out["user_avg_amount"], out["user_std_amount"] = mean, std
    out["user_median_amount"] = by.amount.transform("median")
    out["user_min_amount"] = by.amount.transform("min")
    out["user_max_amount"] = by.amount.transform("max")
    out["user_amount_count"] = by.amount.transform("count")
    out["user_total_transactions"] = by.transaction_id.transform("count")
    out["amount_vs_user_avg"] = pdf.amount / (mean + 1)
    out["amount_diff_from_avg"] = pdf.amount - mean
    out["amount_zscore"] = ((pdf.amount - mean) / std.where(std > 0)).fillna(0)
    roll = lambda n, how: by.amount.transform(lambda s: getattr(s.rolling(n, min_periods=1), how)())
    out["rolling_7d_avg"] = roll(7, "mean")
    out["rolling_7d_std"] = roll(7, "std").fillna(0)
    out["rolling_30d_avg"] = roll(30, "mean")
    out["recent_trans_count"] = np.minimum(by.cumcount() + 1, 7)
    out["amount_vs_rolling_7d"] = pdf.amount / (out.rolling_7d_avg + 1)
    out["amount_vs_rolling_30d"] = pdf.amount / (out.rolling_30d_avg + 1)
    out["dist_from_10k"] = (pdf.amount - 10000).abs()
    out["near_10k_threshold"] = out.dist_from_10k < 1000
    out["in_structuring_range"] = pdf.amount.between(9000, 9999)
    out["has_decimals"] = pdf.amount % 1 != 0
    out["hours_since_last"] = by.timestamp.diff().dt.total_seconds().fillna(0) / 3600
    out["days_since_last"] = out.hours_since_last / 24
    out["is_rapid_succession"] = out.hours_since_last < 1
    out["is_dormant_reactivation"] = out.days_since_last > 90
    return out.set_index("transaction_id").astype(float).fillna(0).sort_index()


def rows(seed):
    rng = random.Random(seed)
    out = [("solo", "only", START, 100.0)]
    for i in range(400):
        user = rng.choice(["A", "A", "A", "B", "C", None])
        when = START + timedelta(minutes=rng.randrange(60 * 24 * 400)) if i % 40 else None
        amount = rng.choice([9000, 9999, 9999.5, 100, 500, 5000, 10000, 50000.01, 3.5])
        out.append((f"T{i:03d}", user, when, amount + rng.randrange(3)))
    return out


@pytest.mark.parametrize("limit", [None, 20, 100])
def test_matrix_equals_pandas(make_tx, limit):
    data = rows(7)
    tx = make_tx(data)
    hot = find_hot_keys(tx, limit=limit) if limit else NO_HOT
    got = X.prepare_for_ml(tx, hot).toPandas().set_index("transaction_id").sort_index()
    assert list(got.columns) == X.FEATURE_COLUMNS and len(X.FEATURE_COLUMNS) == 37
    want = expected(pd.DataFrame(data, columns=["transaction_id", "user_id", "timestamp", "amount"]))
    assert list(got.index) == list(want.index)
    for name in X.FEATURE_COLUMNS:
        assert np.allclose(got[name], want[name], rtol=1e-7, atol=1e-6), name


def test_copies_of_one_transaction_are_split_too(make_tx):
    data = [("same", "U", 5, 10)] * 300 + [(f"T{i:02d}", "U", i, i + 1) for i in range(40)]
    tx = make_tx(data)
    flat = lambda df: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                             for r in df.collect())
    assert flat(X.prepare_for_ml(tx, find_hot_keys(tx, limit=50))) == flat(
        X.prepare_for_ml(tx, NO_HOT))


def test_right_closed_bins_and_missing_amounts(make_tx):
    values = [100, 100.01, 500, 1000, 5000, 10000, 50000, 50001, 0, None]
    tx = make_tx([(f"T{i}", "U", i, v) for i, v in enumerate(values)])
    got = [r["amount_bin"] for r in X.add_basic_features(tx).orderBy("transaction_id").collect()]
    assert got == [0, 1, 1, 2, 3, 4, 5, 6, None, None]
    matrix = X.prepare_for_ml(tx)
    assert [r["amount_bin"] for r in matrix.orderBy("transaction_id").collect()][-2:] == [0.0, 0.0]


def test_first_row_counts_as_rapid(make_tx):
    row = X.add_frequency_features(make_tx([("T", "U", 0, 1)])).first()
    assert (row["hours_since_last"], row["is_rapid_succession"]) == (0.0, 1)
    assert row["time_since_last"] is None


def test_type_codes(make_tx):
    tx = make_tx([("a", "U", 0, 1, "wire"), ("b", "U", 1, 1, "atm"), ("c", "U", 2, 1, None)])
    got = {r["transaction_id"]: r["trans_type_encoded"] for r in X.add_type_codes(tx).collect()}
    assert got == {"a": 1, "b": 0, "c": -1}
    bare = tx.drop("transaction_type")
    assert X.add_type_codes(bare).columns == bare.columns


def test_many_types_are_coded(make_tx):
    tx = make_tx([(f"T{i}", "U", i, 1, f"k{9 - i}") for i in range(10)])
    got = {r["transaction_type"]: r["trans_type_encoded"] for r in X.add_type_codes(tx).collect()}
    assert got == {f"k{i}": i for i in range(10)}


def test_all_features_use_one_user_shuffle(make_tx):
    df = X.create_all_features(make_tx(rows(1)), NO_HOT, type_codes=False)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(user_id") == 1
