"""Rules against plain loops, on both the ordinary and the hot-user route."""

import random
from datetime import timedelta

import pytest
from conftest import START

from ledgerlens.functions.hot_keys import HotKeys, find_hot_keys
from ledgerlens.operators import rules as R
from ledgerlens.operators import scoring as S
from ledgerlens.sources.transactions import normalise

NO_HOT = HotKeys("user_id", 10**9)


def tiers(k, base, steps):
    for bound, points in steps:
        if k >= bound:
            base = points
    return base


def loop_burst(rows, n, window, base, steps, keep=lambda a: True):
    """First burst per user; rows are (id, user, time, amount)."""
    found = {}
    for user in {r[1] for r in rows if r[1] is not None}:
        mine = [r for r in rows if r[1] == user and r[2] is not None
                and r[3] is not None and keep(r[3])]
        for t in sorted(r[2] for r in mine):
            inside = [r for r in mine if t - window <= r[2] <= t]
            if len(inside) >= n:
                found.update({r[0]: tiers(len(inside), base, steps) for r in inside})
                break
    return found


def loop_dormant(rows, days, m):
    found = {}
    for user in {r[1] for r in rows if r[1] is not None}:
        mine = sorted((r for r in rows if r[1] == user and r[2]), key=lambda r: (r[2], r[0]))
        for i in range(1, len(mine)):
            gap = mine[i][2] - mine[i - 1][2]
            if gap > timedelta(days=days) and len(mine) - i >= m:
                for r in mine[i : i + m]:
                    found.setdefault(r[0], 50 if gap.days > 180 else 35)
    return found


def scores(df):
    return {r["transaction_id"]: r["risk_score"] for r in df.collect()}


def random_rows(seed, users=4, rows=120, span_hours=2000):
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        user = rng.choice([f"U{u}" for u in range(users)] + ["U0", None])
        when = START + timedelta(hours=rng.choice([rng.randrange(span_hours), rng.randrange(40)]))
        if rng.random() < 0.3:
            when += timedelta(days=rng.choice([0, 100, 400]))
        amount = rng.choice([9000, 9500, 9999, 9999.5, 10000, 5000, 3000, 12.5, 60000, 123456])
        out.append((f"T{i:03d}", user, when if rng.random() > 0.03 else None, amount))
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("route", ["ordinary", "hot"])
def test_rules_equal_loops(make_tx, seed, route):
    rows = random_rows(seed)
    tx = make_tx(rows)
    hot = NO_HOT if route == "ordinary" else find_hot_keys(tx, limit=3)
    assert bool(hot) == (route == "hot")
    day = timedelta(days=1)
    got = R.detect_velocity_anomalies(tx, 12, 4, hot=hot)
    assert scores(got) == loop_burst(rows, 4, day / 2, 30, [(15, 40), (20, 50)])
    got = R.detect_structuring(tx, time_window_days=3, min_transactions=2, hot=hot)
    assert scores(got) == loop_burst(
        rows, 2, 3 * day, 40, [(5, 50), (10, 70)], lambda a: 9000 <= a <= 9999
    )
    got = R.detect_round_number_pattern(tx, time_window_days=2, hot=hot)
    assert scores(got) == loop_burst(rows, 3, 2 * day, 30, [(6, 45)], lambda a: a % 1000 == 0)
    got = R.detect_dormant_account_activity(tx, 20, 3, hot=hot)
    assert scores(got) == loop_dormant(rows, 20, 3)


@pytest.mark.parametrize("seed", range(2))
def test_one_pass_equals_separate_rules(make_tx, seed):
    tx = make_tx(random_rows(seed + 50))
    settings = R.RuleSettings(
        velocity_hours=12, velocity_transactions=4, structuring_transactions=2,
        dormant_days=20, dormant_transactions=3, round_days=2,
    )
    key = lambda df: sorted(
        (r["transaction_id"], r["rule_triggered"], r["risk_score"]) for r in df.collect()
    )
    hot = find_hot_keys(tx, limit=3)
    separate = R.run_all_rules(tx, settings, NO_HOT)
    union = sorted(x for df in separate.values() for x in key(df))
    assert key(R.all_flags(tx, settings, NO_HOT)) == union
    assert key(R.all_flags(tx, settings, hot)) == union
    combined = S.calculate_cumulative_scores(S.combine_rule_results(separate))
    columns = ["transaction_id", "rule_triggered", "risk_score", "final_risk_score", "risk_level"]
    flat = lambda df: sorted(tuple(r) for r in df.select(columns).collect())
    assert flat(S.score_flags(R.wide_flags(tx, settings, hot))) == flat(combined)
    assert flat(S.score_flags(R.raw_flags(tx, settings, NO_HOT))) == flat(combined)


@pytest.mark.parametrize("limit", [None, 2])
def test_tiers_come_from_ties(make_tx, limit):
    """Only rows tied on the completing time lift a burst above its base."""
    for size, score in [(10, 30), (15, 40), (20, 50)]:
        tx = make_tx([(f"T{i:02d}", "U", 5, 10) for i in range(size)])
        hot = find_hot_keys(tx, limit=limit) if limit else NO_HOT
        assert set(scores(R.detect_velocity_anomalies(tx, hot=hot)).values()) == {score}
        assert len(scores(R.detect_velocity_anomalies(tx, hot=hot))) == size
    for size, score in [(3, 40), (5, 50), (10, 70)]:
        tx = make_tx([(f"T{i:02d}", "U", 5, 9500) for i in range(size)])
        hot = find_hot_keys(tx, limit=limit) if limit else NO_HOT
        assert set(scores(R.detect_structuring(tx, hot=hot)).values()) == {score}
    for size, score in [(3, 30), (6, 45)]:
        tx = make_tx([(f"T{i:02d}", "U", 5, 7000) for i in range(size)])
        hot = find_hot_keys(tx, limit=limit) if limit else NO_HOT
        assert set(scores(R.detect_round_number_pattern(tx, hot=hot)).values()) == {score}


def test_window_is_closed_and_only_the_first_burst_counts(make_tx):
    at = [0, 6, 24, 200, 201, 202]
    tx = make_tx([(f"T{i}", "U", h, 1) for i, h in enumerate(at)])
    assert set(scores(R.detect_velocity_anomalies(tx, 24, 3))) == {"T0", "T1", "T2"}
    late = make_tx([(f"T{i}", "U", h + (0.001 if i == 2 else 0), 1) for i, h in enumerate(at)])
    assert set(scores(R.detect_velocity_anomalies(late, 24, 3))) == {"T3", "T4", "T5"}


def test_high_value_boundaries_and_duplicates(make_tx):
    amounts = [10000, 10000.01, 50000, 50000.01, 100000, 100000.01, None]
    tx = make_tx([(f"T{i}", None, 0, a) for i, a in enumerate(amounts)])
    assert scores(R.detect_high_value_transactions(tx)) == {
        "T1": 30, "T2": 30, "T3": 50, "T4": 50, "T5": 70,
    }
    twice = make_tx([("T", "U", 0, 20000), ("T", "U", 1, 20000)])
    assert R.detect_high_value_transactions(twice).count() == 2
    row = S.score_flags(R.wide_flags(twice)).first()
    assert (row["risk_score"], row["final_risk_score"], row["rules_triggered_count"]) == (60, 60, 1)


def test_smoke_values(make_tx):
    tx = make_tx([("T1", "U1", 0, 5000), ("T2", "U1", 24, 15000), ("T3", "U2", 48, 25000),
                  ("T4", "U2", 72, 8000)])
    assert scores(R.detect_high_value_transactions(tx, 10000)) == {"T2": 30, "T3": 30}


def test_amount_gap_between_rules(make_tx):
    """Amounts in (9999, 10000] trip neither the amount nor structuring rule."""
    tx = make_tx([(f"T{i}", "U", i, a) for i, a in enumerate([9999.5, 9999.99, 10000])])
    assert R.all_flags(tx).count() == 0
    edge = make_tx([(f"T{i}", "U", i, a) for i, a in enumerate([9000, 9999, 9500])])
    assert len(scores(R.detect_structuring(edge))) == 3


@pytest.mark.parametrize("limit", [None, 2])
def test_dormant_gap_rules(make_tx, limit):
    def run(gap_hours, after=5):
        rows = [("A", "U", 0, 1)]
        rows += [(f"B{i}", "U", gap_hours + i, 1) for i in range(after)]
        tx = make_tx(rows)
        hot = find_hot_keys(tx, limit=limit) if limit else NO_HOT
        return scores(R.detect_dormant_account_activity(tx, hot=hot))

    day = 24
    assert run(90 * day) == {}
    assert set(run(90 * day + 1).values()) == {35}
    assert set(run(180 * day + 12).values()) == {35}  # whole days decide
    assert set(run(181 * day).values()) == {50}
    assert run(100 * day, after=4) == {}


@pytest.mark.parametrize("limit", [None, 2])
def test_overlapping_gaps_keep_the_earliest_score(make_tx, limit):
    day = 24
    at = [0, 200 * day, 201 * day, 301 * day, 302 * day, 303 * day, 304 * day, 305 * day]
    tx = make_tx([(f"T{i}", "U", h, 1) for i, h in enumerate(at)])
    hot = find_hot_keys(tx, limit=limit) if limit else NO_HOT
    got = scores(R.detect_dormant_account_activity(tx, hot=hot))
    assert got == {"T1": 50, "T2": 50, "T3": 50, "T4": 50, "T5": 50, "T6": 35, "T7": 35}


def test_custom_round_amounts(make_tx):
    tx = make_tx([(f"T{i}", "U", i, 1234) for i in range(3)])
    assert R.detect_round_number_pattern(tx).count() == 0
    assert R.detect_round_number_pattern(tx, [1234]).count() == 3


def test_repeated_ids_are_flagged_once(make_tx):
    tx = make_tx([("X", "U1", 0, 1), ("X", "U1", 1, 1), ("Y", "U1", 2, 1)])
    got = R.detect_velocity_anomalies(tx, 24, 3)
    assert sorted(r["transaction_id"] for r in got.collect()) == ["X", "Y"]


def test_empty_result_keeps_its_columns(make_tx):
    tx = make_tx([("T", "U", 0, 1)])
    for df in R.run_all_rules(tx).values():
        assert df.columns == [*tx.columns, "rule_triggered", "risk_score"]
        assert df.count() == 0


def test_nan_amounts_do_not_trip_rules(spark):
    tx = normalise(
        spark.createDataFrame(
            [("T", "U", START, float("nan"), "x")],
            "transaction_id string, user_id string, timestamp timestamp, amount double, "
            "transaction_type string",
        )
    )
    assert dict(tx.dtypes)["timestamp"] == "timestamp_ntz"
    assert R.raw_flags(tx).count() == 0


def test_one_user_shuffle_for_all_rules(make_tx):
    tx = make_tx(random_rows(1))
    plan = R.wide_flags(tx, hot=NO_HOT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(user_id") == 1
    assert plan.count("Sort [user_id") == 1


def test_hot_users_never_share_a_window_partition(make_tx):
    """On the hot route every window works on slots, times or ranked rows."""
    tx = make_tx([(f"T{i:04d}", "U", i * 0.01, 9500) for i in range(2000)])
    hot = find_hot_keys(tx, limit=100)
    flags = R.all_flags(tx, hot=hot)
    assert {r["rule_triggered"]: r["n"] for r in
            flags.groupBy("rule_triggered").count().withColumnRenamed("count", "n").collect()} == {
        "VELOCITY": 10, "STRUCTURING": 3,
    }
    plan = R.wide_flags(tx, hot=hot)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_keys_alone_need_no_kept_rows(make_tx):
    rows = [(f"T{i % 3}", "U", i % 3, 6000) for i in range(12)] + [(None, "U", 1, 6000)] * 2
    flags = R.all_flags(make_tx(rows), hot=NO_HOT)
    ids = flags.select("transaction_id").distinct()
    assert {r[0] for r in ids.collect()} == {r["transaction_id"] for r in flags.collect()}
    assert "min_by" not in ids._jdf.queryExecution().optimizedPlan().toString()
