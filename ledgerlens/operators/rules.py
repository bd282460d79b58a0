"""The five detection rules.

Every rule returns its flagged rows with ``rule_triggered`` and ``risk_score``.
The per-user rules need each user's rows in time order (ties by transaction
id).  Ordinary users go through one shuffle on ``user_id``; a user with more
than ``hot_rows`` rows takes a route that only groups pre-aggregated or
limited rows, so no task ever receives such a user whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from ledgerlens.functions.hot_keys import HotKeys, by_weight, find_hot_keys
from ledgerlens.settings import materialised

HIGH_VALUE = "HIGH_VALUE"
VELOCITY = "VELOCITY"
STRUCTURING = "STRUCTURING"
DORMANT = "DORMANT_REACTIVATION"
ROUND_NUMBERS = "ROUND_NUMBERS"

#: Order in which rule results are combined; decides what "first" means.
RULE_ORDER = [HIGH_VALUE, VELOCITY, STRUCTURING, DORMANT, ROUND_NUMBERS]

# Base score of each rule and its higher tiers as
# (lower bound, score) in ascending order.
HIGH_VALUE_SCORES = (30, [(50_000, 50), (100_000, 70)])
VELOCITY_SCORES = (30, [(15, 40), (20, 50)])
STRUCTURING_SCORES = (40, [(5, 50), (10, 70)])
DORMANT_SCORES = (35, [(180, 50)])
ROUND_SCORES = (30, [(6, 45)])
ROUND_AMOUNTS = (5000, 10000, 15000, 20000, 25000)
ROUND_UNIT = 1000

_DAY_MICROS = 86_400_000_000
_FLAG = ["rule_triggered", "risk_score"]


@dataclass(frozen=True)
class RuleSettings:
    """Thresholds of all five rules."""

    high_value_threshold: float = 10_000
    velocity_hours: float = 24
    velocity_transactions: int = 10
    structuring_min: float = 9_000
    structuring_max: float = 9_999
    structuring_days: float = 7
    structuring_transactions: int = 3
    dormant_days: float = 90
    dormant_transactions: int = 5
    round_amounts: Sequence[float] = ROUND_AMOUNTS
    round_days: float = 30
    round_occurrences: int = 3


@dataclass(frozen=True)
class Burst:
    """``rows`` qualifying rows of one user within a closed trailing window.

    Only a user's first burst counts: it ends at the earliest time that
    completes one, and every qualifying row in that window is flagged.
    """

    rule: str
    qualifies: Column
    rows: int
    window: timedelta
    scores: tuple[int, list[tuple[int, int]]]

    def score(self, size: Column) -> Column:
        return _tiered(size, self.scores, inclusive=True)


def _by_user() -> WindowSpec:
    return Window.partitionBy("user_id")


def _in_order() -> WindowSpec:
    return _by_user().orderBy("timestamp", "transaction_id")


def _tiered(measure: Column, scores, inclusive: bool) -> Column:
    base, tiers = scores
    result = F.lit(base)
    for bound, points in tiers:
        reached = measure >= bound if inclusive else measure > bound
        result = F.when(reached, points).otherwise(result)
    return result


def _velocity_burst(s: RuleSettings) -> Burst:
    return Burst(
        VELOCITY, F.lit(True), s.velocity_transactions,
        timedelta(hours=s.velocity_hours), VELOCITY_SCORES,
    )


def _structuring_burst(s: RuleSettings) -> Burst:
    return Burst(
        STRUCTURING, F.col("amount").between(s.structuring_min, s.structuring_max),
        s.structuring_transactions, timedelta(days=s.structuring_days), STRUCTURING_SCORES,
    )


def _round_burst(s: RuleSettings) -> Burst:
    amount = F.col("amount")
    return Burst(
        ROUND_NUMBERS, amount.isin(*map(float, s.round_amounts)) | (amount % ROUND_UNIT == 0),
        s.round_occurrences, timedelta(days=s.round_days), ROUND_SCORES,
    )


def _high_value_score(threshold: float) -> Column:
    amount = F.col("amount")
    return F.when(amount > threshold, _tiered(amount, HIGH_VALUE_SCORES, inclusive=False))


def _timed(df: DataFrame) -> DataFrame:
    """Rows the per-user rules can place: a user and a time are known."""
    return df.filter(F.col("user_id").isNotNull() & F.col("timestamp").isNotNull())


def _flagged(df: DataFrame, rule: str, score: str) -> DataFrame:
    return (
        df.filter(F.col(score).isNotNull())
        .withColumn("rule_triggered", F.lit(rule))
        .withColumn("risk_score", F.col(score))
    )


def keep_first(flagged: DataFrame) -> DataFrame:
    """One row per transaction id: the first by user and time.

    An aggregate rather than a ranked window, so copies of one id combine
    before the shuffle.  The keys are not part of the kept row: a caller that
    wants nothing else neither sorts nor moves the other columns.
    """
    order = F.struct("user_id", "timestamp", "amount", "transaction_type")
    keys = ["transaction_id", "rule_triggered"]
    first = F.min_by(F.struct(*[c for c in flagged.columns if c not in keys]), order)
    kept = flagged.groupBy(*keys).agg(first.alias("kept"))
    return kept.select(*[c if c in keys else f"kept.{c}" for c in flagged.columns])


# --- ordinary users: windows over one user_id shuffle -----------------------


def _with_bursts(df: DataFrame, bursts: list[Burst]) -> DataFrame:
    """Add one score column per burst, named after its rule.

    A row completes a burst when the qualifying row ``rows - 1`` places back
    is still inside the window.  ``lag ... ignore nulls`` finds that row in
    the shared sort order although other rows lie between.
    """
    time = F.col("timestamp")
    df = df.withColumns({f"_{b.rule}_time": F.when(b.qualifies, time) for b in bursts})
    df = df.withColumns(
        {
            f"_{b.rule}_back": F.expr(
                f"lag(_{b.rule}_time, {b.rows - 1}) ignore nulls over "
                "(partition by user_id order by timestamp, transaction_id)"
            )
            if b.rows > 1
            else F.col(f"_{b.rule}_time")
            for b in bursts
        }
    )
    df = df.withColumns(
        {
            f"_{b.rule}_end": F.min(
                F.when(F.col(f"_{b.rule}_back") >= F.col(f"_{b.rule}_time") - F.lit(b.window), time)
            ).over(_by_user())
            for b in bursts
        }
    )
    df = df.withColumns(
        {
            f"_{b.rule}_in": F.col(f"_{b.rule}_time").between(
                F.col(f"_{b.rule}_end") - F.lit(b.window), F.col(f"_{b.rule}_end")
            )
            for b in bursts
        }
    )
    df = df.withColumns(
        {f"_{b.rule}_size": F.count_if(f"_{b.rule}_in").over(_by_user()) for b in bursts}
    )
    return df.withColumns(
        {b.rule: F.when(F.col(f"_{b.rule}_in"), b.score(F.col(f"_{b.rule}_size"))) for b in bursts}
    )


def _with_dormant(df: DataFrame, days: float, rows: int) -> DataFrame:
    """Add the dormant score: the gap row and the ``rows - 1`` rows after it,
    if that many exist; the earliest covering gap decides the score."""
    time = F.col("timestamp")
    last_needed = F.lead(time, rows - 1).over(_in_order()) if rows > 1 else time
    df = df.withColumns(
        {"_gap": time - F.lag(time).over(_in_order()), "_last_needed": last_needed}
    )
    opens = (F.col("_gap") > F.lit(timedelta(days=days))) & F.col("_last_needed").isNotNull()
    df = df.withColumn("_gap_days", F.when(opens, F.expr("extract(DAY FROM _gap)")))
    covering = F.first("_gap_days", ignorenulls=True).over(_in_order().rowsBetween(1 - rows, 0))
    df = df.withColumn("_dormant_days", covering)
    return df.withColumn(
        DORMANT,
        F.when(
            F.col("_dormant_days").isNotNull(),
            _tiered(F.col("_dormant_days"), DORMANT_SCORES, inclusive=False),
        ),
    )


# --- hot users: aggregates that combine before they shuffle -----------------


def _slot(time: str, width: int) -> Column:
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {time})")
    return micros - F.pmod(micros, F.lit(width))


def _hot_burst(df: DataFrame, burst: Burst) -> DataFrame:
    """First bursts of hot users.

    Times are cut into slots as wide as the window.  A slot holding ``rows``
    rows completes a burst by its ``rows``-th one, so no later row of the slot
    can matter to the burst's end: the ``rows`` smallest distinct times per
    slot suffice, and per user that is bounded by the calendar, not the data.
    """
    rows = df.filter(burst.qualifies)
    width = max(1, int(burst.window.total_seconds() * 1_000_000))
    earliest = Window.partitionBy("user_id", "_slot").orderBy("timestamp")
    times = (
        rows.groupBy("user_id", "timestamp")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_slot", _slot("timestamp", width))
        .withColumn("_rank", F.row_number().over(earliest))
        .filter(F.col("_rank") <= burst.rows)
        .withColumn("_micros", _slot("timestamp", 1))
    )
    trailing = _by_user().orderBy("_micros").rangeBetween(
        -int(burst.window.total_seconds() * 1_000_000), 0
    )
    ends = (
        times.withColumn("_size", F.sum("_n").over(trailing))
        .filter(F.col("_size") >= burst.rows)
        .groupBy("user_id")
        .agg(F.min(F.struct("timestamp", "_size")).alias("_first"))
        .select("user_id", F.col("_first.timestamp").alias("_end"), "_first._size")
    )
    # One row per hot user at most: written, it is broadcast if its size allows.
    inside = F.col("timestamp").between(F.col("_end") - F.lit(burst.window), F.col("_end"))
    flagged = rows.join(materialised(ends, "burst-ends"), "user_id").filter(inside)
    return _flagged(
        flagged.withColumn("_score", burst.score(F.col("_size"))), burst.rule, "_score"
    ).select(*df.columns, *_FLAG)


def _hot_dormant(df: DataFrame, days: float, rows: int) -> DataFrame:
    """Dormant reactivations of hot users.

    Slots no wider than the dormant period cannot hide a gap, so the gaps show
    between the last and first times of neighbouring slots.  The ``rows`` rows
    after a gap lie within that many non-empty slots; the ranked filter limits
    them map-side.
    """
    period = timedelta(days=days)
    width = max(1, min(_DAY_MICROS, int(period.total_seconds() * 1_000_000)))
    by_slot = _by_user().orderBy("_slot")
    spans = (
        df.withColumn("_slot", _slot("timestamp", width))
        .groupBy("user_id", "_slot")
        .agg(F.min("timestamp").alias("_start"), F.max("timestamp").alias("_stop"))
        .withColumn("_gap", F.col("_start") - F.lag("_stop").over(by_slot))
        .withColumn(
            "_reach",
            F.coalesce(
                F.lead("_stop", rows - 1).over(by_slot) if rows > 1 else F.col("_stop"),
                F.max("_stop").over(_by_user()),
            ),
        )
    )
    # A gap reaches over ``rows`` spans at most, so each span lies in at most
    # that many gaps, and rows meet only the gaps of their own slot.
    gap = F.struct("_start", "_reach", F.expr("extract(DAY FROM _gap)").alias("_gap_days"))
    reached = F.collect_list(F.when(F.col("_gap") > F.lit(period), gap)).over(
        by_slot.rowsBetween(1 - rows, 0)
    )
    gaps = spans.select("user_id", "_slot", reached.alias("_gaps")).select(
        "user_id", "_slot", F.inline("_gaps")
    )
    after = Window.partitionBy("user_id", "_start").orderBy("timestamp", "transaction_id")
    followed = (
        df.withColumn("_slot", _slot("timestamp", width))
        .join(gaps, ["user_id", "_slot"])
        .filter(F.col("timestamp").between(F.col("_start"), F.col("_reach")))
        .withColumn("_rank", F.row_number().over(after))
        .filter(F.col("_rank") <= rows)
        .withColumn("_found", F.count(F.lit(1)).over(Window.partitionBy("user_id", "_start")))
        .filter(F.col("_found") == rows)
    )
    scored = followed.withColumn(
        "_score", _tiered(F.col("_gap_days"), DORMANT_SCORES, inclusive=False)
    )
    earliest = F.min_by(F.struct(*df.columns, "_score"), F.struct("_start", "_rank"))
    once = (
        scored.groupBy("user_id", "timestamp", "transaction_id", "amount")
        .agg(earliest.alias("kept"))
        .select("kept.*")
    )
    return _flagged(once, DORMANT, "_score").select(*df.columns, *_FLAG)


# --- public rules ------------------------------------------------------------


def detect_high_value_transactions(df: DataFrame, threshold: float = 10_000) -> DataFrame:
    """Amounts above ``threshold``; no shuffle."""
    scored = df.withColumn("_score", _high_value_score(threshold))
    return _flagged(scored, HIGH_VALUE, "_score").drop("_score")


def _detect_burst(df: DataFrame, burst: Burst, hot: HotKeys | None) -> DataFrame:
    rows = _timed(df).filter(burst.qualifies)
    hot = find_hot_keys(rows) if hot is None else hot

    def light(part: DataFrame) -> DataFrame:
        scored = _with_bursts(part, [burst])
        return _flagged(scored, burst.rule, burst.rule).select(*df.columns, *_FLAG)

    return keep_first(by_weight(rows, hot, light, lambda part: _hot_burst(part, burst)))


def detect_velocity_anomalies(
    df: DataFrame,
    time_window_hours: float = 24,
    transaction_threshold: int = 10,
    hot: HotKeys | None = None,
) -> DataFrame:
    """A user's first run of ``transaction_threshold`` rows within the window."""
    settings = RuleSettings(
        velocity_hours=time_window_hours, velocity_transactions=transaction_threshold
    )
    return _detect_burst(df, _velocity_burst(settings), hot)


def detect_structuring(
    df: DataFrame,
    min_amount: float = 9_000,
    max_amount: float = 9_999,
    time_window_days: float = 7,
    min_transactions: int = 3,
    hot: HotKeys | None = None,
) -> DataFrame:
    """First run of amounts just below the reporting limit."""
    settings = RuleSettings(
        structuring_min=min_amount,
        structuring_max=max_amount,
        structuring_days=time_window_days,
        structuring_transactions=min_transactions,
    )
    return _detect_burst(df, _structuring_burst(settings), hot)


def detect_dormant_account_activity(
    df: DataFrame,
    dormant_period_days: float = 90,
    reactivation_threshold: int = 5,
    hot: HotKeys | None = None,
) -> DataFrame:
    """The rows that reactivate an account after a long gap."""
    rows = _timed(df)
    hot = find_hot_keys(rows) if hot is None else hot

    def light(part: DataFrame) -> DataFrame:
        scored = _with_dormant(part, dormant_period_days, reactivation_threshold)
        return _flagged(scored, DORMANT, DORMANT).select(*df.columns, *_FLAG)

    def heavy(part: DataFrame) -> DataFrame:
        return _hot_dormant(part, dormant_period_days, reactivation_threshold)

    return keep_first(by_weight(rows, hot, light, heavy))


def detect_round_number_pattern(
    df: DataFrame,
    round_amounts: Sequence[float] = ROUND_AMOUNTS,
    time_window_days: float = 30,
    min_occurrences: int = 3,
    hot: HotKeys | None = None,
) -> DataFrame:
    """First run of round amounts."""
    settings = RuleSettings(
        round_amounts=round_amounts,
        round_days=time_window_days,
        round_occurrences=min_occurrences,
    )
    return _detect_burst(df, _round_burst(settings), hot)


def run_all_rules(
    df: DataFrame, settings: RuleSettings | None = None, hot: HotKeys | None = None
) -> dict[str, DataFrame]:
    """Each rule's flagged rows by name.  ``all_flags`` gives the same rows in
    one frame and one shuffle."""
    s = settings or RuleSettings()
    hot = find_hot_keys(_timed(df)) if hot is None else hot
    return {
        "high_value": detect_high_value_transactions(df, s.high_value_threshold),
        "velocity": _detect_burst(df, _velocity_burst(s), hot),
        "structuring": _detect_burst(df, _structuring_burst(s), hot),
        "dormant_account": detect_dormant_account_activity(
            df, s.dormant_days, s.dormant_transactions, hot
        ),
        "round_numbers": _detect_burst(df, _round_burst(s), hot),
    }


def wide_flags(
    df: DataFrame,
    settings: RuleSettings | None = None,
    hot: HotKeys | None = None,
    high_value: bool = True,
) -> DataFrame:
    """All rules in one pass: the flagged rows with one score column per rule,
    NULL where the rule does not apply.

    One ``user_id`` shuffle and one sort serve every rule.
    """
    s = settings or RuleSettings()
    bursts = [_velocity_burst(s), _structuring_burst(s), _round_burst(s)]
    timed = _timed(df)
    hot = find_hot_keys(timed) if hot is None else hot

    def light(part: DataFrame) -> DataFrame:
        score = _high_value_score(s.high_value_threshold) if high_value else F.lit(None).cast("int")
        part = _with_dormant(part, s.dormant_days, s.dormant_transactions)
        part = _with_bursts(part, bursts).withColumn(HIGH_VALUE, score)
        return part.filter(F.coalesce(*RULE_ORDER).isNotNull()).select(*df.columns, *RULE_ORDER)

    def heavy(part: DataFrame) -> DataFrame:
        parts = [_hot_burst(part, b) for b in bursts]
        parts.append(_hot_dormant(part, s.dormant_days, s.dormant_transactions))
        if high_value:
            parts.append(detect_high_value_transactions(part, s.high_value_threshold))
        return widen(reduce(DataFrame.unionByName, parts))

    flags = by_weight(timed, hot, light, heavy)
    if high_value:
        # Rows without a user or a time take part in the amount rule only and
        # never meet in one shuffle partition.
        loose = df.filter(F.col("user_id").isNull() | F.col("timestamp").isNull())
        flags = flags.unionByName(
            widen(detect_high_value_transactions(loose, s.high_value_threshold))
        )
    return flags


def widen(flags: DataFrame) -> DataFrame:
    """Long flags in the ``wide_flags`` layout, one rule filled per row."""
    rule = F.col("rule_triggered")
    return flags.select(
        *[c for c in flags.columns if c not in _FLAG],
        *[F.when(rule == r, F.col("risk_score")).alias(r) for r in RULE_ORDER],
    )


def raw_flags(
    df: DataFrame,
    settings: RuleSettings | None = None,
    hot: HotKeys | None = None,
    high_value: bool = True,
) -> DataFrame:
    """``wide_flags`` as one row per (transaction row, rule that hit it).

    Repeated transaction ids are still repeated here; see ``all_flags``.
    """
    hits = F.filter(
        F.array(
            *[
                F.struct(F.lit(r).alias("rule_triggered"), F.col(r).alias("risk_score"))
                for r in RULE_ORDER
            ]
        ),
        lambda hit: hit["risk_score"].isNotNull(),
    )
    return (
        wide_flags(df, settings, hot, high_value)
        .select(*df.columns, F.explode(hits).alias("hit"))
        .select(*df.columns, "hit.rule_triggered", "hit.risk_score")
    )


def all_flags(
    df: DataFrame, settings: RuleSettings | None = None, hot: HotKeys | None = None
) -> DataFrame:
    """Every rule's result in one frame, with each rule's own treatment of
    repeated ids: the amount rule keeps them all, the others the first."""
    s = settings or RuleSettings()
    per_user = keep_first(raw_flags(df, s, hot, high_value=False))
    return detect_high_value_transactions(df, s.high_value_threshold).unionByName(per_user)


def rule_counts(flags: DataFrame) -> DataFrame:
    """Flags per rule; a transaction counts once for every rule it triggers."""
    return flags.groupBy("rule_triggered").agg(F.count(F.lit(1)).alias("flag_count"))
