"""DuckDB SQL that states each registered query's expected result.

The SQL follows the definitions directly (range frames, self-contained common
table expressions) and shares nothing with the Spark plans.
"""

from __future__ import annotations

from ledgerlens.operators.features import FEATURE_COLUMNS
from ledgerlens.plans.oracle_models import CLUSTERS, FOREST, MATRIX

TX = """
tx as (
  select concat('E', cast(event_id as varchar)) as transaction_id,
         concat('E', cast(user_id as varchar)) as user_id,
         cast(ts as timestamp) as "timestamp",
         case when event_id % 5 = 0 then floor(value) * 100 + 100
              else round(value * 100) + cast(event_id % 100 as double) / 100 + 0.01
         end as amount,
         event_type as transaction_type,
         case when event_type = 'error' and value >= 90 then 'velocity'
              when event_type = 'purchase' and value >= 90 and value < 100 then 'structuring'
         end as suspicious_pattern
  from events
  union all
  select concat('O', cast(o_orderkey as varchar)), concat('C', cast(o_custkey as varchar)),
         cast(o_orderdate as timestamp), o_totalprice, o_orderpriority,
         case when o_orderpriority like '1-%' and o_totalprice > 400000 then 'high_value' end
  from orders
)"""


def _burst(name: str, rule: str, condition: str, n: int, window: str, score: str) -> str:
    return f"""
{name}_rows as (select * from tx where {condition}),
{name}_counts as (
  select *, count(*) over (partition by user_id order by "timestamp"
                           range between interval {window} preceding and current row) as k
  from {name}_rows
),
{name}_ends as (
  select user_id, min("timestamp") as t0 from {name}_counts where k >= {n} group by user_id
),
{name}_hits as (
  select r.*, count(*) over (partition by r.user_id) as k0
  from {name}_rows r join {name}_ends e on r.user_id = e.user_id
  where r."timestamp" between e.t0 - interval {window} and e.t0
),
{name} as (
  select transaction_id, user_id, "timestamp", amount, transaction_type,
         '{rule}' as rule_triggered, {score} as risk_score
  from {name}_hits
)"""


HIGH_VALUE = """
high_value as (
  select transaction_id, user_id, "timestamp", amount, transaction_type,
         'HIGH_VALUE' as rule_triggered,
         case when amount > 100000 then 70 when amount > 50000 then 50 else 30 end as risk_score
  from tx where amount > 10000
)"""
VELOCITY = _burst(
    "velocity", "VELOCITY", "true", 10, "24 hours",
    "case when k0 >= 20 then 50 when k0 >= 15 then 40 else 30 end",
)
STRUCTURING = _burst(
    "structuring", "STRUCTURING", "amount >= 9000 and amount <= 9999", 3, "7 days",
    "case when k0 >= 10 then 70 when k0 >= 5 then 50 else 40 end",
)
ROUND = _burst(
    "round_numbers", "ROUND_NUMBERS",
    "amount in (5000, 10000, 15000, 20000, 25000) or fmod(amount, 1000) = 0", 3, "30 days",
    "case when k0 >= 6 then 45 else 30 end",
)
DORMANT = """
placed as (
  select *, row_number() over w as rn, count(*) over (partition by user_id) as total,
         "timestamp" - lag("timestamp") over w as gap
  from tx window w as (partition by user_id order by "timestamp", transaction_id)
),
openings as (
  select user_id, rn, extract(day from gap) as gap_days from placed
  where gap > interval 90 days and rn + 4 <= total
),
dormant_rows as (
  select p.*, arg_min(o.gap_days, o.rn) as gap_days
  from placed p join openings o on p.user_id = o.user_id and p.rn between o.rn and o.rn + 4
  group by all
),
dormant as (
  select transaction_id, user_id, "timestamp", amount, transaction_type,
         'DORMANT_REACTIVATION' as rule_triggered,
         case when gap_days > 180 then 50 else 35 end as risk_score
  from dormant_rows
)"""
FLAGS = """
flags as (
  select * from high_value union all select * from velocity union all select * from structuring
  union all select * from dormant union all select * from round_numbers
),
weighted as (
  select *, risk_score * case rule_triggered
      when 'VELOCITY' then cast(1.2 as double) when 'STRUCTURING' then cast(1.5 as double)
      when 'DORMANT_REACTIVATION' then cast(1.1 as double)
      when 'ROUND_NUMBERS' then cast(0.9 as double) else cast(1.0 as double) end as weighted_score
  from flags
)"""


def _scored(name: str, source: str) -> str:
    return f"""
{name}_sums as (
  select transaction_id, any_value(user_id) as user_id, any_value(amount) as amount,
         any_value("timestamp") as "timestamp",
         any_value(transaction_type) as transaction_type,
         string_agg(distinct rule_triggered, ', ' order by rule_triggered) as rule_triggered,
         cast(sum(risk_score) as integer) as risk_score,
         round(sum(weighted_score), 6) as weighted_score,
         cast(least(round_even(sum(weighted_score), 0), 150) as integer) as final_risk_score,
         cast(count(distinct rule_triggered) as integer) as rules_triggered_count
  from {source} group by transaction_id
),
{name} as (
  select *, case when final_risk_score between 0 and 30 then 'LOW'
                 when final_risk_score between 31 and 60 then 'MEDIUM'
                 when final_risk_score between 61 and 90 then 'HIGH'
                 else 'CRITICAL' end as risk_level
  from {name}_sums
)"""


ALL_RULES = [TX, HIGH_VALUE, VELOCITY, STRUCTURING, ROUND, DORMANT, FLAGS]
SCORED = ALL_RULES + [_scored("scored", "weighted")]

_ALERT_COLUMNS = (
    'transaction_id, user_id, amount, transaction_type, "timestamp", '
    "rule_triggered as rules_triggered, final_risk_score as risk_score, risk_level"
)
_ALERT_REST = """, 'NEW' as status, cast('{at}' as timestamp) as created_at,
       cast(null as varchar) as reviewed_by, cast(null as timestamp) as reviewed_at,
       cast(null as varchar) as notes"""
FIRST_ALERTS = [
    _scored("first_scored", "(select *, risk_score * cast(1.0 as double) as weighted_score from high_value)"),
    f"""
first_alerts as (
  select row_number() over (order by transaction_id) as alert_id, {_ALERT_COLUMNS}
       {_ALERT_REST.format(at='2024-02-01')}
  from first_scored
)""",
]
ALL_ALERTS = SCORED + FIRST_ALERTS + [
    f"""
alerts as (
  select * from first_alerts
  union all
  select row_number() over (order by transaction_id) + (select max(alert_id) from first_alerts),
         {_ALERT_COLUMNS} {_ALERT_REST.format(at='2024-02-05')}
  from scored where transaction_id not in (select transaction_id from first_alerts)
)""",
    """
reviewed as (
  select * replace (
    case when risk_level = 'HIGH' then 'UNDER_REVIEW' else status end as status,
    case when risk_level = 'HIGH' then 'analyst' end as reviewed_by,
    case when risk_level = 'HIGH' then cast('2024-02-06' as timestamp) end as reviewed_at)
  from alerts
)""",
]

FEATURES = [
    TX,
    """
local_features as (
  select *, cast(hour("timestamp") as integer) as hour,
         cast(isodow("timestamp") - 1 as integer) as day_of_week,
         ln(1 + amount) as amount_log,
         cast(fmod(amount, 1000) = 0 as integer) as is_round_1000,
         cast(fmod(amount, 5000) = 0 as integer) as is_round_5000,
         case when amount <= 100 then 0 when amount <= 500 then 1 when amount <= 1000 then 2
              when amount <= 5000 then 3 when amount <= 10000 then 4 when amount <= 50000 then 5
              else 6 end as amount_bin,
         sin(2 * pi() * hour("timestamp") / 24) as hour_sin,
         cos(2 * pi() * hour("timestamp") / 24) as hour_cos,
         cast(isodow("timestamp") >= 6 as integer) as is_weekend,
         cast(day("timestamp") as integer) as day_of_month,
         cast(hour("timestamp") between 9 and 17 and isodow("timestamp") <= 5 as integer)
           as is_business_hours,
         cast(hour("timestamp") >= 23 or hour("timestamp") <= 5 as integer) as is_late_night,
         abs(amount - 10000) as dist_from_10k,
         cast(abs(amount - 10000) < 1000 as integer) as near_10k_threshold,
         cast(amount between 9000 and 9999 as integer) as in_structuring_range,
         cast(fmod(amount, 1) <> 0 as integer) as has_decimals
  from tx
)""",
    """
stats as (
  select user_id, avg(amount) as user_avg_amount,
         coalesce(stddev_samp(amount), 0) as user_std_amount,
         quantile_cont(amount, 0.5) as user_median_amount, min(amount) as user_min_amount,
         max(amount) as user_max_amount, count(amount) as user_amount_count,
         count(transaction_id) as user_total_transactions
  from tx group by user_id
),
user_features as (
  select l.*, s.* exclude (user_id), amount / (user_avg_amount + 1) as amount_vs_user_avg,
         amount - user_avg_amount as amount_diff_from_avg,
         case when user_std_amount > 0 then (amount - user_avg_amount) / user_std_amount else 0 end
           as amount_zscore
  from local_features l join stats s using (user_id)
),
rolled as (
  select *, avg(amount) over short as rolling_7d_avg,
         coalesce(stddev_samp(amount) over short, 0) as rolling_7d_std,
         avg(amount) over long as rolling_30d_avg,
         cast(count(*) over short as double) as recent_trans_count,
         coalesce(date_diff('microseconds', lag("timestamp") over seq, "timestamp")
                  / cast(3600000000 as double), 0) as hours_since_last
  from user_features
  window seq as (partition by user_id order by "timestamp", transaction_id),
         short as (partition by user_id order by "timestamp", transaction_id
                   rows between 6 preceding and current row),
         long as (partition by user_id order by "timestamp", transaction_id
                  rows between 29 preceding and current row)
),
features as (
  select *, amount / (rolling_7d_avg + 1) as amount_vs_rolling_7d,
         amount / (rolling_30d_avg + 1) as amount_vs_rolling_30d,
         hours_since_last / 24 as days_since_last,
         cast(hours_since_last < 1 as integer) as is_rapid_succession,
         cast(hours_since_last / 24 > 90 as integer) as is_dormant_reactivation
  from rolled
)""",
]

_STANDARD = ", ".join(
    f"coalesce((cast({c} as double) - avg({c}) over ()) / nullif(stddev_pop({c}) over (), 0), 0) as {c}"
    for c in FEATURE_COLUMNS
)
STANDARD = FEATURES + [f"\nstandard as (select transaction_id, {_STANDARD} from features)"]
_TO = lambda v: " + ".join(f"({c} - {v}) * ({c} - {v})" for c in FEATURE_COLUMNS)
DISTANCES = STANDARD + [
    f"""
squares as (select *, {_TO('0.0::double')} as d0, {_TO('1.0::double')} as d1 from standard),
distances as (
  select *, case when d0 <= d1 then 0 else 1 end as cluster,
         sqrt(least(d0, d1)) as distance_to_centroid
  from squares
),
outliers as (
  select *, distance_to_centroid > (select quantile_cont(distance_to_centroid, 0.95)
                                    from distances) as is_outlier
  from distances
)"""
]
_RATES = """
rates as (
  select *, tp + fp as flagged, n - tp - fp - fn as tn,
         coalesce(tp / nullif(tp + fp, 0), 0) as pr, coalesce(tp / nullif(tp + fn, 0), 0) as re
  from counts
),
confusion as (
  select method_order, method, tp as true_positives, fp as false_positives,
         fn as false_negatives, flagged, tn as true_negatives, pr as precision, re as recall,
         coalesce(2 * pr * re / nullif(pr + re, 0), 0) as f1_score, (tp + tn) / n as accuracy,
         coalesce(tp / nullif(flagged, 0), 0) as efficiency
  from rates
)"""
_COUNTS = """
counts as (
  select m.method_order, m.method,
         count(*) filter (where x.transaction_id is not null and t.transaction_id is not null) as tp,
         count(*) filter (where x.transaction_id is not null and t.transaction_id is null) as fp,
         count(*) filter (where x.transaction_id is null and t.transaction_id is not null) as fn,
         (select count(*) from tx) as n
  from names m
  cross join (select distinct transaction_id from tx) i
  left join members x on x.method = m.method and x.transaction_id = i.transaction_id
  left join truth t on t.transaction_id = i.transaction_id
  group by 1, 2
)"""
TRUTH = """
truth as (select distinct transaction_id from tx where suspicious_pattern is not null)"""
METHODS = ALL_RULES + DISTANCES[1:] + [
    TRUTH,
    """
members as (
  select distinct 'Rules-Based' as method, transaction_id from flags
  union all
  select 'K-Means Clustering', transaction_id from outliers where is_outlier
  union all
  select distinct 'Hybrid (Rules + ML)', transaction_id from (
    select transaction_id from flags
    union select transaction_id from outliers where is_outlier)
),
names as (
  select * from (values (0, 'Rules-Based'), (1, 'K-Means Clustering'), (2, 'Hybrid (Rules + ML)'))
    v(method_order, method)
)""",
    _COUNTS,
    _RATES,
]
FITTED = ALL_RULES + STANDARD[1:] + FOREST + [
    CLUSTERS,
    TRUTH,
    """
members as (
  select distinct 'Rules-Based' as method, transaction_id from flags
  union all
  select distinct 'Isolation Forest', transaction_id from forest where ml_prediction = -1
  union all
  select distinct 'K-Means Clustering', transaction_id from clustered where is_outlier
  union all
  select distinct 'Hybrid (Rules + ML)', transaction_id from (
    select transaction_id from flags
    union select transaction_id from forest where ml_prediction = -1)
),
names as (
  select * from (values (0, 'Rules-Based'), (1, 'Isolation Forest'), (2, 'K-Means Clustering'),
                        (3, 'Hybrid (Rules + ML)')) v(method_order, method)
)""",
    _COUNTS,
    _RATES,
]
DETECTED = SCORED + [
    TRUTH,
    """
members as (select 'Scored' as method, transaction_id from scored),
names as (select 0 as method_order, 'Scored' as method)""",
    _COUNTS,
    _RATES,
]

_FLAG_SELECT = 'transaction_id, user_id, "timestamp", amount, transaction_type, rule_triggered, risk_score'
_LEVELS = "(values ('LOW'), ('MEDIUM'), ('HIGH'), ('CRITICAL')) v(risk_level)"
_CONFUSION_SELECT = (
    "select method_order, method, true_positives, false_positives, false_negatives, flagged, "
    "true_negatives, round(precision, 6) as precision, round(recall, 6) as recall, "
    "round(f1_score, 6) as f1_score, round(accuracy, 6) as accuracy, "
    "round(efficiency, 6) as efficiency from confusion"
)


GIVEN_FOREST = """
given_scores as (
  select transaction_id, power(2.0, -(
      (case when amount <= 5000 then 2.0 else 6.0 end) + (case when hour <= 11 then 5.0 else 3.0 end)
      + (case when is_weekend <= 0 then 7.0 else 4.0 end)) / 3
      / (2 * (ln(255.0) + 0.5772156649015329) - 2 * 255.0 / 256)) as ml_anomaly_score
  from features
),
given as (
  select *, case when ml_anomaly_score > (select quantile_cont(ml_anomaly_score, 0.95) from given_scores)
                 then -1 else 1 end as ml_prediction from given_scores
)"""


def _with(parts: list[str], select: str) -> str:
    return "with " + ",".join(parts) + "\n" + select


def _recursive(parts: list[str], select: str) -> str:
    return "with recursive " + ",".join(parts) + "\n" + select


# Averages are compared in single precision, which has no decimal ties.
_AVERAGES = ["user_avg_amount", "amount_diff_from_avg", "rolling_7d_avg", "rolling_30d_avg"]


def _round4(
    columns: list[str], prefix: str = "transaction_id", averages: list[str] = _AVERAGES
) -> str:
    # Adding zero turns a rounded -0.0 into 0.0.
    return ", ".join(
        [prefix]
        + [
            f"cast({c} as float) as {c}" if c in averages
            else f"round(cast({c} as double), 4) + 0.0::double as {c}"
            for c in columns
        ]
    )


def _users(condition: str) -> str:
    return f"""
select user_id, count(transaction_id) as flagged_transaction_count,
       round(avg(final_risk_score), 4) as avg_risk_score, max(final_risk_score) as max_risk_score,
       cast(sum(final_risk_score) as bigint) as total_risk_score,
       round(sum(amount), 2) as total_amount,
       case when count(*) filter (where risk_level = 'CRITICAL')
                 >= count(*) filter (where risk_level = 'HIGH') then 'CRITICAL' else 'HIGH' end
         as primary_risk_level
from scored where {condition} group by user_id"""


_TOP_USERS = """
select user_id, count(*) as alert_count, round(avg(final_risk_score), 4) as avg_risk_score,
       max(final_risk_score) as max_risk_score, round(sum(amount), 2) as total_amount
from scored group by user_id"""
_COMBINATIONS = "select rule_triggered, count(*) as count from scored group by 1"
_PERCENTAGES = f"""
select v.risk_level, count(s.risk_level) as count,
       round(count(s.risk_level) * 100.0 / (select count(*) from scored), 4) as percentage
from {_LEVELS} left join scored s using (risk_level) group by 1"""
_RUN_SUMMARY = (
    "(select count(*) from tx) as processed, count(*) as flagged, "
    "round(sum(amount), 2) as flagged_amount, round(avg(final_risk_score), 4) as average_score, "
    "max(final_risk_score) as highest_score, count(distinct user_id) as users_to_review, "
    "(select count(*) from tx) - count(*) as clear, "
    "round(count(*) * 100.0 / (select count(*) from tx), 4) as flag_rate"
)
_TOP_TEN = "select * from scored order by final_risk_score desc, transaction_id limit 10"
_BOX = """
q as (select risk_level, quantile_cont(amount, 0.25) as q1, quantile_cont(amount, 0.5) as median,
             quantile_cont(amount, 0.75) as q3 from scored group by 1)"""
_BOX_SELECT = """
select risk_level, round(q1, 4) as q1, round(median, 4) as median, round(q3, 4) as q3,
       min(amount) filter (where inside) as whisker_low,
       max(amount) filter (where inside) as whisker_high,
       count(*) filter (where not inside) as outliers
from (select s.risk_level, s.amount, q1, median, q3,
             amount between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as inside
      from scored s join q using (risk_level))
group by risk_level, q1, median, q3"""
_DESCRIBE = """
select count(amount) as count, round(avg(amount), 4) as mean, round(stddev_samp(amount), 4) as std,
       min(amount) as min, max(amount) as max, round(quantile_cont(amount, 0.25), 4) as p25,
       round(quantile_cont(amount, 0.5), 4) as p50, round(quantile_cont(amount, 0.75), 4) as p75
from tx"""
_USER_SELECT = "select " + _round4(
    ["user_avg_amount", "user_std_amount", "user_median_amount", "user_min_amount",
     "user_max_amount", "amount_vs_user_avg", "amount_diff_from_avg", "amount_zscore"],
    "transaction_id, user_amount_count, user_total_transactions",
) + " from features"
_ROLLING_SELECT = "select " + _round4(
    ["rolling_7d_avg", "rolling_7d_std", "rolling_30d_avg", "recent_trans_count",
     "amount_vs_rolling_7d", "amount_vs_rolling_30d"]
) + " from features"
_FREQUENCY_SELECT = """
select transaction_id, round(hours_since_last, 6) as hours_since_last,
       round(days_since_last, 6) as days_since_last, is_rapid_succession, is_dormant_reactivation
from features"""
_OUTLIER_SELECT = """
select transaction_id, cluster, round(distance_to_centroid, 4) as distance_to_centroid, is_outlier
from outliers"""
_COMBINED_SELECT = f"select {_FLAG_SELECT}, round(weighted_score, 6) as weighted_score from weighted"


def oracle_sql() -> dict[str, str]:
    high_value = _with([TX, HIGH_VALUE], f"select {_FLAG_SELECT} from high_value")
    velocity = _with([TX, VELOCITY], f"select {_FLAG_SELECT} from velocity")
    scored = _with(SCORED, "select * from scored")
    combined = _with(ALL_RULES, _COMBINED_SELECT)
    standard = _with(STANDARD, f"select {_round4(FEATURE_COLUMNS, averages=[])} from standard")
    outliers = _with(DISTANCES, _OUTLIER_SELECT)
    user = _with(FEATURES, _USER_SELECT)
    rolling = _with(FEATURES, _ROLLING_SELECT)
    frequency = _with(FEATURES, _FREQUENCY_SELECT)
    box = _with(SCORED + [_BOX], _BOX_SELECT)
    describe = _with([TX], _DESCRIBE)
    percentages = _with(SCORED, _PERCENTAGES)
    top_ten = _with(SCORED, _TOP_TEN)
    statements = {
        "rule_high_value": high_value,
        "rule_velocity": velocity,
        "rule_structuring": _with([TX, STRUCTURING], f"select {_FLAG_SELECT} from structuring"),
        "rule_dormant": _with([TX, DORMANT], f"select {_FLAG_SELECT} from dormant"),
        "rule_round_numbers": _with([TX, ROUND], f"select {_FLAG_SELECT} from round_numbers"),
        "rule_counts": _with(
            ALL_RULES, "select rule_triggered, count(*) as flag_count from flags group by 1"
        ),
        "combined_flags": combined,
        "combined_flags_skewed": combined,
        "combined_totals": _with(
            ALL_RULES,
            "select count(*) as flag_records, count(distinct transaction_id) as unique_transactions "
            "from flags",
        ),
        "scored_transactions": scored,
        "scored_transactions_skewed": scored,
        "cumulative_scores": scored,
        "risk_distribution": _with(
            SCORED,
            f"select v.risk_level, count(s.risk_level) as count from {_LEVELS} "
            "left join scored s using (risk_level) group by 1",
        ),
        "top_risky": top_ten,
        "high_risk_users": _with(SCORED, _users("risk_level in ('HIGH', 'CRITICAL')")),
        "critical_risk_users": _with(SCORED, _users("risk_level = 'CRITICAL'")),
        "risk_report": _with(
            SCORED,
            "select count(*) as total_flagged, round(avg(final_risk_score), 4) as average_score, "
            "quantile_cont(cast(final_risk_score as double), 0.5) as median_score, "
            "max(final_risk_score) as max_score, count(distinct user_id) as users_flagged, "
            "round(sum(amount), 2) as total_flagged_amount from scored",
        ),
        "rule_combinations": _with(SCORED, _COMBINATIONS),
        "top_rule_combinations": _with(
            SCORED, _COMBINATIONS + " order by count desc, rule_triggered limit 5"
        ),
        "level_percentages": percentages,
        "alerts_insert_ignore": _with(ALL_ALERTS, "select * from alerts"),
        "alert_table_scan": _with(ALL_ALERTS, "select * from alerts"),
        "alerts_upsert": _with(
            ALL_ALERTS,
            "select * from first_alerts where transaction_id not in "
            "(select transaction_id from scored where risk_level = 'CRITICAL') union all "
            "select row_number() over (order by transaction_id) "
            f"+ (select max(alert_id) from first_alerts), {_ALERT_COLUMNS} "
            f"{_ALERT_REST.format(at='2024-02-05')} from scored where risk_level = 'CRITICAL'",
        ),
        "alerts_query": _with(
            ALL_ALERTS,
            "select * from alerts where risk_level = 'HIGH' and status = 'NEW' "
            "order by risk_score desc, created_at desc, transaction_id limit 100",
        ),
        "alert_stats_totals": _with(
            ALL_ALERTS,
            "select count(*) as total_alerts, count(*) filter (where created_at >= "
            "timestamp '2024-02-10' - interval 7 days) as recent_alerts_7d from alerts",
        ),
        "alert_stats_level": _with(
            ALL_ALERTS, "select risk_level, count(*) as count from alerts group by 1"
        ),
        "alert_stats_status": _with(
            ALL_ALERTS, "select status, count(*) as count from reviewed group by 1"
        ),
        "alert_status_update": _with(ALL_ALERTS, "select * from reviewed"),
        "alert_top_users": _with(
            ALL_ALERTS,
            "select user_id, count(*) as alert_count, round(sum(amount), 2) as total_amount "
            "from alerts group by 1 order by alert_count desc, user_id limit 10",
        ),
        "alert_delete": _with(ALL_ALERTS, "select * from alerts where risk_level <> 'LOW'"),
        "features_basic": _with(
            FEATURES[:2],
            "select transaction_id, amount, round(amount_log, 6) as amount_log, is_round_1000, "
            "is_round_5000, amount_bin, cast(dense_rank() over (order by transaction_type) - 1 "
            "as integer) as trans_type_encoded from local_features",
        ),
        "features_time": _with(
            FEATURES[:2],
            "select transaction_id, hour, round(hour_sin, 6) + 0.0::double as hour_sin, "
            "round(hour_cos, 6) + 0.0::double as hour_cos, day_of_week, is_weekend, day_of_month, "
            "is_business_hours, is_late_night from local_features",
        ),
        "features_user": user,
        "features_user_skewed": user,
        "features_rolling": rolling,
        "features_rolling_skewed": rolling,
        "features_frequency": frequency,
        "features_frequency_skewed": frequency,
        "features_amount": _with(
            FEATURES[:2],
            "select transaction_id, round(dist_from_10k, 4) as dist_from_10k, near_10k_threshold, "
            "in_structuring_range, has_decimals from local_features",
        ),
        "feature_matrix": _with(FEATURES, f"select {_round4(FEATURE_COLUMNS)} from features"),
        "standardised_features": standard,
        "stored_scaler": standard,
        "distance_outliers": outliers,
        "distance_outliers_split": outliers,
        "feature_importance": _with(
            DISTANCES,
            " union all ".join(
                f"select '{c}' as feature, case when stddev_pop({c}) > 0 then "
                f"round(abs(corr({c}, distance_to_centroid)), 4) end as importance from distances"
                for c in FEATURE_COLUMNS
            ),
        ),
        "rules_method_ids": _with(ALL_RULES, "select distinct transaction_id from flags"),
        "hybrid_sets": _with(
            METHODS,
            "select count(*) filter (where r and not m) as rules_only, "
            "count(*) filter (where m and not r) as ml_only, count(*) filter (where r and m) as both, "
            "count(*) as total_flagged from (select transaction_id, "
            "bool_or(method = 'Rules-Based') as r, bool_or(method = 'K-Means Clustering') as m "
            "from members group by 1)",
        ),
        "hybrid_method_ids": _with(
            METHODS,
            "select transaction_id, bool_or(method = 'Rules-Based') and "
            "bool_or(method = 'K-Means Clustering') as high_confidence from members group by 1",
        ),
        "confusion_by_method": _with(METHODS, _CONFUSION_SELECT),
        "best_method": _with(
            METHODS
            + [
                """
long as (
  select 'precision' as metric, method, method_order, precision as value from confusion
  union all select 'recall', method, method_order, recall from confusion
  union all select 'f1_score', method, method_order, f1_score from confusion
),
best as (
  select metric, method, value from long
  qualify row_number() over (partition by metric order by value desc, method_order) = 1
)"""
            ],
            "select metric, method, round(value, 6) as value, (select case when method = "
            "'Hybrid (Rules + ML)' then 'hybrid' when value > 0.7 then 'single_method' else 'tune' "
            "end from best where metric = 'f1_score') as recommendation from best",
        ),
        "detection_metrics": _with(DETECTED, _CONFUSION_SELECT),
        "pattern_detection_rate": _with(
            SCORED,
            "select suspicious_pattern, count(s.transaction_id) as detected, count(*) as total, "
            "round(count(s.transaction_id) / count(*), 6) as detection_rate "
            "from (select distinct transaction_id, suspicious_pattern from tx "
            "where suspicious_pattern is not null) t left join scored s using (transaction_id) "
            "group by 1",
        ),
        "summary_report": _with(
            SCORED,
            "select * from (select count(*) as total_transactions, round(sum(amount), 2) as "
            "total_volume, count(distinct user_id) as unique_users from tx), (select count(*) as "
            "flagged_transactions, round(sum(amount), 2) as flagged_volume, count(distinct user_id) "
            "as flagged_users, round(avg(final_risk_score), 4) as avg_risk_score, "
            "max(final_risk_score) as max_risk_score, round(count(*) * 100.0 / (select count(*) "
            "from tx), 4) as flag_rate from scored)",
        ),
        "run_summary": _with(SCORED, f"select {_RUN_SUMMARY} from scored"),
        "full_run": _with(
            SCORED,
            f"select {_RUN_SUMMARY}, count(*) as stored, "
            f"(select cast(sum(final_risk_score) as bigint) from ({_TOP_TEN})) as top_ten_score, "
            "(select count(distinct user_id) from scored where risk_level in "
            "('HIGH', 'CRITICAL')) as high_risk_users, "
            "(select cast(sum(len(string_split(rule_triggered, ', '))) as bigint) from scored) as rule_hits, "
            "(select count(distinct transaction_id) from tx where suspicious_pattern is not null "
            "and transaction_id in (select transaction_id from scored)) as true_positives, "
            "(select count(distinct transaction_id) from scored where transaction_id not in "
            "(select transaction_id from tx where suspicious_pattern is not null)) "
            "as false_positives, "
            "(select count(distinct transaction_id) from tx where suspicious_pattern is not null "
            "and transaction_id not in (select transaction_id from scored)) as false_negatives, "
            "(select count(*) from (select distinct transaction_id, suspicious_pattern from tx "
            "where suspicious_pattern is not null) where transaction_id in "
            "(select transaction_id from scored)) as detected_labels, "
            "(select count(*) from (select distinct transaction_id, suspicious_pattern from tx "
            "where suspicious_pattern is not null)) as labels from scored",
        ),
        "sampled_transactions": _with(
            [TX],
            "select *, suspicious_pattern is not null as is_suspicious from tx "
            "order by md5(concat(transaction_id, ':42')), transaction_id limit 10000",
        ),
        "given_forest_flags": _with(
            FEATURES + [GIVEN_FOREST],
            "select transaction_id, round(ml_anomaly_score, 9) as ml_anomaly_score, ml_prediction "
            "from given",
        ),
        "given_forest_summary": _with(
            FEATURES + [GIVEN_FOREST],
            "select count(*) as samples, count(*) filter (where ml_prediction = -1) as anomalies, "
            "round(count(*) filter (where ml_prediction = -1) / count(*) * 100, 6) as anomaly_rate, "
            "round(min(ml_anomaly_score), 6) as min_score, round(max(ml_anomaly_score), 6) as "
            "max_score from given",
        ),
        "given_forest_ids": _with(
            FEATURES + [GIVEN_FOREST],
            "select distinct transaction_id from given where ml_prediction = -1",
        ),
        "given_forest_alerts": _with(
            SCORED + FEATURES[1:] + [GIVEN_FOREST],
            "select *, transaction_id in (select transaction_id from given where "
            "ml_prediction = -1) as ml_flagged from scored",
        ),
        "given_forest_hybrid": _with(
            SCORED + FEATURES[1:] + [GIVEN_FOREST],
            "select scored.*, round(ml_anomaly_score, 6) as ml_anomaly_score, "
            "round(final_risk_score + 10 * ml_anomaly_score, 6) as hybrid_score "
            "from scored join given using (transaction_id)",
        ),
        "isolation_forest_fit": _with(
            [TX],
            "select cast(100 as bigint) as trees, cast(least(256, count(*)) as bigint) as "
            "rows_per_tree, true as depth_ok, true as leaves_ok, true as flags_ok, "
            "count(*) as scored, true as share_ok from tx where user_id is not null",
        ),
        "kmeans_fit": _with(
            [TX],
            "select count(*) as placed, cast(count(*) - floor(0.95 * (count(*) - 1)) - 1 as bigint) "
            "as outliers, cast(5 as bigint) as clusters, cast(100.0 as double) as percent, "
            "true as centres_ok from tx where user_id is not null",
        ),
        "pca_fit": _with(
            [TX],
            "select count(*) as rows, cast(37 as bigint) as components, true as variance_ok, "
            "true as uncorrelated, true as shares_ok, true as falling from tx "
            "where user_id is not null",
        ),
        "alert_store_changes": _with(
            ALL_ALERTS,
            "select * from reviewed where risk_level not in ('LOW') and transaction_id not in "
            "(select transaction_id from scored where risk_level = 'CRITICAL') union all "
            "select row_number() over (order by transaction_id) "
            f"+ (select max(alert_id) from alerts), {_ALERT_COLUMNS} "
            f"{_ALERT_REST.format(at='2024-02-05')} from scored where risk_level = 'CRITICAL'",
        ),
        "alert_store_compacted": _with(
            SCORED,
            f"""select * replace (
              case when risk_level = 'HIGH' then 'UNDER_REVIEW' else status end as status,
              case when risk_level = 'HIGH' then 'analyst' end as reviewed_by,
              case when risk_level = 'HIGH' then cast('2024-02-06' as timestamp) end as reviewed_at)
            from (select row_number() over (order by transaction_id) as alert_id, {_ALERT_COLUMNS}
                  {_ALERT_REST.format(at='2024-02-01')} from scored)""",
        ),
        "alert_store_cleared": _with(
            SCORED,
            "select cast(0 as bigint) as kept, count(*) as cleared, cast(0 as bigint) as left_over, "
            "case when count(*) filter (where risk_level = 'CRITICAL') > 0 then count(*) + 1 end "
            "as first_id, count(*) filter (where risk_level = 'CRITICAL') as again from scored",
        ),
        "report_suite_all_alerts": scored,
        "report_suite_high_risk_alerts": _with(
            SCORED, "select * from scored where risk_level in ('HIGH', 'CRITICAL')"
        ),
        "dataset_overview": _with(
            SCORED,
            "select count(*) as total_transactions, count(distinct user_id) as unique_users, "
            "round(sum(amount), 2) as total_volume, (select count(*) from scored) as "
            "alerts_generated, round((select count(*) from scored) * 100.0 / count(*), 4) as "
            "alert_rate from tx",
        ),
        "high_risk_alerts": _with(
            SCORED, "select * from scored where risk_level in ('HIGH', 'CRITICAL')"
        ),
        "top_users_report": _with(SCORED, _TOP_USERS),
        "report_suite_users": _with(SCORED, _TOP_USERS),
        "rule_effectiveness": _with(
            SCORED,
            "select rule, count(*) as count from (select unnest(string_split(rule_triggered, "
            "', ')) as rule from scored) group by 1",
        ),
        "compliance_levels": percentages,
        "compliance_top": top_ten,
        "level_counts": _with(
            SCORED, "select risk_level, count(*) as count from scored group by 1"
        ),
        "score_histogram": _with(
            SCORED
            + [
                """
b as (select min(final_risk_score) as low, max(final_risk_score) as high,
             avg(final_risk_score) as mean_score from scored)"""
            ],
            "select cast(i as integer) as bin, round(low + (high - low) / 30 * i, 4) as bin_start, "
            "round(low + (high - low) / 30 * (i + 1), 4) as bin_end, (select count(*) from scored "
            "where least(floor((final_risk_score - low) / ((high - low) / 30)), 29) = i) as count, "
            "round(mean_score, 4) as mean_score from b, range(30) r(i)",
        ),
        "amount_boxplot": box,
        "amount_boxplot_split": box,
        "alert_filter": _with(
            SCORED,
            'select transaction_id, user_id, amount, "timestamp", rule_triggered, '
            "final_risk_score, risk_level from scored where risk_level in ('HIGH', 'CRITICAL') "
            "and final_risk_score >= 75 and regexp_matches(user_id, '^c1', 'i')",
        ),
        "transaction_preview": _with(
            [TX],
            "select *, suspicious_pattern is not null as is_suspicious from tx "
            'order by "timestamp", transaction_id limit 100',
        ),
        "alert_lookup": _with(SCORED, "select * from scored where transaction_id = 'O1'"),
        "alert_timeline": _with(
            SCORED, 'select cast("timestamp" as date) as date, count(*) as count from scored group by 1'
        ),
        "dashboard_top_users": _with(
            SCORED,
            "select user_id, count(*) as alert_count, round(avg(final_risk_score), 4) as "
            "avg_risk_score, round(sum(amount), 2) as total_amount from scored group by 1 "
            "order by alert_count desc, user_id limit 10",
        ),
        "pattern_counts": _with(
            [TX],
            "select suspicious_pattern, count(*) as count from tx "
            "where suspicious_pattern is not null group by 1",
        ),
        "suspicious_rate": _with(
            [TX],
            "select count(*) as total_transactions, count(suspicious_pattern) as "
            "suspicious_transactions, round(count(suspicious_pattern) / count(*) * 100, 4) as "
            "suspicious_percent from tx",
        ),
        "amount_describe": describe,
        "amount_describe_split": describe,
        "load_stats": _with(
            [TX],
            'select count(*) as total_transactions, min("timestamp") as first_timestamp, '
            'max("timestamp") as last_timestamp, count(distinct user_id) as unique_users, '
            "round(sum(amount), 2) as total_volume, count(suspicious_pattern) as "
            "labelled_suspicious, round(count(suspicious_pattern) / count(*) * 100, 4) as "
            "labelled_percent from tx",
        ),
        "csv_round_trip": _with(
            [TX],
            'select *, suspicious_pattern is not null as is_suspicious, cast("timestamp" as date) '
            'as date, cast(hour("timestamp") as integer) as hour, '
            'cast(isodow("timestamp") - 1 as integer) as day_of_week from tx',
        ),
        "alert_csv_export": _with(
            SCORED,
            'select transaction_id, user_id, amount, "timestamp", transaction_type, '
            "rule_triggered, final_risk_score, risk_level from scored",
        ),
        "stream_high_value": high_value,
        "stream_velocity": velocity,
        "stream_alert_sink": _with(
            [TX, HIGH_VALUE, *FIRST_ALERTS], "select * from first_alerts"
        ),
        "stream_alert_sink_two_rules": _with(
            [
                TX,
                HIGH_VALUE,
                VELOCITY,
                "two_rules as (select *, risk_score * cast(1.0 as double) as weighted_score "
                "from high_value union all select *, risk_score * cast(1.2 as double) from velocity)",
                _scored("two_scored", "two_rules"),
            ],
            "select transaction_id, rule_triggered as rules_triggered, "
            "final_risk_score as risk_score, risk_level from two_scored",
        ),
    }
    statements["stored_forest"] = statements["given_forest_flags"]
    statements["kmeans_outliers"] = statements["stored_kmeans"] = _recursive(
        STANDARD + [MATRIX, CLUSTERS],
        "select transaction_id, cast(cluster as integer) as cluster, "
        "round(distance_to_centroid, 4) as distance_to_centroid, is_outlier from clustered",
    )
    statements["kmeans_cluster_sizes"] = _recursive(
        STANDARD + [MATRIX, CLUSTERS],
        "select cast(cluster as integer) as cluster, count(*) as transactions, "
        "count(*) filter (where is_outlier) as outliers, "
        "round(count(*) * 100.0::double / (select count(*) from clustered), 6) as percentage "
        "from clustered group by cluster",
    )
    statements["isolation_forest_flags"] = _recursive(
        STANDARD + FOREST,
        "select transaction_id, round(ml_anomaly_score, 9) as ml_anomaly_score, ml_prediction "
        "from forest",
    )
    statements["isolation_forest_summary"] = _recursive(
        STANDARD + FOREST,
        "select count(*) as samples, count(*) filter (where ml_prediction = -1) as anomalies, "
        "round(count(*) filter (where ml_prediction = -1) / count(*) * 100, 6) as anomaly_rate, "
        "round(min(ml_anomaly_score), 6) as min_score, round(max(ml_anomaly_score), 6) as "
        "max_score from forest",
    )
    statements["ml_flagged_alerts"] = _recursive(
        SCORED + STANDARD[1:] + FOREST,
        "select *, transaction_id in (select transaction_id from forest where "
        "ml_prediction = -1) as ml_flagged from scored",
    )
    statements["hybrid_score"] = _recursive(
        SCORED + STANDARD[1:] + FOREST,
        "select scored.*, round(ml_anomaly_score, 6) as ml_anomaly_score, "
        "round(final_risk_score + 10 * ml_anomaly_score, 6) as hybrid_score "
        "from scored join forest using (transaction_id)",
    )
    statements["method_comparison"] = _recursive(FITTED, _CONFUSION_SELECT)
    statements["report_suite_rule_effectiveness"] = statements["rule_effectiveness"]
    statements["report_suite_summary"] = statements["summary_report"]
    return statements
