"""DuckDB SQL of the fitted models: the forest and the clusters, grown by recursive statements.

``standard`` (transaction_id and the scaled features) must stand before these parts.
"""

from __future__ import annotations

from ledgerlens.operators.features import FEATURE_COLUMNS

_N = len(FEATURE_COLUMNS)
_ALL = range(1, _N + 1)


def _digits(text: str, start: int, n: int) -> str:
    """``n`` hex digits of an MD5 as a whole number."""
    return f"cast('0x' || substr(md5({text}), {start}, {n}) as bigint)"


_UNIT = "4503599627370496"  # 16 to the power of 13

MATRIX = f"""
m as materialized (
  select transaction_id as id, [{", ".join(FEATURE_COLUMNS)}] as x, {_digits("transaction_id", 1, 13)} as key from standard
)"""

# Every tree's rows: the next 256 of the order of hashes, starting over at its end.
FOREST = [
    MATRIX,
    """
smp as materialized (
  select id, x, row_number() over (order by md5(concat(id, ':42')), id) - 1 as place from m
  qualify place < 25600
),
per as (select count(*) as n, least(256, count(*)) as p from smp),
drawn as materialized (
  select (place + j * n) // p as tree, id, x
  from (select smp.*, n, p, unnest(range(0, 25600 // n + 1)) as j from smp, per) where place + j * n < 100 * p
),
depth as (select cast(greatest(1, ceil(log2(greatest(p, 2)))) as bigint) as d from per)""",
    f"""
grown as (
  select tree, cast(0 as bigint) as node, cast(0 as bigint) as level, id from drawn
  union all
  select tree, 2 * node + case when x[f] <= cut then 1 else 2 end, level + 1, id
  from (
    select *, case when low[f] + share * (high[f] - low[f]) >= high[f] then low[f] else low[f] + share * (high[f] - low[f]) end as cut
    from (
      select tree, node, level, unnest(ids) as id, unnest(xs) as x, low, high,
             usable[1 + {_digits("'42:' || tree || ':' || node", 1, 8)} % len(usable)] as f,
             ({_digits("'42:' || tree || ':' || node", 9, 13)} + 0.5) / {_UNIT} as share
      from (
        select *, list_filter(range(1, {_N + 1}), lambda k: high[k] - low[k] > 1e-9) as usable
        from (
          select grown.tree, node, level, list(grown.id) as ids, list(x) as xs,
                 [{", ".join(f"min(x[{k}])" for k in _ALL)}] as low, [{", ".join(f"max(x[{k}])" for k in _ALL)}] as high
          from grown join drawn on grown.tree = drawn.tree and grown.id = drawn.id group by grown.tree, node, level)
      ) join depth on level < d where len(usable) > 0))
),
nodes as materialized (
  select tree, node, f,
         case when low[f] + share * (high[f] - low[f]) >= high[f] then low[f] else low[f] + share * (high[f] - low[f]) end as cut,
         case when f is null then floor((level + case when n > 2 then 2.0 * (ln(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n
                                                      when n = 2 then 1.0 else 0.0 end) * 1048576 + 0.5) / 1048576 end as path
  from (
    select *, case when level < d and len(usable) > 0
                   then usable[1 + {_digits("'42:' || tree || ':' || node", 1, 8)} % len(usable)] end as f,
           ({_digits("'42:' || tree || ':' || node", 9, 13)} + 0.5) / {_UNIT} as share
    from (
      select *, list_filter(range(1, {_N + 1}), lambda k: high[k] - low[k] > 1e-9) as usable
      from (
        select grown.tree, node, level, count(*) as n,
               [{", ".join(f"min(x[{k}])" for k in _ALL)}] as low, [{", ".join(f"max(x[{k}])" for k in _ALL)}] as high
        from grown join drawn on grown.tree = drawn.tree and grown.id = drawn.id group by grown.tree, node, level)
    ), depth)
),
walked as (
  select id, tree, cast(0 as bigint) as node from m, range(100) t(tree)
  union all
  select id, tree, 2 * node + case when x[f] <= cut then 1 else 2 end
  from (
    select walked.id, walked.tree, walked.node, f, cut, x
    from walked join nodes on walked.tree = nodes.tree and walked.node = nodes.node join m on walked.id = m.id
    where f is not null)
),
forest_scores as materialized (
  select id as transaction_id,
         power(2.0, -(sum(path) / 100) / (select case when p > 2 then 2.0 * (ln(p - 1.0) + 0.5772156649015329) - 2.0 * (p - 1.0) / p
                                                     else 1.0 end from per)) as ml_anomaly_score
  from walked join nodes on walked.tree = nodes.tree and walked.node = nodes.node where f is null group by id
),
forest as (
  select *, case when ml_anomaly_score > (select quantile_cont(ml_anomaly_score, 0.95) from forest_scores)
                 then -1 else 1 end as ml_prediction from forest_scores
)""",
]

_SPEED = "list_min(list_transform(c, lambda p: list_distance(x, p) ** 2))"

CLUSTERS = f"""
seeds as (
  select r, cast(0 as bigint) as draw, cast([] as double[][]) as c from range(10) t(r)
  union all
  select r, draw + 1, list_append(any_value(c), arg_max(x, speed))
  from (
    select r, draw, c, x,
           case when draw = 0 then 1.0 else {_SPEED} end
           / -ln(((key + {_digits("(42 + r) || ':' || draw", 1, 13)}) % {_UNIT} + 0.5) / {_UNIT}) as speed
    from seeds, m where draw < 5)
  group by r, draw
),
lloyd as (
  select r, cast(0 as bigint) as step, c, cast(1 as double) as moved from seeds where draw = 5
  union all
  select r, step + 1, fresh, list_sum(list_transform(range(1, 6), lambda j: list_distance(fresh[j], c[j]) ** 2))
  from (
    select r, step, any_value(c) as c,
           [{", ".join(f"coalesce(any_value(mean) filter (cluster = {j}), any_value(c)[{j}])" for j in range(1, 6))}] as fresh
    from (
      select r, step, any_value(c) as c, cluster, [{", ".join(f"avg(x[{k}])" for k in _ALL)}] as mean
      from (
        select r, step, c, x, list_position(away, list_min(away)) as cluster
        from (select r, step, c, x, list_transform(c, lambda p: list_distance(x, p)) as away
              from lloyd, m where moved > 1e-4 and step < 300))
      group by r, step, cluster)
    group by r, step)
),
fitted as (
  select r, c, sum(cost) as cost
  from (select r, c, list_min(list_transform(c, lambda p: list_distance(x, p) ** 2)) as cost
        from (select r, arg_max(c, step) as c from lloyd group by r), m)
  group by r, c
),
centers as (
  select list_sort(arg_min(c, r)) as c from fitted where cost <= (select min(cost) from fitted) * (1 + 1e-6)
),
near as materialized (
  select id as transaction_id, list_position(away, list_min(away)) - 1 as cluster, list_min(away) as distance_to_centroid
  from (select id, list_transform(c, lambda p: list_distance(x, p)) as away from m, centers)
),
clustered as (
  select *, distance_to_centroid > (select quantile_cont(distance_to_centroid, 0.95) from near) as is_outlier from near
)"""
