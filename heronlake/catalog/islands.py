"""Islands and intervals on the test tables."""

from pyspark.sql import functions as F

from heronlake.catalog.registry import query
from heronlake.functions.timeparts import day
from heronlake.operators import islands as op
from heronlake.plans.shared import cut_lineage

DAYS = """select datediff('day', date '2024-01-01', cast(ts as date)) as id, cast(ts as date) as visit_date,
    count(*) as people from events group by 1, 2"""


@query(f"""with d as ({DAYS}), f as (select *, id - row_number() over (order by id) as g from d where people >= 320)
           select cast(id as int) as id, visit_date, people from f
           where g in (select g from f group by 1 having count(*) >= 3)""")
def busy_stadium_runs(t):
    daily = t.events.groupBy(day("ts").alias("visit_date")).agg(F.count("*").alias("people")).select(
        F.date_diff("visit_date", F.lit("2024-01-01").cast("date")).alias("id"), "visit_date", "people"
    )
    return op.busy_stadium_runs(daily, 320)


RUNS = """with k as (select distinct l_orderkey as id from lineitem),
    g as (select id, id - row_number() over (order by id) as g from k),
    r as (select min(id) as a, max(id) as b, count(*) as n from g group by g)"""


@query(f"{RUNS} select a as start_id, b as end_id from r")
def continuous_ranges(t):
    return op.continuous_ranges(t.lineitem.selectExpr("l_orderkey as log_id"))


@query(f"{RUNS} select a as start_id, case when a = b then a::varchar else a || '->' || b end as range from r")
def summary_ranges(t):
    return op.summary_ranges(t.lineitem.selectExpr("l_orderkey as log_id"))


@query("""with d as (select cast(o_orderdate as date) as dt, case when sum(cast(o_totalprice as decimal(18,2)))
              > 1400000 then 'failed' else 'succeeded' end as s from orders where year(o_orderdate) = 1998 group by 1),
          g as (select dt, s, datediff('day', date '1970-01-01', dt) - row_number() over (partition by s order by dt)
              as g from d)
          select s as period_state, min(dt) as start_date, max(dt) as end_date from g group by s, g""")
def contiguous_dates(t):
    daily = t.orders.groupBy(day("o_orderdate").alias("d")).agg(
        (F.sum(F.col("o_totalprice").cast("decimal(18,2)")) > 1400000).alias("big")
    )
    return op.contiguous_dates(
        daily.where("big").selectExpr("d as fail_date"), daily.where("not big").selectExpr("d as success_date"), 1998
    )


@query("""with w as (select distinct user_id, cast(ts as date) as d from events where event_type = 'purchase'),
          g as (select user_id, datediff('day', date '1970-01-01', d) - row_number() over
              (partition by user_id order by d) as g from w),
          s as (select user_id, count(*) as n from g group by user_id, g)
          select user_id as player_id, coalesce(max(n), 0) as longest_streak
          from (select distinct user_id from events) left join s using (user_id) group by 1""")
def longest_streak(t):
    return op.longest_streak(
        t.events.select(F.col("user_id").alias("player_id"), day("ts").alias("match_day"),
                        F.when(F.col("event_type") == "purchase", "Win").otherwise("Lose").alias("result"))
    )


@query("""with g as (select o_orderstatus as num, o_orderkey - row_number() over (partition by o_orderstatus
              order by o_orderkey) as g from orders),
          s as (select num, count(*) as n from g group by num, g),
          l as (select num, n from s order by n desc, num limit 1)
          select distinct s.num, l.n as max_consecutive_count from s left join l on l.num = s.num where s.n >= 3""")
def consecutive_with_streak(t):
    return op.consecutive_with_streak(t.orders.selectExpr("o_orderkey as id", "o_orderstatus as num"))


@query(f"{RUNS} select max(n) as longest from r")
def longest_consecutive(t):
    return op.longest_consecutive(t.lineitem, "l_orderkey")


def merged(source: str, key: str = "") -> str:
    """DuckDB text: intervals (k, a, b) of a source merged by a running maximum."""
    part = f"partition by {key} " if key else ""
    cols = f"{key}, " if key else ""
    return f"""o as (select *, max(b) over ({part}order by a, b rows between unbounded preceding
        and 1 preceding) as m from {source}),
      f as (select *, sum(case when m is null or a > m then 1 else 0 end) over ({part}order by a, b
        rows unbounded preceding) as g from o),
      u as (select {cols}min(a) as a, max(b) as b from f group by {cols}g)"""


@query(f"""with i as (select event_type || user_id as k, cast(ts as date) as a, max(cast(ts as date)
               + cast(props->>'$.k' as int) % 3) as b from events group by 1, 2), {merged('i', 'k')}
           select k as hall_id, a as start_day, b as end_day from u""")
def merge_hall_events(t):
    days = F.get_json_object("props", "$.k").cast("int") % 3
    return op.merge_hall_events(
        t.events.select(
            F.concat("event_type", F.col("user_id").cast("string")).alias("hall_id"),
            day("ts").alias("start_day"), F.date_add(day("ts"), days).alias("end_day"))
    )


SHORT = "select ts as a, ts + to_seconds(cast(props->>'$.k' as int) * 4) as b from events"


def short_sessions(t):
    k = F.get_json_object("props", "$.k").cast("int") * 4
    length = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), k.cast("decimal(18,6)"))
    return t.events.select(F.col("ts").alias("start_ts"), (F.col("ts") + length).alias("end_ts"))


@query(f"with i as ({SHORT}), {merged('i')} select a as start_ts, b as end_ts from u")
def merge_intervals(t):
    return op.merge_intervals(short_sessions(t), "start_ts", "end_ts")


@query(f"""with i as ({SHORT} union all select timestamp '2024-01-10 00:00:00', timestamp '2024-01-10 12:00:00'),
           {merged('i')} select a as start_ts, b as end_ts from u""")
def insert_interval(t):
    disjoint = cut_lineage(op.merge_intervals(short_sessions(t), "start_ts", "end_ts"))
    new = t.spark.sql("""select timestamp_ntz'2024-01-10 00:00:00' as start_ts,
                         timestamp_ntz'2024-01-10 12:00:00' as end_ts""")
    return op.insert_interval(disjoint, new, "start_ts", "end_ts")


@query("""with recursive i as (select user_id as k, start_ts as a, end_ts as b from sessions),
          w as (select * from i where a < b and not exists (select 1 from i z where z.k = i.k and z.a = z.b
              and z.a > i.a and z.a < i.b)),
          g(k, e, n) as (select k, min(b), 1 from w group by k
              union all select g.k, min(w.b), any_value(g.n) + 1 from g join w on w.k = g.k and w.a >= g.e
              group by g.k)
          select k as user_id, count(*) - count(*) filter (where a = b) - coalesce((select max(n) from g
              where g.k = i.k), 0) as removed from i group by k""", views="sessions")
def erase_overlaps(t):
    return op.erase_overlaps(t.sessions, "user_id", "start_ts", "end_ts")


@query("""with s as (select event_type, start_ts as m, 1 as d from sessions
              union all select event_type, end_ts, -1 from sessions),
          c as (select event_type, sum(d) over (partition by event_type order by m) as n from s)
          select event_type, cast(max(n) as bigint) as max_open from c group by 1""", views="sessions")
def max_concurrency(t):
    return op.max_concurrency(t.sessions, ["event_type"], "start_ts", "end_ts")


@query(f"""with p as (select user_id as k, cast(floor(value / 10) as bigint) as v, row_number() over
               (partition by user_id order by ts, event_id) as pos from events),
           i as (select k, v, min(pos) as a, max(pos) as b from p group by 1, 2), {merged('i', 'k')}
           select k as user_id, a as first, b - a + 1 as length from u""")
def partition_by_key_span(t):
    seq = t.events.selectExpr("user_id", "ts", "event_id", "floor(value / 10) as letter")
    return op.partition_by_key_span(seq, ["user_id"], ["ts", "event_id"], "letter")
