"""Ordered series on the test tables."""

from pyspark.sql import functions as F

from heronlake.catalog.registry import query, r
from heronlake.functions.timeparts import day
from heronlake.operators import series as op

KEY, ORDER = ["user_id"], ["ts", "event_id"]
W = "partition by user_id order by ts, event_id"
# order lines: unique up to identical rows
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]


def values(t):
    return t.events.select("user_id", "ts", "event_id", "value")


@query(f"""select user_id, {r('max(value - low)')} as profit from (select user_id, value,
           min(value) over ({W} rows unbounded preceding) as low from events) group by 1""")
def max_single_profit(t):
    return op.max_single_profit(values(t), KEY, ORDER, "value")


@query(f"""select user_id, cast(sum(case when d > 0 then d else 0 end) as double) as profit from
           (select user_id, cast(value as decimal(18,6)) - lag(cast(value as decimal(18,6))) over ({W}) as d
            from events) group by 1""")
def max_multi_profit(t):
    return op.max_multi_profit(values(t), KEY, ORDER, "value")


@query(f"""with p as (select user_id, ts, event_id, sum(cast(value - 50 as decimal(18,6))) over
               ({W} rows unbounded preceding) as p from events),
           m as (select user_id, p, coalesce(min(p) over ({W} rows between unbounded preceding and 1 preceding), 0)
               as low from p)
           select user_id, cast(max(p - least(low, 0)) as double) as best from m group by 1""")
def max_run_sum(t):
    centred = values(t).withColumn("value", F.col("value") - 50)
    return op.max_run_sum(centred, KEY, ORDER, "value")


@query("""with n as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey,
              l_extendedprice) as rn from lineitem)
          select a.l_orderkey, a.l_linenumber, a.l_partkey, a.l_extendedprice,
          coalesce(product(b.l_linenumber), 1) as product from n a left join n b
          on a.l_orderkey = b.l_orderkey and a.rn <> b.rn
          group by a.l_orderkey, a.rn, a.l_linenumber, a.l_partkey, a.l_extendedprice""")
def product_except_self(t):
    return op.product_except_self(t.lineitem.select(*LINE_ORDER), ["l_orderkey"], LINE_ORDER, "l_linenumber")


@query(f"""select user_id, event_id, window_max from (select user_id, event_id, row_number() over ({W}) as rn,
           max(value) over ({W} rows 2 preceding) as window_max from events) where rn >= 3""")
def sliding_max(t):
    return op.sliding_max(values(t), KEY, ORDER, "value", 3).select("user_id", "event_id", "window_max")


LINES = """n as (select l_suppkey, l_orderkey, cast(l_quantity as bigint) as q, row_number() over
    (partition by l_suppkey order by l_orderkey, l_linenumber, l_partkey, l_extendedprice) as pos from lineitem)"""


def quantities(t):
    return t.lineitem.select("l_suppkey", *LINE_ORDER, F.col("l_quantity").cast("long").alias("q"))


@query(f"""with {LINES}, p as (select l_suppkey as k, pos, sum(q) over (partition by l_suppkey order by pos) as p from n
               union all select distinct l_suppkey, 0, 0 from lineitem)
           select a.k as l_suppkey, count(b.k) as runs from p a left join p b on a.k = b.k and b.p = a.p - 100
           and b.pos < a.pos group by 1""")
def count_runs_with_sum(t):
    return op.count_runs_with_sum(quantities(t), ["l_suppkey"], LINE_ORDER, "q", 100)


@query("""with n as (select l_orderkey as k, row_number() over (partition by l_orderkey order by l_linenumber,
              l_partkey, l_extendedprice) as pos, cast(l_quantity as bigint) as q from lineitem),
          p as (select k, pos, sum(q) over (partition by k order by pos) as p from n
              union all select distinct l_orderkey, 0, 0 from lineitem)
          select a.k as l_orderkey, cast(coalesce(min(a.pos - b.pos), 0) as bigint) as length from p a
          left join p b on a.k = b.k and b.pos < a.pos and a.p - b.p >= 60 group by 1""")
def shortest_run_at_least(t):
    return op.shortest_run_at_least(quantities(t), ["l_orderkey"], LINE_ORDER, "q", 60)


@query(f"""with n as (select user_id, value, row_number() over ({W}) as rn from events)
           select a.user_id, a.rn, coalesce(min(b.rn) - a.rn, 0) as gap from n a left join n b
           on a.user_id = b.user_id and b.rn > a.rn and b.value > a.value group by 1, 2""")
def next_greater_gap(t):
    return op.next_greater_gap(values(t), KEY, ORDER, "value")


@query(f"""select user_id, event_id, {r(f'quantile_cont(value, 0.5) over ({W} rows unbounded preceding)', 4)}
           as running_median from events""")
def running_median(t):
    return op.running_median(values(t), KEY, ORDER, "value").select("user_id", "event_id", "running_median")


@query("""with d as (select row_number() over (order by cast(ts as date)) - 1 as pos,
              count(*) filter (where event_type = 'click') - count(*) filter (where event_type = 'view') + 1 as d
              from events group by cast(ts as date)),
          p as (select pos, sum(d) over (order by pos) as p from d)
          select cast(case when (select sum(d) from d) < 0 then -1 when min(p) < 0
              then (select min(pos) from p where p = (select min(p) from p)) + 1 else 0 end as bigint) as start from p""")
def balance_start(t):
    first = t.events.agg(F.min(day("ts"))).scalar()
    daily = t.events.groupBy(F.date_diff(day("ts"), first).cast("long").alias("pos")).agg(
        (F.count_if(F.col("event_type") == "click") + 1).alias("gas"),
        F.count_if(F.col("event_type") == "view").alias("cost"),
    )
    return op.balance_start(daily)


@query("""with c as (select event_type, count(*) as n from events group by 1)
          select cast(greatest((max(n) - 1) * 3 + (select count(*) from c where n = (select max(n) from c)), sum(n))
          as bigint) as slots from c""")
def min_schedule_length(t):
    return op.min_schedule_length(t.events, "event_type", 2)


@query("select l_partkey, count(*) as n from lineitem group by 1 order by n desc, l_partkey limit 10")
def top_k_frequent(t):
    return op.top_k_frequent(t.lineitem, "l_partkey", 10)


@query("""select o_custkey, o_orderstatus from (select o_custkey, o_orderstatus, count(*) as n,
          sum(count(*)) over (partition by o_custkey) as a from orders group by 1, 2) where n * 2 > a""")
def majority_value(t):
    return op.majority_value(t.orders, "o_custkey", "o_orderstatus")


@query("select l_suppkey, count(*) <> count(distinct l_partkey) as has_duplicate from lineitem group by 1")
def contains_duplicate(t):
    return op.contains_duplicate(t.lineitem, "l_suppkey", "l_partkey")


@query(f"""with n as (select user_id, floor(value / 5) as v, ts, event_id, row_number() over ({W}) as rn from events),
           g as (select user_id, rn - lag(rn) over (partition by user_id, v order by rn) as g from n)
           select user_id, coalesce(min(g) <= 1, false) as has_nearby from g group by 1""")
def nearby_duplicate(t):
    rows = values(t).withColumn("v", F.floor(F.col("value") / 5))
    return op.nearby_duplicate(rows, KEY, ORDER, "v", 1)


@query("""select a.p_brand, least(a.p_size, b.p_size) as a, greatest(a.p_size, b.p_size) as b, count(*) as pairs
          from part a join part b on a.p_brand = b.p_brand and a.p_partkey < b.p_partkey and a.p_size + b.p_size = 50
          group by 1, 2, 3""")
def pairs_with_sum(t):
    return op.pairs_with_sum(t.part, "p_brand", "p_size", 50)


@query("""with v as (select c_mktsegment, c_nationkey - 12 as v, count(*) as n from customer group by 1, 2)
          select x.c_mktsegment, x.v as a, y.v as b, z.v as c from v x join v y on x.c_mktsegment = y.c_mktsegment
          and x.v <= y.v join v z on z.c_mktsegment = y.c_mktsegment and y.v <= z.v and x.v + y.v + z.v = 0
          where x.n >= 1 + cast(x.v = y.v as int) + cast(x.v = z.v as int) and y.n >= 1 + cast(y.v = z.v as int)""")
def triples_with_sum(t):
    rows = t.customer.selectExpr("c_mktsegment", "c_nationkey - 12 as v")
    return op.triples_with_sum(rows, "c_mktsegment", "v", 0)
