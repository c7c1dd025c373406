"""Set operations and pivots on the test tables."""

from pyspark.sql import functions as F

from heronlake.catalog.registry import query, r, total
from heronlake.operators import reshape as op
from heronlake.sources.views import nation_flows

# Kinds of parts and of events in the test tables.
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(f"""with d as (select strftime(o_orderdate, '%Y-%m') as month, o_orderpriority as country,
               'approved' as type, o_totalprice as amount from orders where o_orderstatus = 'F'
               union all select strftime(l_shipdate, '%Y-%m'), o_orderpriority, 'chargeback', o_totalprice
               from lineitem join orders on l_orderkey = o_orderkey where l_returnflag = 'R')
           select month, country, count(*) filter (where type = 'approved') as approved_count,
           {total("case when type = 'approved' then amount else 0 end")} as approved_amount,
           count(*) filter (where type = 'chargeback') as chargeback_count,
           {total("case when type = 'chargeback' then amount else 0 end")} as chargeback_amount
           from d group by 1, 2""")
def transactions_chargebacks(t):
    return op.transactions_chargebacks(
        t.orders.selectExpr("o_orderkey as id", "o_orderpriority as country", "o_totalprice as amount",
                            "if(o_orderstatus = 'F', 'approved', 'declined') as state", "o_orderdate as trans_date"),
        t.lineitem.where("l_returnflag = 'R'").selectExpr("l_orderkey as trans_id", "l_shipdate as trans_date"),
    )


@query("""with e as (select s_nationkey as employee_id, s_suppkey as department_id, s_suppkey % 10 = 0 as p
              from supplier)
          select employee_id, department_id from e where p union
          select employee_id, min(department_id) from e group by 1 having count(*) = 1""")
def primary_department(t):
    return op.primary_department(
        t.supplier.selectExpr("s_nationkey as employee_id", "s_suppkey as department_id",
                              "if(s_suppkey % 10 = 0, 'Y', 'N') as primary_flag")
    )


@query("""with g as (select distinct user_id, datediff('day', date '2024-01-01', cast(ts as date)) as d
              from events where event_type = 'purchase'),
          i as (select user_id, d - row_number() over (partition by user_id order by d) as g from g)
          select user_id from g group by 1 having count(*) >= 3
          union select user_id from i group by user_id, g having count(*) >= 3""")
def interview_candidates(t):
    return op.interview_candidates(
        t.events.selectExpr("user_id", "if(event_type = 'purchase', user_id, -1) as gold_medal",
                            "date_diff(to_date(ts), date'2024-01-01') as contest_id")
    )


@query("""with m as (select buyer_nation as k, cast(l_quantity as bigint) as f, cast(l_linenumber * 7 as bigint) as a
              from flows union all
              select seller_nation, cast(l_linenumber * 7 as bigint), cast(l_quantity as bigint) from flows)
          select n_nationkey as team_id, n_name as team_name, count(*) as matches_played,
          cast(sum(case when f > a then 3 when f = a then 1 else 0 end) as bigint) as points,
          cast(sum(f) as bigint) as goal_for, cast(sum(a) as bigint) as goal_against,
          cast(sum(f) - sum(a) as bigint) as goal_diff from m join nation on k = n_nationkey group by 1, 2""",
       views="flows")
def team_scores(t):
    return op.team_scores(
        t.nation.selectExpr("n_nationkey as team_id", "n_name as team_name"),
        nation_flows(t).selectExpr("buyer_nation as host_team", "seller_nation as guest_team",
                                   "cast(l_quantity as bigint) as host_goals",
                                   "cast(l_linenumber * 7 as bigint) as guest_goals"),
    )


@query("select o_orderkey, o_orderdate from orders")
def merge_sorted(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return op.merge_sorted(rows.where("year(o_orderdate) < 1998"), rows.where("year(o_orderdate) >= 1998"),
                           ["o_orderdate", "o_orderkey"])


def prices(t):
    return t.part.selectExpr("p_brand as product_id", "p_type as store", "p_retailprice as price")


@query("select p_brand as product_id, p_type as store, max(p_retailprice) as price from part group by 1, 2")
def unpivot_stores(t):
    return op.unpivot_stores(op.pivot_stores(prices(t), PART_TYPES), PART_TYPES)


@query("select p_brand as product_id, "
       + ", ".join(f"max(case when p_type = '{k}' then p_retailprice end) as \"{k}\"" for k in PART_TYPES)
       + " from part group by 1")
def pivot_stores(t):
    return op.pivot_stores(prices(t), PART_TYPES)


@query("select p_type as category, "
       + ", ".join(f"coalesce(sum(l_quantity) filter (where dayofweek(l_shipdate) + 1 = {n}), 0) as {name}"
                   for n, name in op.WEEK.items())
       + " from part left join lineitem on l_partkey = p_partkey group by 1")
def pivot_weekday(t):
    return op.pivot_weekday(
        t.part.selectExpr("p_partkey as item_id", "p_type as category"),
        t.lineitem.selectExpr("l_partkey as item_id", "l_shipdate as order_date", "l_quantity as quantity"),
    )


@query("select c_nationkey as id, "
       + ", ".join(f"max(o_totalprice) filter (where month(o_orderdate) = {i}) as {m.lower()}_revenue"
                   for i, m in enumerate(op.MONTHS, 1))
       + " from orders join customer on o_custkey = c_custkey group by 1")
def pivot_months(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return op.pivot_months(
        joined.selectExpr("c_nationkey as id", "date_format(o_orderdate, 'MMM') as month", "o_totalprice as revenue")
    )


REGIONS = {"0": "africa", "1": "america", "2": "asia", "3": "europe", "4": "middle_east"}


@query("""with k as (select s_name as name, n_regionkey as g, row_number() over (partition by n_regionkey
              order by s_name) as rn from supplier join nation on s_nationkey = n_nationkey) select rn, """
       + ", ".join(f"max(case when g = {g} then name end) as {out}" for g, out in REGIONS.items()) + " from k group by rn")
def pivot_by_rownum(t):
    students = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    students = students.selectExpr("s_name as name", "cast(n_regionkey as string) as continent")
    return op.pivot_by_rownum(students, REGIONS, "name")


@query("select cast(hour(pickup_ts) as int) as hour, "
       + ", ".join(r(f"cast(sum(cast(fare_amount as decimal(18,6))) filter (where payment_type = '{k}') as double)")
                   + f" as {k}" for k in EVENT_TYPES) + " from trips group by 1", views="trips")
def pivot_table_sum(t):
    return op.pivot_table_sum(t.trips, EVENT_TYPES)
