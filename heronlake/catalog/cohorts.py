"""Cohorts on the test tables."""

from pyspark.sql import functions as F

from heronlake.catalog.registry import query, r
from heronlake.functions.timeparts import day
from heronlake.operators import cohorts as op

BACK = """with d as (select distinct user_id as p, cast(ts as date) as d from events),
    f as (select p, min(d) as f from d group by 1)"""


def activity(t):
    return t.events.select(
        F.col("user_id").alias("player_id"), day("ts").alias("event_date")
    )


@query(f"""{BACK} select {r('count(d.p) / count(distinct f.p)')} as fraction
           from f left join d on d.p = f.p and d.d = f.f + 1""")
def day1_return_fraction(t):
    return op.day1_return_fraction(activity(t))


@query(f"""{BACK} select f as install_date, count(f.p) as installs, {r('count(d.p) / count(f.p)')} as day1_retention
           from f left join d on d.p = f.p and d.d = f.f + 1 group by 1""")
def install_retention(t):
    return op.install_retention(activity(t))


@query("""with y as (select l_partkey as product_id, cast(year(l_shipdate) as int) as year,
              l_quantity as quantity, l_extendedprice as price from lineitem)
          select * from y where (product_id, year) in (select product_id, min(year) from y group by 1)""")
def first_year_sales(t):
    return op.first_year_sales(
        t.lineitem.selectExpr("l_partkey as product_id", "year(l_shipdate) as year", "l_quantity as quantity",
                              "l_extendedprice as price")
    )


@query("""select l_partkey as product_id, l_shipdate as order_date, l_orderkey as order_id, p_name as product_name
          from lineitem join part on l_partkey = p_partkey
          where (l_partkey, l_shipdate) in (select l_partkey, max(l_shipdate) from lineitem group by 1)""")
def latest_orders_per_product(t):
    return op.latest_orders_per_product(
        t.lineitem.selectExpr("l_partkey as product_id", "l_shipdate as order_date", "l_orderkey as order_id"),
        t.part.selectExpr("p_partkey as product_id", "p_name as product_name"),
    )
