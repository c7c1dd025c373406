"""Spine reports on the test tables."""

from pyspark.sql import functions as F

from heronlake.catalog.registry import query, r
from heronlake.functions.timeparts import day
from heronlake.operators import spines as op

MONTHS = "m as (select unnest(generate_series(1, 12)) as month)"


@query(f"""with {MONTHS}, j as (select o_custkey, min(o_orderdate) as d from orders group by 1),
           rr as (select month(o_orderdate) as month, count(*) as n from orders
               where year(o_orderdate) = 2000 and o_orderstatus = 'F' group by 1)
           select cast(m.month as int) as month, (select count(*) from j where year(d) < 2000 or
               (year(d) = 2000 and month(d) <= m.month)) as active_drivers,
           coalesce(n, 0) as accepted_rides from m left join rr on rr.month = m.month""")
def monthly_active_and_rides(t):
    drivers = t.orders.groupBy(F.col("o_custkey").alias("driver_id")).agg(F.min("o_orderdate").alias("join_date"))
    return op.monthly_active_and_rides(
        drivers, t.orders.selectExpr("o_orderkey as ride_id", "o_orderdate as requested_at"),
        t.orders.where("o_orderstatus = 'F'").selectExpr("o_orderkey as ride_id"), 2000,
    )


@query(f"""with {MONTHS}, j as (select o_custkey as k, min(o_orderdate) as d from orders group by 1),
           a as (select m.month, k from m join j on year(d) < 2000 or (year(d) = 2000 and month(d) <= m.month)),
           w as (select distinct month(o_orderdate) as month, o_custkey as k from orders
               where year(o_orderdate) = 2000 and o_orderstatus = 'F')
           select cast(m.month as int) as month, {r('case when count(a.k) = 0 then 0 else '
               '100.0 * count(distinct w.k) / count(distinct a.k) end')} as working_percentage
           from m left join a on m.month = a.month left join w on w.month = m.month and w.k = a.k group by 1""")
def working_driver_pct(t):
    drivers = t.orders.groupBy(F.col("o_custkey").alias("driver_id")).agg(F.min("o_orderdate").alias("join_date"))
    accepted = t.orders.where("o_orderstatus = 'F'").selectExpr("o_orderkey as ride_id", "o_custkey as driver_id")
    rides = t.orders.selectExpr("o_orderkey as ride_id", "o_orderdate as requested_at")
    return op.working_driver_pct(drivers, rides, accepted, 2000)


@query("""with s as (select cast(ts as date) as d, user_id as u, case when event_type in ('view', 'click') then 'mobile'
              else 'desktop' end as p, value from events),
          k as (select d, u, case when count(distinct p) = 2 then 'both' else max(p) end as p,
              sum(cast(value as decimal(18,6))) as s from s group by 1, 2),
          q as (select * from (select distinct d from s), (values ('desktop'), ('mobile')) v(p))
          select q.d as spend_date, q.p as platform, cast(coalesce(sum(s), 0) as double) as total_amount,
          count(distinct u) as total_users from q left join k on k.d = q.d and k.p = q.p group by 1, 2""")
def purchase_platform(t):
    return op.purchase_platform(
        t.events.select(
            day("ts").alias("spend_date"), "user_id", F.col("value").alias("amount"),
            F.when(F.col("event_type").isin("view", "click"), "mobile").otherwise("desktop").alias("platform"),
        )
    )


@query("""with v as (select o_orderkey, count(l_orderkey) as n from orders left join lineitem
              on l_orderkey = o_orderkey group by 1),
          s as (select unnest(generate_series(0, (select max(n) from v))) as n)
          select s.n as transactions_count, count(o_orderkey) as visits_count from s left join v using (n) group by 1""")
def transactions_per_visit(t):
    return op.transactions_per_visit(
        t.orders.selectExpr("o_orderkey as user_id", "o_orderdate as visit_date"),
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .selectExpr("l_orderkey as user_id", "o_orderdate as transaction_date"),
    )


@query("""with t as (select l_orderkey as task_id, max(l_linenumber) as n from lineitem group by 1)
          select task_id, cast(k as int) as subtask_id from (select task_id, unnest(generate_series(1, n)) as k from t)
          where (task_id, k) not in (select l_orderkey, l_linenumber from lineitem)""")
def missing_subtasks(t):
    return op.missing_subtasks(
        t.lineitem.groupBy(F.col("l_orderkey").alias("task_id")).agg(F.max("l_linenumber").alias("subtasks_count")),
        t.lineitem.selectExpr("l_orderkey as task_id", "l_linenumber as subtask_id"),
    )


@query("""select ids from (select unnest(generate_series(1, (select max(l_orderkey) from lineitem))) as ids)
          where ids not in (select l_orderkey from lineitem)""")
def missing_ids(t):
    return op.missing_ids(t.lineitem, "l_orderkey")


@query("""with p(platform) as (values ('click'), ('purchase'), ('tap')),
          e(experiment_name) as (values ('0'), ('5'), ('6'))
          select platform, experiment_name, count(event_id) as num_experiments from p cross join e
          left join events on event_type = platform
          and cast((dayofweek(ts) + 6) % 7 as varchar) = experiment_name group by 1, 2""")
def experiment_matrix(t):
    runs = t.events.selectExpr("event_type as platform", "cast(weekday(ts) as string) as experiment_name")
    return op.experiment_matrix(runs, ["click", "purchase", "tap"], ["0", "5", "6"])


@query("""with c(category) as (values ('Low Salary'), ('Average Salary'), ('High Salary')),
          a as (select case when c_acctbal * 10 < 20000 then 'Low Salary' when c_acctbal * 10 > 50000
              then 'High Salary' else 'Average Salary' end as category, count(*) as n from customer group by 1)
          select category, coalesce(n, 0) as accounts_count from c left join a using (category)""")
def salary_categories(t):
    return op.salary_categories(t.customer.selectExpr("c_acctbal * 10 as income"))
