"""Window operators on the test tables."""

from pyspark.sql import functions as F

from heronlake.catalog.registry import mean, query, r, total
from heronlake.functions.timeparts import day, month_start
from heronlake.operators import windows as op
from heronlake.operators.spines import month_spine
from heronlake.sources.views import nation_flows


@query("""select n_name as department, s_name as employee, s_acctbal as salary from
          (select *, dense_rank() over (partition by s_nationkey order by s_acctbal desc) as k from supplier)
          join nation on s_nationkey = n_nationkey where k <= 3""")
def department_top3(t):
    return op.department_top3(
        t.supplier.selectExpr("s_nationkey as dept_id", "s_name as employee", "s_acctbal as salary"),
        t.nation.selectExpr("n_nationkey as dept_id", "n_name as department"),
    )


@query("""select o_orderkey, o_totalprice as score, dense_rank() over (order by o_totalprice desc) as rank
          from orders""")
def rank_scores(t):
    return op.rank_scores(t.orders.selectExpr("o_orderkey", "o_totalprice as score"))


@query("""with s as (select buyer_nation as p, cast(l_quantity as bigint) as s from flows
              union all select seller_nation, l_linenumber from flows),
          q as (select n_regionkey as group_id, p as player_id, rank() over (partition by n_regionkey
              order by sum(s) desc, p) as k from s join nation on p = n_nationkey group by 1, 2)
          select group_id, player_id from q where k = 1""", views="flows")
def tournament_winners(t):
    return op.tournament_winners(
        t.nation.selectExpr("n_nationkey as player_id", "n_regionkey as group_id"),
        nation_flows(t).selectExpr("buyer_nation as first_player", "cast(l_quantity as bigint) as first_score",
                                   "seller_nation as second_player", "cast(l_linenumber as bigint) as second_score"),
    )


@query("""with c as (select o_custkey as customer_id, l_partkey as product_id, rank() over
              (partition by o_custkey order by count(*) desc) as k
              from lineitem join orders on l_orderkey = o_orderkey group by 1, 2)
          select customer_id, product_id, p_name as product_name from c join part on product_id = p_partkey
          where k = 1""")
def most_frequent_products(t):
    return op.most_frequent_products(
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .selectExpr("o_custkey as customer_id", "l_partkey as product_id"),
        t.part.selectExpr("p_partkey as product_id", "p_name as product_name"),
    )


@query("""select event_id as transaction_id from (select event_id, rank() over (partition by cast(ts as date)
          order by value desc) as k from events) where k = 1""")
def max_txn_per_day(t):
    return op.max_txn_per_day(
        t.events.select(F.col("event_id").alias("transaction_id"), day("ts").alias("day"), F.col("value").alias("amount"))
    )


@query(f"""with s as (select n_regionkey as seller_state, l_suppkey as seller_id,
               count(distinct l_orderkey) as total_orders, {r(total('l_extendedprice'))} as revenue
               from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
               group by 1, 2),
           k as (select *, cast(rank() over (partition by seller_state order by revenue desc) as int)
               as seller_rank from s)
           select * from k where seller_rank <= 3""")
def top_sellers_per_state(t):
    sellers = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return op.top_sellers_per_state(
        t.lineitem.selectExpr("l_suppkey as seller_id", "l_orderkey as order_id", "l_extendedprice as price"),
        sellers.selectExpr("s_suppkey as seller_id", "n_regionkey as seller_state"),
    )


@query("""with a as (select l_orderkey as username, l_partkey as activity, l_shipdate - interval 3 day as start_date,
              l_shipdate as end_date, row_number() over (partition by l_orderkey
              order by l_shipdate desc, l_partkey desc) as k, count(*) over (partition by l_orderkey) as n
              from lineitem)
          select username, activity, start_date, end_date from a where k = 2 or (k = 1 and n = 1)""")
def second_most_recent(t):
    return op.second_most_recent(
        t.lineitem.selectExpr("l_orderkey as username", "l_partkey as activity",
                              "l_shipdate - interval 3 days as start_date", "l_shipdate as end_date")
    )


@query("select s_suppkey as employee_id, count(*) over (partition by s_nationkey) as team_size from supplier")
def team_size(t):
    return op.team_size(t.supplier.selectExpr("s_suppkey as employee_id", "s_nationkey as team_id"))


@query("""with c as (select user_id, event_type, count(*) as n from events group by 1, 2),
          m as (select *, avg(n) over (partition by event_type) as m from c)
          select user_id as business_id from m where n > m group by 1 having count(*) > 1""")
def active_businesses(t):
    return op.active_businesses(
        t.events.groupBy(F.col("user_id").alias("business_id"), "event_type").agg(F.count("*").alias("occurrences"))
    )


@query("""select user_id, event_id, cast(sum(cast(value as decimal(18,6))) over (partition by user_id
          order by ts, event_id rows unbounded preceding) as double) as running_total from events""")
def running_total_by_group(t):
    df = t.events.select("user_id", "ts", "event_id", "value")
    return op.running_total_by_group(df, "user_id", ["ts", "event_id"], "value").select(
        "user_id", "event_id", "running_total"
    )


@query(f"""with d as (select cast(ts as date) as visited_on, sum(cast(value as decimal(18,6))) as s from events
               group by 1),
           w as (select visited_on, row_number() over o as rn, sum(s) over (o rows 6 preceding) as w
               from d window o as (order by visited_on))
           select visited_on, cast(w as double) as amount, {r('cast(w as double) / 7')} as average_amount
           from w where rn >= 7""")
def moving_average_7(t):
    return op.moving_average_7(t.events.select(day("ts").alias("visited_on"), F.col("value").alias("amount")))


@query(f"""with m as (select unnest(generate_series(1, 12)) as month),
           s as (select month(o_orderdate) as month, {total('o_totalprice')} as d,
               {total('o_orderkey % 90')} as u from orders where year(o_orderdate) = 2000 group by 1)
           select cast(month as int) as month, {r('avg(coalesce(d, 0)) over w')} as average_ride_distance,
           {r('avg(coalesce(u, 0)) over w')} as average_ride_duration
           from m left join s using (month) window w as (order by month rows 2 preceding)""")
def rolling_3_month(t):
    rides = t.orders.selectExpr("o_orderdate as requested_at", "o_totalprice as ride_distance",
                                "o_orderkey % 90 as ride_duration")
    return op.rolling_3_month(month_spine(t.spark), rides, 2000)


@query("""with m as (select o_custkey as id, cast(date_trunc('month', o_orderdate) as date) as month,
              sum(cast(o_totalprice as decimal(18,6))) as s from orders group by 1, 2),
          k as (select *, max(month) over (partition by id) as last from m)
          select id, month, cast(sum(s) over (partition by id order by month rows 2 preceding) as double)
          as salary from k where month <> last""")
def cumulative_salary(t):
    return op.cumulative_salary(
        t.orders.select(F.col("o_custkey").alias("id"), month_start("o_orderdate").alias("month"),
                        F.col("o_totalprice").alias("salary"))
    )


@query("""select p_name as person_name from (select p_name, p_partkey, sum(p_size) over (order by p_partkey
          rows unbounded preceding) as load from part) where load <= 1000
          order by load desc, p_partkey desc limit 1""")
def last_to_fit(t):
    return op.last_to_fit(t.part.selectExpr("p_partkey as turn", "p_name as person_name", "p_size as weight"))


@query("""with c as (select case when s_nationkey < 12 then 'Senior' else 'Junior' end as experience,
              s_suppkey, cast(s_acctbal as decimal(18,6)) as salary from supplier),
          k as (select *, sum(salary) over (partition by experience order by salary, s_suppkey
              rows unbounded preceding) as cost from c),
          s as (select coalesce(sum(salary), 0) as spent from k where experience = 'Senior' and cost <= 70000)
          select 'Senior' as experience, count(*) as accepted_candidates from k
          where experience = 'Senior' and cost <= 70000
          union all select 'Junior', count(*) from k, s where experience = 'Junior' and cost <= 70000 - spent""")
def hiring_budget(t):
    return op.hiring_budget(
        t.supplier.selectExpr("s_suppkey as employee_id", "if(s_nationkey < 12, 'Senior', 'Junior') as experience",
                              "s_acctbal as salary")
    )


@query("""with k as (select c_custkey as id, c_nationkey as company, c_acctbal as salary, row_number() over
              (partition by c_nationkey order by c_acctbal, c_custkey) as rn,
              count(*) over (partition by c_nationkey) as n from customer)
          select id, company, salary from k where rn >= n / 2.0 and rn <= n / 2.0 + 1""")
def median_rows(t):
    return op.median_rows(t.customer.selectExpr("c_custkey as id", "c_nationkey as company", "c_acctbal as salary"))


@query(f"""with n as (select l_extendedprice as num, count(*) as f from lineitem group by 1),
           c as (select num, f, sum(f) over (order by num) as up, sum(f) over (order by num desc) as down,
               sum(f) over () as n from n)
           select {r(mean('num'), 1)} as median from c where up >= n / 2.0 and down >= n / 2.0""")
def frequency_median(t):
    return op.frequency_median(
        t.lineitem.groupBy(F.col("l_extendedprice").alias("num")).agg(F.count("*").alias("frequency"))
    )


@query("""with y as (select o_custkey as c, year(o_orderdate) as yr, sum(cast(o_totalprice as decimal(18,6))) as s
              from orders group by 1, 2),
          p as (select c, yr, s, lag(s) over w as ps, lag(yr) over w as py from y
              window w as (partition by c order by yr))
          select distinct c as customer_id from p where c not in
          (select c from p where ps is not null and (s <= ps or yr <> py + 1))""")
def increasing_purchases(t):
    return op.increasing_purchases(
        t.orders.selectExpr("o_custkey as customer_id", "o_orderdate as transaction_date", "o_totalprice as amount")
    )


@query(f"""with h as (select cast(hour(pickup_ts) as int) as hour, {total('fare_amount')} as total_revenue
               from trips group by 1),
           c as (select *, {r('100 * (total_revenue - lag(total_revenue) over (order by hour)) / '
               'nullif(lag(total_revenue) over (order by hour), 0)')} as pct_change from h)
           select *, coalesce(pct_change < -20, false) as revenue_drop_flag from c""", views="trips")
def hourly_drop_flag(t):
    return op.hourly_drop_flag(t.trips)


@query("""select trip_id, vendor_id, fare_amount, fare_amount > avg(fare_amount) over (partition by vendor_id)
          + 2 * stddev_samp(fare_amount) over (partition by vendor_id) as is_outlier from trips""", views="trips")
def group_outlier_flag(t):
    return op.group_outlier_flag(t.trips.select("trip_id", "vendor_id", "fare_amount"), "vendor_id", "fare_amount")


@query(f"""select vendor_id, {r(mean('fare_amount'))} as vendor_avg, {r('stddev_samp(fare_amount)')} as vendor_std,
           count(fare_amount) as trip_count,
           {r(mean('fare_amount'))} > (select {mean('fare_amount')} from trips) as above_overall_avg
           from trips group by 1""", views="trips")
def vendor_vs_overall(t):
    return op.vendor_vs_overall(t.trips)


@query(f"""select trip_id, payment_type, fare_amount, {r("100 * fare_amount / cast(sum(cast(fare_amount as "
           "decimal(18,6))) over (partition by payment_type) as double)", 4)} as pct_of_group from trips""",
       views="trips")
def pct_of_group(t):
    return op.pct_of_group(t.trips.select("trip_id", "payment_type", "fare_amount"), "payment_type", "fare_amount")


@query(f"""with d as (select cast(ts as date) as day, round(sum(cast(value as decimal(18,6))) / 1000) as revenue
               from events group by 1),
           k as (select *, rank() over (order by revenue desc) as k, count(*) over (partition by revenue) as n from d)
           select day, cast(revenue as double) as revenue, cast(floor(k + (n - 1) / 2.0) as int) as revenue_rank
           from k""")
def average_rank(t):
    daily = t.events.groupBy(day("ts").alias("day")).agg(
        F.round(F.sum(F.col("value").cast("decimal(18,6)")).cast("double") / 1000).alias("revenue")
    )
    return op.average_rank(daily, "revenue", "revenue_rank")
