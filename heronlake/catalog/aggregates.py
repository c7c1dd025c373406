"""Aggregates on the test tables."""

from pyspark.sql import functions as F

from heronlake.catalog.registry import mean, query, r, total
from heronlake.functions.timeparts import day, hour_start
from heronlake.operators import aggregates as op
from heronlake.sources.views import nation_flows


@query(f"""select strftime(o_orderdate, '%Y-%m') as month, o_orderpriority as country,
           count(*) as trans_count, count(*) filter (where o_orderstatus = 'F') as approved_count,
           {total('o_totalprice')} as trans_total,
           {total("case when o_orderstatus = 'F' then o_totalprice else 0 end")} as approved_total
           from orders group by 1, 2""")
def monthly_transactions(t):
    return op.monthly_transactions(
        t.orders.selectExpr("o_orderdate as trans_date", "o_orderpriority as country",
                            "if(o_orderstatus = 'F', 'approved', 'declined') as state", "o_totalprice as amount")
    )


DELIVERY = """select o_custkey as customer_id, o_orderdate as order_date,
    case when l_shipdate <= o_orderdate + interval 30 day then o_orderdate else l_shipdate end as pref_date
    from lineitem join orders on l_orderkey = o_orderkey"""


def delivery(t):
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "o_custkey as customer_id", "o_orderdate as order_date",
        "if(l_shipdate <= o_orderdate + interval 30 days, o_orderdate, l_shipdate) as pref_date",
    )


@query(f"""select {r('100.0 * sum(case when order_date = pref_date then 1 else 0 end) / count(*)')}
           as immediate_percentage from ({DELIVERY})""")
def immediate_delivery_pct(t):
    return op.immediate_delivery_pct(delivery(t))


@query(f"""with d as ({DELIVERY}) select
           {r('100.0 * sum(case when order_date = pref_date then 1 else 0 end) / count(*)')}
           as immediate_percentage from d where (customer_id, order_date) in
           (select customer_id, min(order_date) from d group by 1)""")
def first_order_immediate_pct(t):
    return op.first_order_immediate_pct(delivery(t))


@query(f"""select l_partkey as stock_name, {total("case when l_returnflag = 'R' then -l_extendedprice "
           "else l_extendedprice end")} as capital_gain_loss from lineitem group by 1""")
def capital_gain_loss(t):
    return op.capital_gain_loss(
        t.lineitem.selectExpr("l_partkey as stock_name", "if(l_returnflag = 'R', 'Buy', 'Sell') as operation",
                              "l_extendedprice as price")
    )


@query("""select date_trunc('hour', ts) as sale_date from events where event_type in ('click', 'view')
          group by 1 having sum(case event_type when 'click' then 1 else -1 end) = 0""")
def fruit_balance_days(t):
    fruit = "case event_type when 'click' then 'apples' when 'view' then 'oranges' end as fruit"
    return op.fruit_balance_days(
        t.events.select(hour_start("ts").alias("sale_date"), F.expr(fruit), F.lit(1).alias("sold_num"))
    )


@query(f"""with x as (select strftime(o_orderdate, '%Y-%m') as pay_month, o_orderpriority as department_id,
               {r(mean('o_totalprice'), 6)} as d from orders group by 1, 2),
           c as (select strftime(o_orderdate, '%Y-%m') as pay_month, {r(mean('o_totalprice'), 6)} as a
               from orders group by 1)
           select pay_month, department_id, case when d > a then 'higher' when d < a then 'lower'
               else 'same' end as comparison from x join c using (pay_month)""")
def dept_vs_company(t):
    return op.dept_vs_company(
        t.orders.selectExpr("o_orderdate as pay_date", "o_orderpriority as department_id", "o_totalprice as amount")
    )


@query("""select l_orderkey as customer_id from lineitem join part on l_partkey = p_partkey group by 1
          having count(distinct p_type) = (select count(distinct p_type) from part)""")
def customers_all_products(t):
    bought = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return op.customers_all_products(
        bought.selectExpr("l_orderkey as customer_id", "p_type as product_key"),
        t.part.selectExpr("p_type as product_key"),
    )


@query("""select least(buyer_nation, seller_nation) as person1, greatest(buyer_nation, seller_nation)
          as person2, count(*) as call_count, cast(sum(l_quantity) as bigint) as total_duration
          from flows group by 1, 2""", views="flows")
def calls_between_pairs(t):
    return op.calls_between_pairs(
        nation_flows(t).selectExpr("buyer_nation as from_id", "seller_nation as to_id",
                                   "cast(l_quantity as bigint) as duration")
    )


@query("select o_custkey as user_id, count(o_orderkey) as followers_count from orders group by 1")
def followers_count(t):
    return op.followers_count(t.orders.selectExpr("o_custkey as user_id", "o_orderkey as follower_id"))


@query("select l_suppkey as teacher_id, count(distinct l_partkey) as cnt from lineitem group by 1")
def unique_subjects(t):
    return op.unique_subjects(t.lineitem.selectExpr("l_suppkey as teacher_id", "l_partkey as subject_id"))


@query("select count(distinct o_custkey) as rich_count from orders where o_totalprice > 300000")
def rich_customers(t):
    return op.rich_customers(t.orders.selectExpr("o_custkey as customer_id", "o_totalprice as amount"), 300000)


@query("""select max(num) as num from (select l_extendedprice as num from lineitem group by 1
          having count(*) = 1)""")
def biggest_single_number(t):
    return op.biggest_single_number(t.lineitem.selectExpr("l_extendedprice as num"))


SIGNED = "case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end"


@query(f"""select l_partkey as customer_id from lineitem where year(l_shipdate) = 2000 group by 1
           having sum(cast({SIGNED} as decimal(18,6))) > 0""")
def positive_revenue(t):
    return op.positive_revenue(
        t.lineitem.selectExpr("l_partkey as customer_id", "l_shipdate as billed_on", f"{SIGNED} as revenue"), 2000
    )


@query(f"""select c_name as name, {total('o_totalprice')} as balance from customer join orders
           on o_custkey = c_custkey group by c_custkey, c_name having {total('o_totalprice')} > 3000000""")
def rich_balance(t):
    return op.rich_balance(
        t.customer.selectExpr("c_custkey as account", "c_name as name"),
        t.orders.selectExpr("o_custkey as account", "o_totalprice as amount"), 3000000,
    )


@query(f"""select event_type as contest_id, {r('100.0 * count(distinct user_id) / '
           '(select count(distinct user_id) from events)')} as percentage from events group by 1""")
def contest_percentage(t):
    return op.contest_percentage(
        t.events.selectExpr("event_type as contest_id", "user_id"), t.events.select("user_id").distinct()
    )


@query(f"""select l_returnflag as query_name, {r('avg((l_discount * 100 + 1) / l_linenumber)')} as quality,
           {r('100.0 * count(*) filter (where l_discount * 100 + 1 < 3) / count(*)')} as poor_query_percentage
           from lineitem group by 1""")
def query_quality(t):
    return op.query_quality(
        t.lineitem.selectExpr("l_returnflag as query_name", "l_discount * 100 + 1 as rating",
                              "l_linenumber as position")
    )


@query(f"""with a as (select cast(ts as date) as d, user_id, event_type from events),
           x as (select user_id from events where event_type = 'signup'),
           h as (select d, count(distinct user_id) as hits from a where event_type = 'error'
                 and user_id in (select user_id from x) group by 1),
           p as (select d, count(distinct user_id) as posts from a group by 1)
           select {r('sum(100.0 * hits / posts) / count(*)')} as average_daily_percent from h join p using (d)""")
def reported_posts(t):
    actions = t.events.select(
        day("ts").alias("action_date"), F.col("user_id").alias("post_id"),
        F.when(F.col("event_type") == "error", "spam").alias("extra"),
    )
    return op.reported_posts(actions, t.events.where("event_type = 'signup'").selectExpr("user_id as post_id"))


@query("""with m as (select o_custkey as k, strftime(o_orderdate, '%Y-%m') as m,
              sum(cast(o_totalprice as decimal(18,6))) as s from orders where o_orderstatus = 'F' group by 1, 2)
          select distinct k as account_id from m join customer on c_custkey = k
          where s > cast(c_acctbal * 60 as decimal(18,6))""")
def suspicious_accounts(t):
    return op.suspicious_accounts(
        t.orders.selectExpr("o_custkey as account_id", "o_orderdate as day", "o_totalprice as amount",
                            "if(o_orderstatus = 'F', 'Creditor', 'Debtor') as type"),
        t.customer.selectExpr("c_custkey as account_id", "cast(c_acctbal * 60 as decimal(18,6)) as max_income"),
    )


@query("""select cast(ts as date) as day, count(distinct user_id) as active_sessions from events
          where cast(ts as date) > date '2024-01-27' - 30 and cast(ts as date) <= date '2024-01-27' group by 1""")
def active_sessions(t):
    return op.active_sessions(
        t.events.select(day("ts").alias("activity_date"), F.col("user_id").alias("session_id")), "2024-01-27"
    )


@query("""select cast(ts as date) as sell_date, count(distinct event_type) as num_sold,
          string_agg(distinct event_type, ',' order by event_type) as products from events group by 1""")
def products_by_date(t):
    return op.products_by_date(t.events.select(day("ts").alias("sell_date"), F.col("event_type").alias("product")))


@query("""select o_custkey as user_id, max(o_orderdate) as last_stamp from orders
          where year(o_orderdate) = 2000 group by 1""")
def latest_login(t):
    return op.latest_login(t.orders.selectExpr("o_custkey as user_id", "o_orderdate as time_stamp"), 2000)


@query(f"""select c_custkey as user_id, {r("coalesce(sum(case when o_orderstatus = 'F' then 1 else 0 end) / "
           "nullif(count(o_orderkey), 0), 0)")} as confirmation_rate
           from customer left join orders on o_custkey = c_custkey group by 1""")
def confirmation_rate(t):
    return op.confirmation_rate(
        t.customer.selectExpr("c_custkey as user_id"),
        t.orders.selectExpr("o_custkey as user_id", "if(o_orderstatus = 'F', 'confirmed', 'timeout') as action"),
    )


@query(f"""select replace(p_brand, 'Brand', 'Category') as category, count(distinct l_orderkey) as total_orders,
           {total('l_extendedprice')} as total_revenue, {r(mean('l_extendedprice'))} as avg_price
           from lineitem join part on l_partkey = p_partkey group by 1
           order by total_revenue desc, category limit 10""")
def category_revenue_top10(t):
    names = t.part.selectExpr("p_brand as category_name", "replace(p_brand, 'Brand', 'Category') as category")
    return op.category_revenue_top10(
        t.lineitem.selectExpr("l_orderkey as order_id", "l_partkey as product_id", "l_extendedprice as price"),
        t.part.selectExpr("p_partkey as product_id", "p_brand as category_name"), names.distinct(),
    )


DONE = """select o_custkey as customer_id, o_orderstatus, o_orderdate, max(l_shipdate) as delivered_at
    from orders join lineitem on l_orderkey = o_orderkey where o_orderstatus = 'F' group by o_orderkey, 1, 2, 3"""


def delivered(t):
    ship = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("delivered_at"))
    return t.orders.join(ship, "o_orderkey", "left").selectExpr(
        "o_custkey as customer_id", "if(o_orderstatus = 'F', 'delivered', 'open') as order_status",
        "o_orderdate as purchased_at", "delivered_at", "o_orderdate + interval 60 days as estimated_at",
    )


def states(t):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "c_custkey as customer_id", "n_name as customer_state"
    )


@query(f"""select n_name as customer_state, {r(mean("datediff('day', o_orderdate, delivered_at)"), 1)}
           as avg_delivery_days, count(*) as total_orders from ({DONE}) join customer on c_custkey = customer_id
           join nation on n_nationkey = c_nationkey group by 1""")
def delivery_days_by_state(t):
    return op.delivery_days_by_state(states(t), delivered(t))


@query(f"""select p_brand as category, count(*) as total_reviews, {r('avg(a.l_linenumber)')} as avg_score,
           count(*) filter (where a.l_linenumber >= 4) as positive,
           count(*) filter (where a.l_linenumber <= 2) as negative,
           {r('100.0 * count(*) filter (where a.l_linenumber <= 2) / count(*)')} as negative_rate_pct
           from lineitem a join orders on a.l_orderkey = o_orderkey join lineitem b on b.l_orderkey = o_orderkey
           join part on b.l_partkey = p_partkey group by 1 having count(*) > 100
           order by negative_rate_pct desc, category limit 15""")
def review_distribution(t):
    return op.review_distribution(
        t.lineitem.selectExpr("l_orderkey as order_id", "l_linenumber as review_score"),
        t.orders.selectExpr("o_orderkey as order_id"),
        t.lineitem.selectExpr("l_orderkey as order_id", "l_partkey as product_id"),
        t.part.selectExpr("p_partkey as product_id", "p_brand as category"),
    )


@query(f"""select count(*) as total_customers, count(*) filter (where n > 1) as repeat_customers,
           {r('100.0 * count(*) filter (where n > 1) / count(*)')} as repeat_rate_pct from
           (select c_name, count(*) as n from customer join orders on o_custkey = c_custkey group by 1)""")
def repeat_customers(t):
    return op.repeat_customers(
        t.customer.selectExpr("c_custkey as customer_id", "c_name as customer_unique_id"),
        t.orders.selectExpr("o_custkey as customer_id"),
    )


@query(f"""select n_name as customer_state, case when delivered_at > o_orderdate + interval 60 day
           then 'Late' else 'On time' end as delivery_status, count(*) as total_orders
           from ({DONE}) join customer on c_custkey = customer_id
           join nation on n_nationkey = c_nationkey group by 1, 2""")
def late_delivery_by_state(t):
    return op.late_delivery_by_state(delivered(t), states(t))


@query(f"""select case when grouping(r_name) = 1 then 'ALL STATES' else r_name end as state,
           case when grouping(n_name) = 1 then 'ALL CITIES' else n_name end as city,
           count(distinct l_orderkey) as total_orders, {r(total('l_extendedprice'))} as revenue
           from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
           join region on n_regionkey = r_regionkey group by rollup(r_name, n_name)""")
def revenue_rollup(t):
    cities = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    sellers = t.supplier.join(cities, F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
        "s_suppkey as seller_id", "r_name as seller_state", "n_name as seller_city"
    )
    return op.revenue_rollup(
        t.lineitem.selectExpr("l_suppkey as seller_id", "l_orderkey as order_id", "l_extendedprice as price"), sellers
    )


@query(f"""select payment_type, {r(total('fare_amount'))} as fare_amount_sum from trips group by 1""", views="trips")
def group_sum(t):
    return op.group_sum(t.trips, ["payment_type"], "fare_amount")


@query(f"""select payment_type, passenger_count, {r(mean('fare_amount'))} as fare_amount_mean from trips
           where passenger_count is not null group by 1, 2""", views="trips")
def group_mean_multi(t):
    return op.group_mean_multi(t.trips, ["payment_type", "passenger_count"], "fare_amount")


@query(f"""select payment_type, {total('fare_amount')} as total_revenue, {r(mean('fare_amount'), 6)} as avg_fare,
           count(fare_amount) as trip_count from trips group by 1""", views="trips")
def group_sum_mean_count(t):
    return op.group_sum_mean_count(t.trips, "payment_type", "fare_amount")


@query(f"""select payment_type, {total('fare_amount')} as total_revenue,
           {r('avg(fare_amount / trip_distance)', 6)} as avg_revenue_per_mile, count(*) as trips
           from trips where fare_amount > 0 and trip_distance > 0 group by 1""", views="trips")
def lazy_revenue_per_mile(t):
    return op.lazy_revenue_per_mile(t.trips)


@query(f"""select count(value) as count, {r(mean('value'), 4)} as mean, {r('stddev_samp(value)', 4)} as std,
           min(value) as min, max(value) as max, {r('quantile_cont(value, 0.25)', 4)} as q25,
           {r('quantile_cont(value, 0.5)', 4)} as q50, {r('quantile_cont(value, 0.75)', 4)} as q75 from events""")
def describe_column(t):
    return op.describe_column(t.events.select("value"), "value")


@query("""select count(*) filter (where fare_amount < 0) as negative, count(*) filter (where fare_amount = 0)
          as zero, count(*) filter (where fare_amount > 200) as over_limit from trips""", views="trips")
def sign_counts(t):
    return op.sign_counts(t.trips, "fare_amount", 200)


@query(f"""select {r(mean('trip_distance'))} as avg_distance, max(trip_distance) as max_distance,
           count(*) filter (where trip_distance = 0) as zero_distance,
           count(*) filter (where trip_distance > 50) as far_trips,
           {r('quantile_cont(trip_distance, 0.5)')} as median_distance from trips""", views="trips")
def distance_stats(t):
    return op.distance_stats(t.trips)


@query(f"""select passenger_count, count(*) as n, {r('100.0 * count(*) / (select count(*) from trips)', 1)} as pct
           from trips where passenger_count is not null group by 1""", views="trips")
def value_share(t):
    return op.value_share(t.trips, "passenger_count")


@query("select user_id, count(*) as n from events group by 1 order by n desc, user_id limit 10")
def value_counts_top(t):
    return op.value_counts_top(t.events, "user_id", 10)


@query(f"""select payment_type, {r(mean('tip_amount'))} as avg_tip,
           {r('quantile_cont(tip_amount, 0.5)')} as median_tip,
           count(*) filter (where tip_amount = 0) as zero_tips from trips
           where payment_type in ('click', 'view') group by 1""", views="trips")
def tip_stats_by_payment(t):
    return op.tip_stats_by_payment(t.trips, ["click", "view"])


@query(f"""select case when fare_amount < 10 then 'low' when fare_amount < 30 then 'medium'
           when fare_amount < 100 then 'high' else 'premium' end as fare_bucket, count(fare_amount) as trips,
           {r(total('fare_amount'))} as revenue, {r(mean('fare_amount'))} as avg_fare from trips group by 1""",
       views="trips")
def bucket_summary(t):
    return op.bucket_summary(t.trips)


@query(f"""with h as (select dayname(pickup_ts) as d, hour(pickup_ts) as hour, count(*) as n from trips group by 1, 2),
           b as (select d, cast(arg_min(hour, (-n, hour)) as int) as busiest_hour, max(n) as trips from h group by 1),
           s as (select dayname(pickup_ts) as d, {total('fare_amount')} as total_revenue, count(*) as total_trips,
               {r(mean('tip_amount'))} as avg_tip from trips group by 1)
           select d as day_of_week, total_revenue, total_trips, avg_tip, busiest_hour, trips,
           cast(rank() over (order by total_revenue desc) as int) as revenue_rank from s join b using (d)""",
       views="trips")
def weekday_cohort(t):
    return op.weekday_cohort(t.trips)


@query("""with o as (select cast(date_trunc('month', o_orderdate) as date) as month,
              sum(cast(l_extendedprice as decimal(18,2)) + cast(l_extendedprice as decimal(18,2))
                  * cast(l_tax as decimal(4,2))) as revenue
              from orders join lineitem on l_orderkey = o_orderkey where o_orderstatus = 'F' group by 1),
          p as (select *, lag(revenue) over (order by month) as prev from o)
          select month, cast(round(revenue, 2) as double) as revenue, cast(round(prev, 2) as double) as prev_month,
          cast(round(cast(100 * cast(revenue - prev as double) / nullif(cast(prev as double), 0)
              as decimal(30,8)), 2) as double) as mom_growth_pct from p""")
def month_over_month(t):
    orders = t.orders.selectExpr("o_orderkey as order_id", "o_orderdate as purchased_at",
                                 "if(o_orderstatus = 'F', 'delivered', 'open') as order_status")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    items = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), price.alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).alias("freight_value"),
    )
    return op.month_over_month(orders, items)


@query(f"""select o_orderpriority as payment_type, {r(total('o_totalprice'))} as total_value,
           {r(mean('o_orderkey % 6 + 1'), 1)} as avg_installments,
           {r(f"100 * {total('o_totalprice')} / (select {total('o_totalprice')} from orders)")} as revenue_share_pct
           from orders group by 1""")
def payment_share(t):
    return op.payment_share(
        t.orders.selectExpr("o_orderpriority as payment_type", "o_totalprice as payment_value",
                            "o_orderkey % 6 + 1 as installments")
    )
