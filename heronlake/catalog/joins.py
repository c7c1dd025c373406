"""Joins on the test tables."""

from pyspark.sql import functions as F

from heronlake.catalog.registry import mean, query, r, total
from heronlake.functions.timeparts import day
from heronlake.operators import joins as op
from heronlake.sources.views import nation_flows

EMP = "select c_custkey as id, c_name as name, c_custkey // 7 as manager_id, c_nationkey + 20 as age from customer"
# Order priorities of the test tables.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def emp(t):
    return t.customer.selectExpr(
        "c_custkey as id", "c_name as name", "c_custkey div 7 as manager_id", "c_nationkey + 20 as age"
    )


@query("""select o_orderkey as person_id, o_custkey as last_name, l_partkey as city, l_quantity as state
          from orders left join lineitem on o_orderkey = l_orderkey""")
def person_address(t):
    return op.person_address(
        t.orders.selectExpr("o_orderkey as person_id", "o_custkey as last_name"),
        t.lineitem.selectExpr("l_orderkey as person_id", "l_partkey as city", "l_quantity as state"),
    )


@query(f"""with e as ({EMP}) select m.id, m.name from e m join e r on r.manager_id = m.id
           group by m.id, m.name having count(*) >= 5""")
def managers_min_reports(t):
    return op.managers_min_reports(emp(t), 5)


@query(f"""with e as ({EMP}) select m.id, m.name, count(*) as reports_count,
           {r(mean('r.age'), 0)} as average_age from e m join e r on r.manager_id = m.id
           group by m.id, m.name""")
def reports_per_manager(t):
    return op.reports_per_manager(emp(t))


@query("""select n_name as department, s_name as employee, s_acctbal as salary
          from supplier join nation on s_nationkey = n_nationkey
          where (s_nationkey, s_acctbal) in (select s_nationkey, max(s_acctbal) from supplier group by 1)""")
def dept_highest_salary(t):
    return op.dept_highest_salary(
        t.supplier.selectExpr("s_nationkey as dept_id", "s_name as employee", "s_acctbal as salary"),
        t.nation.selectExpr("n_nationkey as dept_id", "n_name as department"),
    )


@query("""select p_name as product_name, cast(year(l_shipdate) as int) as year, l_extendedprice as price
          from lineitem join part on l_partkey = p_partkey""")
def product_sales(t):
    return op.product_sales(
        t.lineitem.selectExpr("l_partkey as product_id", "year(l_shipdate) as year", "l_extendedprice as price"),
        t.part.selectExpr("p_partkey as product_id", "p_name as product_name"),
    )


@query("""select l_suppkey as warehouse, cast(sum(p_size * (p_partkey % 11 + 1) * (p_size % 7 + 1)
          * cast(l_quantity as bigint)) as bigint) as volume
          from lineitem join part on l_partkey = p_partkey group by 1""")
def warehouse_volume(t):
    return op.warehouse_volume(
        t.lineitem.selectExpr("l_suppkey as warehouse", "l_partkey as product_id", "cast(l_quantity as bigint) as units"),
        t.part.selectExpr("p_partkey as product_id", "p_size as width", "p_partkey % 11 + 1 as length",
                          "p_size % 7 + 1 as height"),
    )


@query("""select o_orderkey as emp_id, l_quantity as bonus from orders left join lineitem
          on o_orderkey = l_orderkey where l_quantity < 10 or l_quantity is null""")
def employee_bonus(t):
    return op.employee_bonus(
        t.orders.selectExpr("o_orderkey as emp_id"),
        t.lineitem.selectExpr("l_orderkey as emp_id", "l_quantity as bonus"), 10,
    )


@query(f"""select cast(l_shipdate as date) as day,
           {r("sum(case when l_returnflag = 'R' then 1 else 0 end) / count(*)")} as cancellation_rate
           from flows join nation c on buyer_nation = c.n_nationkey and c.n_regionkey <> 0
           join nation d on seller_nation = d.n_nationkey and d.n_regionkey <> 0
           where l_shipdate between '1998-10-01' and '1998-12-31' group by 1""", views="flows")
def cancellation_rate(t):
    trips = nation_flows(t).select(
        F.col("buyer_nation").alias("client_id"), F.col("seller_nation").alias("driver_id"),
        F.when(F.col("l_returnflag") == "R", "cancelled_by_client").otherwise("completed").alias("status"),
        day("l_shipdate").alias("request_at"),
    )
    users = t.nation.selectExpr("n_nationkey as user_id", "if(n_regionkey = 0, 'Yes', 'No') as banned")
    return op.cancellation_rate(trips, users, "1998-10-01", "1998-12-31")


@query("""select c_custkey as user_id, (select cast(min(o_orderdate) as date) from orders
          where o_custkey = c_custkey) as join_date, count(o_orderkey) as orders_in_year
          from customer left join orders on o_custkey = c_custkey and year(o_orderdate) = 2001
          group by c_custkey""")
def market_analysis(t):
    orders = t.orders.select(F.col("o_custkey").alias("user_id"), day("o_orderdate").alias("order_date"))
    joined = orders.groupBy("user_id").agg(F.min("order_date").alias("join_date"))
    users = t.customer.selectExpr("c_custkey as user_id").join(joined, "user_id", "left")
    return op.market_analysis(users, orders, 2001)


@query(f"""select c_name as name, coalesce({total('o_totalprice')}, 0) as travelled_distance
           from customer left join orders on o_custkey = c_custkey group by c_custkey, c_name""")
def top_travellers(t):
    return op.top_travellers(
        t.customer.selectExpr("c_custkey as user_id", "c_name as name"),
        t.orders.selectExpr("o_custkey as user_id", "o_totalprice as distance"),
    )


@query("""with s as (select l_suppkey, l_partkey, row_number() over (partition by l_suppkey
              order by o_orderdate, l_partkey) as rn from lineitem join orders on l_orderkey = o_orderkey)
          select s_suppkey as seller_id, case when p_brand = 'Brand#' || (s_suppkey % 25 + 1)
              then 'yes' else 'no' end as second_item_fav_brand
          from supplier left join s on s.l_suppkey = s_suppkey and rn = 2
          left join part on p_partkey = s.l_partkey""")
def second_item_brand(t):
    sales = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return op.second_item_brand(
        t.supplier.selectExpr("s_suppkey as seller_id", "concat('Brand#', s_suppkey % 25 + 1) as favorite_brand"),
        sales.selectExpr("l_suppkey as seller_id", "o_orderdate as order_date", "l_partkey as item_id"),
        t.part.selectExpr("p_partkey as item_id", "p_brand as item_brand"),
    )


@query("""select o_custkey as customer_id, count(*) as count_no_trans from orders
          where o_orderkey not in (select l_orderkey from lineitem) group by 1""")
def visits_without_txn(t):
    return op.visits_without_txn(
        t.orders.selectExpr("o_orderkey as visit_id", "o_custkey as customer_id"),
        t.lineitem.selectExpr("l_orderkey as visit_id"),
    )


@query("""select c_name as seller_name from customer where c_custkey not in
          (select o_custkey from orders where year(o_orderdate) = 2001)""")
def sellers_no_sales(t):
    return op.sellers_no_sales(
        t.customer.selectExpr("c_custkey as seller_id", "c_name as seller_name"),
        t.orders.selectExpr("o_custkey as seller_id", "o_orderdate as sale_date"), 2001,
    )


@query("select o_orderkey as order_id from orders where o_orderkey not in (select l_orderkey from lineitem)")
def orders_no_payment(t):
    return op.orders_no_payment(
        t.orders.selectExpr("o_orderkey as order_id"), t.lineitem.selectExpr("l_orderkey as order_id")
    )


@query("""with x as (select o_orderpriority as p, max(o_totalprice) as hi, min(o_totalprice) as lo
              from orders group by 1)
          select c_custkey as student_id, c_name as student_name from customer
          where c_custkey in (select o_custkey from orders) and c_custkey not in
          (select o_custkey from orders join x on p = o_orderpriority
           where o_totalprice = hi or o_totalprice = lo)""")
def quiet_students(t):
    return op.quiet_students(
        t.customer.selectExpr("c_custkey as student_id", "c_name as student_name"),
        t.orders.selectExpr("o_custkey as student_id", "o_orderpriority as exam_id", "o_totalprice as score"),
    )


@query("""select p_partkey as product_id, p_name as product_name from part
          where p_partkey in (select l_partkey from lineitem) and p_partkey not in
          (select l_partkey from lineitem where l_shipdate not between '1995-06-01' and '2001-06-30')""")
def only_in_window(t):
    return op.only_in_window(
        t.lineitem.select(F.col("l_partkey").alias("product_id"), day("l_shipdate").alias("sale_date")),
        t.part.selectExpr("p_partkey as product_id", "p_name as product_name"),
        "1995-06-01", "2001-06-30",
    )


PLACE = "select c_nationkey as tiv_2015, c_acctbal as tiv_2016, c_mktsegment as lat, floor(c_acctbal) as lon from customer"


@query(f"""with p as ({PLACE}) select {r(total('tiv_2016'))} as tiv_2016 from p
           where tiv_2015 in (select tiv_2015 from p group by 1 having count(*) > 1)
           and (lat, lon) in (select lat, lon from p group by 1, 2 having count(*) = 1)""")
def investments_in(t):
    return op.investments_in(
        t.customer.selectExpr("c_nationkey as tiv_2015", "c_acctbal as tiv_2016", "c_mktsegment as lat",
                              "floor(c_acctbal) as lon")
    )


@query("""with c as (select l_partkey, cast(l_shipdate as date) as d, max(l_extendedprice) as p
              from lineitem group by 1, 2)
          select l_partkey as product_id, coalesce(arg_max(p, d) filter (where d <= '1998-08-16'), 10) as price
          from c group by 1""")
def price_at_date(t):
    changes = t.lineitem.groupBy(
        F.col("l_partkey").alias("product_id"), day("l_shipdate").alias("change_date")
    ).agg(F.max("l_extendedprice").alias("new_price"))
    return op.price_at_date(changes, "1998-08-16")


@query(f"""with w as (select cast(ts as date) as d, {total('value')} as v from events group by 1)
           select a.d as record_date from w a join w b on b.d = a.d - 1 where a.v > b.v""")
def rising_temperature(t):
    from heronlake.functions.exact import total as add

    weather = t.events.groupBy(day("ts").alias("record_date")).agg(add("value").alias("temperature"))
    return op.rising_temperature(weather)


@query("""select distinct a.p_partkey as seat_id from part a join part b
          on b.p_partkey in (a.p_partkey - 1, a.p_partkey + 1) where a.p_size > 25 and b.p_size > 25""")
def adjacent_free_seats(t):
    return op.adjacent_free_seats(t.part.selectExpr("p_partkey as seat_id", "p_size > 25 as free"))


@query("""select distinct s as num from (select o_orderstatus as s, o_orderkey as k,
              lead(o_orderkey, 1) over w as k1, lead(o_orderstatus, 1) over w as s1,
              lead(o_orderkey, 2) over w as k2, lead(o_orderstatus, 2) over w as s2
              from orders window w as (order by o_orderkey))
          where k1 = k + 1 and k2 = k + 2 and s1 = s and s2 = s""")
def consecutive_numbers(t):
    return op.consecutive_numbers(t.orders.selectExpr("o_orderkey as id", "o_orderstatus as num"))


@query(f"""with p as (select l_partkey as k, year(l_shipdate) as y, max(l_extendedprice) as price
               from lineitem group by 1, 2)
           select k as product_id, {r('coalesce(sum(cast(price as decimal(18,6)) * cast(l_quantity as bigint)) /'
           ' nullif(cast(sum(l_quantity) as double), 0), 0)')} as average_price
           from p left join lineitem on l_partkey = k and year(l_shipdate) = y + 1 group by 1""")
def average_selling_price(t):
    year = F.year("l_shipdate")
    prices = t.lineitem.groupBy(F.col("l_partkey").alias("product_id"), year.alias("y")).agg(
        F.max("l_extendedprice").alias("price")
    ).select(
        "product_id", "price", F.make_date(F.col("y") + 1, F.lit(1), F.lit(1)).alias("start_date"),
        F.make_date(F.col("y") + 1, F.lit(12), F.lit(31)).alias("end_date"),
    )
    units = t.lineitem.select(
        F.col("l_partkey").alias("product_id"), day("l_shipdate").alias("purchase_date"),
        F.col("l_quantity").cast("long").alias("units"),
    )
    return op.average_selling_price(prices, units)


@query("""select distinct a.user_id as account_id from sessions a join sessions b on a.user_id = b.user_id
          and a.event_type <> b.event_type and a.start_ts <= b.end_ts and b.start_ts <= a.end_ts""",
       views="sessions")
def overlapping_sessions(t):
    return op.overlapping_sessions(
        t.sessions.selectExpr("user_id as account_id", "event_type as ip_address", "start_ts as login",
                              "end_ts as logout")
    )


@query(f"""select user_id as machine_id, {r(mean('s'), 3)} as processing_time from
           (select user_id, cast(ts as date) as d, cast(epoch_us(max(ts)) - epoch_us(min(ts)) as double)
            / 1000000 as s from events group by 1, 2) group by 1""")
def process_time(t):
    spans = t.events.groupBy(F.col("user_id").alias("machine_id"), day("ts").alias("process_id")).agg(
        F.min("ts").alias("start"), F.max("ts").alias("end")
    )
    activity = spans.unpivot(["machine_id", "process_id"], ["start", "end"], "activity_type", "timestamp")
    return op.process_time(activity)


@query(f"""with s(p) as (values {', '.join(f"('{p}')" for p in PRIORITIES)})
           select c_custkey as student_id, c_name as student_name, p as subject,
           count(o_orderkey) as attended_exams from customer cross join s
           left join orders on o_custkey = c_custkey and o_orderpriority = p group by 1, 2, 3""")
def students_examinations(t):
    return op.students_examinations(
        t.customer.selectExpr("c_custkey as student_id", "c_name as student_name"), PRIORITIES,
        t.orders.selectExpr("o_custkey as student_id", "o_orderpriority as subject"),
    )
