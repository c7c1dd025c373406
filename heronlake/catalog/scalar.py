"""Projections, filters and scalar functions."""

from pyspark.sql import functions as F

from heronlake.catalog.registry import query, r
from heronlake.operators import scalar as op


@query(f"""select trip_id, fare_amount as fare,
           {r('fare_amount / nullif(trip_distance, 0)')} as revenue_per_mile,
           case when fare_amount < 10 then 'low' when fare_amount < 30 then 'medium' else 'high' end
           as fare_bucket from trips""", views="trips")
def select_computed(t):
    return op.select_computed(t.trips)


@query("select event_id, value from events where value > 100")
def filter_threshold(t):
    return op.filter_threshold(t.events.select("event_id", "value"), "value", 100)


@query("select s_suppkey as supplier_key, s_name as supplier_name from supplier")
def normalize_column_names(t):
    return op.normalize_column_names(
        t.supplier.select(F.col("s_suppkey").alias("Supplier Key"), F.col("s_name").alias("Supplier Name"))
    )


@query("""select event_id, case when value < 10 then 'low' when value < 30 then 'medium'
          when value < 100 then 'high' else 'premium' end as bucket from events""")
def bucket_case(t):
    return t.events.select("event_id", op.bucket_case("value").alias("bucket"))


@query("""select trip_id, case when fare_amount >= 0 and fare_amount < 10 then 'low'
          when fare_amount >= 10 and fare_amount < 30 then 'medium'
          when fare_amount >= 30 and fare_amount < 100 then 'high'
          when fare_amount >= 100 then 'premium' end as fare_bucket from trips""", views="trips")
def bucket_cut(t):
    return t.trips.select("trip_id", op.bucket_cut("fare_amount").alias("fare_bucket"))


@query("""select *, case when x + y > z and y + z > x and x + z > y then 'Yes' else 'No' end as triangle
          from (select p_partkey, p_size as x, p_size % 7 + 1 as y, p_partkey % 11 + 1 as z from part)""")
def triangle_judgement(t):
    return op.triangle_judgement(
        t.part.selectExpr("p_partkey", "p_size as x", "p_size % 7 + 1 as y", "p_partkey % 11 + 1 as z")
    )


@query("""select p_partkey as employee_id, case when p_partkey % 2 = 1 and left(p_type, 1) <> 'M'
          then p_retailprice else 0 end as bonus from part""")
def special_bonus(t):
    return op.special_bonus(
        t.part.selectExpr("p_partkey as employee_id", "p_type as name", "p_retailprice as salary")
    )


@query("""select case when id % 2 = 1 and id + 1 <= (select count(*) from customer) then id + 1
          when id % 2 = 0 then id - 1 else id end as id, student
          from (select c_custkey + 1 as id, c_name as student from customer)""")
def exchange_seats(t):
    return op.exchange_seats(t.customer.selectExpr("c_custkey + 1 as id", "c_name as student"))


@query("select p_partkey, p_name from part where p_name like 'gi%' or p_name like '% gi%'")
def prefix_token_match(t):
    return op.prefix_token_match(t.part.select("p_partkey", "p_name"), "p_name", "gi")


MAIL = """case c_custkey % 4 when 0 then lower(replace(c_name, '#', '_'))
          when 1 then concat('7', lower(c_name)) when 2 then replace(c_name, '#', '.')
          else lower(c_name) end"""
HOST = "case when c_custkey % 5 = 0 then '@examplexcom' else '@example.com' end"


@query(f"""select * from (select c_custkey, concat({MAIL}, {HOST}) as mail from customer)
           where regexp_matches(mail, '^[a-zA-Z][a-zA-Z0-9_.-]*@example\\.com$')""")
def valid_email_sql(t):
    users = t.customer.selectExpr("c_custkey", f"concat({MAIL}, {HOST}) as mail")
    return op.valid_email_sql(users, "example.com")


@query("""select c_custkey, concat(upper(left(c_mktsegment, 1)), lower(substring(c_mktsegment, 2))) as name
          from customer""")
def fix_names(t):
    return op.fix_names(t.customer.selectExpr("c_custkey", "c_mktsegment as name"))


CODE = """case event_type when 'click' then 1 when 'view' then 2 when 'purchase' then 3
          when 'error' then 4 else 9 end"""
# Payment codes and their labels.
PAYMENT_LABELS = {1: "Credit card", 2: "Cash", 3: "No charge", 4: "Dispute", 5: "Unknown"}


@query(f"""select event_id, case {CODE} when 1 then 'Credit card' when 2 then 'Cash'
           when 3 then 'No charge' when 4 then 'Dispute' else 'Type 9' end as label from events""")
def label_map_lookup(t):
    coded = t.events.selectExpr("event_id", f"{CODE} as code")
    return coded.select("event_id", op.label_map_lookup("code", PAYMENT_LABELS).alias("label"))


@query("select trip_id, passenger_count * 2 as doubled from trips", views="trips")
def null_safe_double(t):
    return t.trips.select("trip_id", op.null_safe_double("passenger_count").alias("doubled"))
