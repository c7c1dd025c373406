"""Cleaning on the test tables."""

from pyspark.sql import functions as F

from heronlake.catalog.registry import mean, query, r
from heronlake.operators import cleaning as op

NULLABLE = ["passenger_count", "tip_amount", "congestion_surcharge"]


@query(" union all ".join(
    f"""select '{c}' as column_name, count(*) filter (where {c} is null) as null_count,
        {r(f'100.0 * count(*) filter (where {c} is null) / count(*)')} as null_pct from trips""" for c in NULLABLE),
       views="trips")
def null_profile(t):
    return op.null_profile(t.trips)


@query("""select trip_id, passenger_count, tip_amount from trips
          where passenger_count is not null and tip_amount is not null""", views="trips")
def drop_nulls(t):
    rows = t.trips.select("trip_id", "passenger_count", "tip_amount")
    return op.drop_nulls(rows, ["passenger_count", "tip_amount"])


@query(f"""select count(*) as rows_before, count(*) filter (where p) as rows_after,
           count(*) filter (where not p) as dropped, {r('100.0 * count(*) filter (where not p) / count(*)')}
           as dropped_pct from (select passenger_count is not null and tip_amount is not null as p from trips)""",
       views="trips")
def drop_report(t):
    return op.drop_report(t.trips, ["passenger_count", "tip_amount"])


@query("""select trip_id, coalesce(passenger_count, 1) as passenger_count, coalesce(tip_amount, 0) as tip_amount,
          coalesce(congestion_surcharge, 0) as congestion_surcharge from trips""", views="trips")
def fill_by_column(t):
    defaults = {"passenger_count": 1, "tip_amount": 0.0, "congestion_surcharge": 0.0, "airport_fee": 0.0}
    return op.fill_by_column(t.trips.select("trip_id", *NULLABLE), defaults)


@query("""select trip_id, coalesce(passenger_count, 1) as passenger_count,
          passenger_count is null as passenger_count_was_null from trips""", views="trips")
def flag_and_fill(t):
    return op.flag_and_fill(t.trips.select("trip_id", "passenger_count"), "passenger_count", 1)


@query("""select trip_id, payment_type, coalesce(tip_amount, m) as tip_amount from trips join
          (select payment_type, median(tip_amount) as m from trips group by 1) using (payment_type)""", views="trips")
def fill_group_median(t):
    return op.fill_group_median(t.trips.select("trip_id", "payment_type", "tip_amount"), "payment_type", "tip_amount")


@query("""select count(*) - (select count(*) from (select distinct text, lang, source, n_chars from documents)) as duplicates
          from documents""")
def count_exact_duplicates(t):
    return op.count_exact_duplicates(t.documents.drop("doc_id"))


@query("""select cast(sum(n - 1) as bigint) as duplicates from (select count(*) as n from lineitem
          group by l_partkey, l_suppkey, l_quantity)""")
def count_key_duplicates(t):
    return op.count_key_duplicates(t.lineitem, ["l_partkey", "l_suppkey", "l_quantity"])


@query("""with e as (select event_id, user_id, event_type, hour(ts) as h, value from events)
          select 'first' as keep, event_id, user_id, event_type, cast(h as int) as h, value from e
          where event_id in (select min(event_id) from e group by user_id, event_type, h)
          union all select 'last', event_id, user_id, event_type, cast(h as int), value from e
          where event_id in (select max(event_id) from e group by user_id, event_type, h)""")
def dedup_keep(t):
    rows = t.events.select("event_id", "user_id", "event_type", F.hour("ts").alias("h"), "value")
    keys = ["user_id", "event_type", "h"]
    kept = [op.dedup_keep(rows, keys, ["event_id"], k).withColumn("keep", F.lit(k)) for k in ("first", "last")]
    return kept[0].unionByName(kept[1])


@query("""select l_orderkey, l_partkey, l_suppkey, l_quantity from lineitem
          where (l_partkey, l_suppkey, l_quantity) in
          (select l_partkey, l_suppkey, l_quantity from lineitem group by 1, 2, 3 having count(*) > 1)""")
def all_duplicates(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    return op.all_duplicates(rows, ["l_partkey", "l_suppkey", "l_quantity"])


@query("""select o_custkey, strftime(o_orderdate, '%Y-%m') as month, o_orderkey, o_totalprice from orders
          qualify row_number() over (partition by o_custkey, strftime(o_orderdate, '%Y-%m') order by o_orderkey) = 1""")
def dedup_row_number(t):
    rows = t.orders.select("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey", "o_totalprice")
    return op.dedup_row_number(rows, ["o_custkey", "month"], ["o_orderkey"])


@query("""select cast(sum(n - 1) as bigint) as duplicates from (select count(*) as n from trips
          group by date_trunc('minute', pickup_ts), round(fare_amount / 10), passenger_count)""", views="trips")
def fuzzy_time_duplicates(t):
    return op.fuzzy_time_duplicates(t.trips.withColumn("fare_amount", F.round(F.col("fare_amount") / 10)))


@query(f"""with q as (select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from events),
           f as (select q1, q3, q1 - (q3 - q1) * 1.5 as low, q3 + (q3 - q1) * 1.5 as high from q)
           select {r('any_value(q1)', 4)} as q1, {r('any_value(q3)', 4)} as q3, {r('any_value(low)', 4)} as low,
           {r('any_value(high)', 4)} as high, count(*) filter (where value < low or value > high) as outliers,
           {r('100.0 * count(*) filter (where value < low or value > high) / count(*)', 4)} as outlier_pct
           from events, f""")
def iqr_outliers(t):
    return op.iqr_outliers(t.events, "value")


@query(f"""with s as (select {mean('value')} as m, stddev_samp(value) as s from events)
           select event_id, value, {r('(value - m) / s', 4)} as zscore from events, s
           where abs({r('(value - m) / s', 4)}) > 3""")
def zscore_outliers(t):
    return op.zscore_outliers(t.events.select("event_id", "value"), "value")


@query(f"""select {r('skewness(value) filter (where value > 0)', 4)} as skewness,
           {r('skewness(ln(1 + greatest(value, 0)))', 4)} as log_skewness from events""")
def log_skewness(t):
    return op.log_skewness(t.events, "value")


@query("""with q as (select quantile_cont(value, 0.01) as lo, quantile_cont(value, 0.99) as hi from events)
          select event_id, value, least(greatest(value, lo), hi) as capped, value < lo or value > hi as was_capped
          from events, q""")
def winsorize(t):
    return op.winsorize(t.events.select("event_id", "value"), "value")


@query("""select p_partkey, regexp_replace(regexp_replace(lower(trim(concat('  ', upper(p_name), '''S  -', p_brand, ' '))),
          '[''-]', '', 'g'), '\\s+', ' ', 'g') as store_name from part""")
def clean_store_name(t):
    rows = t.part.selectExpr("p_partkey", "concat('  ', upper(p_name), '\\'S  -', p_brand, ' ') as s")
    return rows.select("p_partkey", op.clean_store_name("s").alias("store_name"))


DIGITS = "lpad(cast(c_custkey * 7919 as varchar(20)), 10, '2')"
PHONE = f"""case c_custkey % 4 when 0 then concat('(', substring({DIGITS}, 1, 3), ') ', substring({DIGITS}, 4, 3), '-',
    substring({DIGITS}, 7, 4)) when 1 then concat('+1 ', substring({DIGITS}, 1, 3), ' ', substring({DIGITS}, 4))
    when 2 then concat(substring({DIGITS}, 1, 3), '.', substring({DIGITS}, 4)) else {DIGITS} end"""


@query(f"""select c_custkey, regexp_replace(regexp_replace({PHONE}, '[\\s().+-]', '', 'g'), '^1', '') as phone
           from customer""")
def clean_phone(t):
    return t.customer.selectExpr("c_custkey", f"{PHONE.replace('varchar(20)', 'string')} as p").select(
        "c_custkey", op.clean_phone("p").alias("phone")
    )


MAIL = """case c_custkey % 4 when 0 then concat('  ', c_name, '@Example.com ') when 1 then concat(replace(c_name, '#', '.'),
    '@EXAMPLE.org') when 2 then replace(c_name, '#', '_') else concat(replace(c_name, '#', '+'), '@x.c') end"""


@query(f"""select c_custkey, regexp_matches(lower(trim({MAIL})), '^[a-zA-Z0-9._%+\\-]+@[a-zA-Z0-9.\\-]+\\.[a-zA-Z]{{2,}}$')
           as ok from customer""")
def valid_email(t):
    return t.customer.selectExpr("c_custkey", f"{MAIL} as m").select("c_custkey", op.valid_email("m").alias("ok"))


@query("""select o_orderkey, regexp_replace(regexp_replace(trim(lower(o_orderpriority)), '[-_]', ' ', 'g'), '\\s+', ' ', 'g')
          as category from orders""")
def normalize_category(t):
    return t.orders.select("o_orderkey", op.normalize_category("o_orderpriority").alias("category"))


ZIP = """case c_custkey % 4 when 0 then concat('NY', 10000 + c_custkey) when 1 then concat('10 ', 100 + c_custkey % 900)
    when 2 then concat(10000 + c_custkey, '-1234') else concat('x', c_custkey % 1000) end"""


@query(f"""select c_custkey, nullif(regexp_extract(regexp_replace({ZIP}, '\\s', '', 'g'), '(\\d{{5}})', 1), '') as zip
           from customer""")
def extract_zip(t):
    return t.customer.selectExpr("c_custkey", f"{ZIP} as z").select("c_custkey", op.extract_zip("z").alias("zip"))


@query("""select o_orderkey, case when o_orderkey % 9 = 0 then null when o_orderkey % 9 = 4 then null
          else o_orderdate end as parsed from orders""")
def parse_timestamp_strict(t):
    text = """case when o_orderkey % 9 = 0 then 'not-a-date' when o_orderkey % 9 = 4 then ''
              else date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') end as s"""
    return t.orders.selectExpr("o_orderkey", text).select("o_orderkey", op.parse_timestamp_strict("s").alias("parsed"))


@query("select o_orderkey, case when o_orderkey % 5 < 4 then cast(o_orderdate as date) end as parsed from orders")
def parse_mixed_dates(t):
    text = """case o_orderkey % 5 when 0 then date_format(o_orderdate, 'yyyy-MM-dd')
              when 1 then date_format(o_orderdate, 'MM/dd/yyyy') when 2 then date_format(o_orderdate, 'MMMM d, yyyy')
              when 3 then date_format(o_orderdate, 'yyyyMMdd') else 'bad-date' end as s"""
    return t.orders.selectExpr("o_orderkey", text).select("o_orderkey", op.parse_mixed_dates("s").alias("parsed"))


@query("select event_id, ts + interval 5 hour as ts_utc from events")
def to_utc(t):
    return t.events.select("event_id", op.to_utc("ts").alias("ts_utc"))


@query("""select event_id, cast(hour(ts) as int) as hour, dayname(ts) as day_of_week, cast(month(ts) as int) as month,
          dayofweek(ts) in (0, 6) as is_weekend, hour(ts) in (7, 8, 9, 17, 18, 19) as is_rush_hour from events""")
def time_components(t):
    return op.time_components(t.events.select("event_id", "ts"), "ts").drop("ts")


@query(f"""with d as (select cast(epoch_us(dropoff_ts) - epoch_us(pickup_ts) as double) / 60000000 as d from trips)
           select {r(mean('case when d > 0 and d < 180 then d end'))} as avg_min,
           {r('quantile_cont(d, 0.5) filter (where d > 0 and d < 180)')} as median_min,
           count(*) filter (where d < 2) as under_2, count(*) filter (where d > 120) as over_120 from d""",
       views="trips")
def duration_stats(t):
    return op.duration_stats(t.trips)
