"""Quality reports on the test tables."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from heronlake.catalog.registry import mean, query, r, total
from heronlake.operators import quality as op
from heronlake.sources.tables import ValidationError


@query("""select 'tip_amount' as missing_column, (select count(*) from trips) as rows""", views="trips")
def validate_schema(t):
    """Drop one column, let the check name it, and count the rows it guards."""
    try:
        op.validate_schema(t.trips.drop("tip_amount"))
        missing = []
    except ValidationError as error:
        missing = error.missing
    names = F.explode(F.array(*[F.lit(c) for c in missing]))
    return op.validate_schema(t.trips).agg(F.count("*").alias("rows")).select(names.alias("missing_column"), "rows")


RULES = {
    "negative_fares": "fare_amount < 0", "zero_distance": "trip_distance = 0", "null_fare": "fare_amount is null",
    "fare_over_max": "fare_amount > 300", "zero_passenger": "passenger_count = 0",
}


@query("with c as (" + " union all ".join(
    f"select '{n}' as issue, count(*) filter (where {c}) as issue_count from trips" for n, c in RULES.items())
    + f""") select issue, issue_count, {r('100.0 * issue_count / (select count(*) from trips)')} as issue_rate_pct
      from (select * from c union all select 'total_issues', cast(sum(issue_count) as bigint) from c)""",
       views="trips")
def quality_counts(t):
    return op.quality_counts(t.trips, 300)


AUDIT = {
    "negative_fare": "fare_amount < 0", "zero_distance": "trip_distance = 0", "fare_over_max": "fare_amount > 300",
    "negative_tip": "tip_amount < 0", "zero_passenger": "passenger_count = 0",
}
BROKEN = " or ".join(f"coalesce({c}, false)" for c in AUDIT.values())


@query(" union all ".join(
    f"""select '{n}' as issue, count(*) filter (where {c}) as issue_count,
        {r(f'100.0 * count(*) filter (where {c}) / count(*)')} as pct_trips,
        {r('coalesce(' + total(f'case when {c} then fare_amount end') + ', 0)')} as revenue from trips"""
    for n, c in {**AUDIT, "clean": f"not ({BROKEN})"}.items()), views="trips")
def quality_revenue_audit(t):
    return op.quality_revenue_audit(t.trips, 300)


CLEAN = """select * replace (coalesce(passenger_count, 1) as passenger_count, coalesce(tip_amount, 0) as tip_amount,
    coalesce(congestion_surcharge, 0) as congestion_surcharge), passenger_count is null as passenger_count_was_null,
    congestion_surcharge is null as congestion_surcharge_was_null from trips
    where fare_amount > 0 and fare_amount <= 300 and trip_distance >= 0.1 and coalesce(passenger_count, 1) > 0
    qualify row_number() over (partition by pickup_ts, fare_amount, trip_distance order by trip_id) = 1"""


@query(CLEAN, views="trips")
def clean_trips(t):
    return op.clean_trips(t.trips, 300)


FEATURES = f"""c as ({CLEAN}), f as (select quantile_cont(fare_amount, 0.25) as q1,
    quantile_cont(fare_amount, 0.75) as q3 from c),
    e as (select c.*, cast(hour(pickup_ts) as int) as hour, dayname(pickup_ts) as day_of_week,
    cast(month(pickup_ts) as int) as month, dayofweek(pickup_ts) in (0, 6) as is_weekend,
    hour(pickup_ts) in (7, 8, 9, 17, 18, 19) as is_rush_hour,
    {r('cast(epoch_us(dropoff_ts) - epoch_us(pickup_ts) as double) / 60000000')} as duration_min,
    {r('fare_amount / nullif(trip_distance, 0)')} as revenue_per_mile,
    {r('fare_amount + tip_amount + congestion_surcharge')} as total_amount_calc,
    case when fare_amount < 0 then null when fare_amount < 10 then 'low' when fare_amount < 30 then 'medium'
         when fare_amount < 100 then 'high' else 'premium' end as fare_bucket,
    fare_amount < q1 - 1.5 * (q3 - q1) or fare_amount > q3 + 1.5 * (q3 - q1) as is_fare_outlier from c, f)"""


@query(f"with {FEATURES} select * from e", views="trips")
def enrich_trips(t):
    return op.enrich_trips(op.clean_trips(t.trips, 300))


@query(f"""with v as (select fare_amount / trip_distance as v from trips where trip_distance > 0 and fare_amount > 0)
           select {r('avg(v)', 4)} as mean, {r('quantile_cont(v, 0.5)', 4)} as median,
           {r('quantile_cont(v, 0.95)', 4)} as p95 from v""", views="trips")
def revenue_per_mile_stats(t):
    return op.revenue_per_mile_stats(t.trips)


@query("""with f as (select * from trips where fare_amount > 0 and fare_amount <= 300 and trip_distance >= 0.1
              and coalesce(passenger_count, 1) > 0),
          n as (select (select count(*) from trips) as n, (select count(*) from f) as g,
              (select count(*) from (select distinct pickup_ts, fare_amount, trip_distance from f)) as k)
          select 'ingest' as stage, n as rows_in, n as rows_out, 0::bigint as rows_dropped from n
          union all select 'filter', n, g, n - g from n union all select 'dedup', g, k, g - k from n""", views="trips")
def run_metrics(t):
    return op.run_metrics(t.trips, 300)


@query(f"""with {FEATURES} select count(*) as rows, {r(mean('fare_amount'))} as fare_mean,
           max(fare_amount) as fare_max, min(fare_amount) as fare_min, {r('median(fare_amount)')} as fare_median,
           {r(mean('trip_distance'))} as avg_distance, {r(mean('duration_min'))} as avg_duration_min,
           {r(total('fare_amount'))} as total_revenue,
           {r('100.0 * count(*) filter (where is_weekend) / count(*)')} as weekend_pct,
           {r('100.0 * count(*) filter (where is_rush_hour) / count(*)')} as rush_hour_pct,
           {r('100.0 * count(*) filter (where is_fare_outlier) / count(*)')} as outlier_pct from e""", views="trips")
def trip_summary_report(t):
    return op.trip_summary_report(op.enrich_trips(op.clean_trips(t.trips, 300)))


OVERVIEW = {
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
                 "c_mktsegment": "string"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    "part": {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int",
             "p_retailprice": "double"},
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
               "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"},
    "lineitem": {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
                 "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
                 "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"},
    "events": {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
               "value": "double", "props": "string"},
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
    "embeddings": {"vec_id": "bigint", "embedding": "array<float>", "label": "int"},
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
    "benchmark": {"item_id": "bigint", "text": "string"},
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "conversations": {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"},
    "trips": {
        "trip_id": "bigint", "vendor_id": "bigint", "pickup_ts": "timestamp_ntz", "dropoff_ts": "timestamp_ntz",
        "passenger_count": "bigint", "trip_distance": "double", "payment_type": "string", "fare_amount": "double",
        "tip_amount": "double", "congestion_surcharge": "double",
    },
}


@query(" union all ".join(
    f"""select '{n}' as table_name, '{c}' as column_name, '{k}' as data_type, count(*) as rows,
        count(*) filter (where {c} is null) as null_count from {n}"""
    for n, columns in OVERVIEW.items() for c, k in columns.items()), views="trips")
def dataset_overview(t):
    parts = [op.dataset_overview(getattr(t, name), name) for name in OVERVIEW]
    return reduce(DataFrame.unionAll, parts)


@query("""select cast((rn - 1) // 700 as bigint) as batch, count(*) as rows from
          (select row_number() over (order by event_id) as rn from events) group by 1""")
def batch_counts(t):
    return op.batch_counts(t.events, "event_id", 700)
