"""Derived inputs: trips, run history, log lines, event grid, edge tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heronlake.functions.timeparts import day
from heronlake.plans.lists import WHOLE, neighbour_pairs
from heronlake.plans.ordered import order_buckets, scan


class Tables:
    """The parquet tables of one folder, by attribute, and views built on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    @cached_property
    def trips(self) -> DataFrame:
        return trips(self.events)

    @cached_property
    def runs(self) -> DataFrame:
        return runs(self.events)

    @cached_property
    def sessions(self) -> DataFrame:
        return sessions(self.events)

    @cached_property
    def log_lines(self) -> DataFrame:
        return log_lines(self.events)

    @cached_property
    def grid(self) -> DataFrame:
        return grid(self.events)


def _k() -> Column:
    return F.get_json_object("props", "$.k")


def trips(events: DataFrame) -> DataFrame:
    """Trips with nulls, negative fares and zero distances, one per event."""
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), _k().cast("int"), F.lit(0))
    gain = F.col("value") - F.lit(2.0)
    return events.select(
        F.col("event_id").alias("trip_id"),
        (F.col("user_id") % 2 + 1).alias("vendor_id"),
        F.col("ts").alias("pickup_ts"),
        (F.col("ts") + minutes).alias("dropoff_ts"),
        F.nullif(F.col("user_id") % 7, F.lit(6).cast("long")).alias("passenger_count"),
        _k().cast("double").alias("trip_distance"),
        F.col("event_type").alias("payment_type"),
        F.round(gain, 2).alias("fare_amount"),
        F.when(F.col("event_id") % 11 != 0, F.floor(gain * F.lit(15.0) + F.lit(0.5)) / F.lit(100.0))
        .cast("double")
        .alias("tip_amount"),
        F.when(F.col("event_id") % 5 != 0, F.lit(2.5)).alias("congestion_surcharge"),
    )


def sessions(events: DataFrame) -> DataFrame:
    """One session per event, ``k`` minutes long."""
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), _k().cast("int"), F.lit(0))
    return events.select(
        "event_id", "user_id", "event_type", F.col("ts").alias("start_ts"), (F.col("ts") + minutes).alias("end_ts")
    )


def runs(events: DataFrame) -> DataFrame:
    """Run history: one row per day and event type."""
    n = F.count("*")
    value = F.sum(F.col("value").cast("decimal(18,6)"))
    return events.groupBy(day("ts").alias("run_date"), "event_type").agg(
        (n * 20000).alias("rows_processed"),
        (F.round(value, 0).cast("long") % 180).alias("duration_sec"),
        F.when(n < 60, "failed").otherwise("success").alias("status"),
    ).select(
        "run_date",
        F.concat("event_type", F.lit("_pipeline")).alias("job"),
        "rows_processed",
        "duration_sec",
        "status",
    )


def log_lines(events: DataFrame) -> DataFrame:
    """One log line per event, keyed by ``line_key``."""
    kind = F.col("event_type")
    level = F.when(kind == "error", "ERROR").when(kind == "view", "WARN").otherwise("INFO")
    stages = F.array(*[F.lit(s) for s in ("ingest", "validate", "transform", "save")])
    cause = F.when(F.col("event_id") % 2 == 0, "error=file_not_found").otherwise(
        "error=schema_mismatch"
    )
    tail = F.when(kind == "error", cause).otherwise(
        F.concat(F.lit("rows="), F.col("user_id").cast("string"))
    )
    line = F.concat_ws(
        " ",
        F.date_format("ts", "yyyy-MM-dd"),
        F.date_format("ts", "HH:mm:ss"),
        level,
        F.concat(F.lit("pipeline="), kind, F.lit("_pipeline")),
        F.concat(F.lit("stage="), F.get(stages, (F.col("event_id") % 4).cast("int"))),
        tail,
    )
    return events.select(F.col("event_id").alias("line_key"), line.alias("value"))


def grid(events: DataFrame) -> DataFrame:
    """Cells (r, c, v): day since the first day, hour, number of events."""
    first = events.agg(F.min(day("ts"))).scalar()
    return events.groupBy(
        F.date_diff(day("ts"), first).alias("r"), F.hour("ts").alias("c")
    ).agg(F.count("*").alias("v"))


def consecutive_pairs(lineitem: DataFrame, column: str) -> DataFrame:
    """Unordered pairs of a column on neighbouring lines of one order.

    Whole numbers move once, packed; other values are joined line by line.
    """
    kind = lineitem.schema[column].dataType
    if kind.simpleString() in WHOLE:
        lines = lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("place"), F.col(column).alias("value"))
        return neighbour_pairs(lines.dropna()).select(F.col("user1_id").cast(kind), F.col("user2_id").cast(kind))
    rows = lineitem.select(
        "l_orderkey", "l_linenumber", F.col(column).alias("a")
    ).distinct()
    after = rows.select(
        "l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("a").alias("b")
    )
    joined = rows.join(after, ["l_orderkey", "l_linenumber"]).where("a <> b")
    return joined.select(
        F.least("a", "b").alias("user1_id"), F.greatest("a", "b").alias("user2_id")
    ).distinct()


def next_order_edges(orders: DataFrame) -> DataFrame:
    """Each order points to the same customer's next order."""
    ranged = order_buckets(
        orders.select("o_custkey", "o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], ["o_custkey"]
    )
    before = scan(
        ranged, ["o_custkey"], ["o_orderdate", "o_orderkey"],
        {"src": ("last", F.col("o_orderkey"), False)},
    )
    return before.where("src is not null").select("src", F.col("o_orderkey").alias("dst"))


def nation_flows(t: Tables) -> DataFrame:
    """Lineitem rows with the nation of the customer and of the supplier."""
    buyers = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("c_nationkey").alias("buyer_nation")
    )
    sellers = t.supplier.select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("seller_nation")
    )
    return t.lineitem.join(buyers, "l_orderkey").join(sellers, "l_suppkey")


# The same views as DuckDB text, for the oracle statements.
SQL_VIEWS = {
    "trips": """select event_id as trip_id, user_id % 2 + 1 as vendor_id, ts as pickup_ts,
       ts + to_minutes(cast(props->>'$.k' as int)) as dropoff_ts,
       nullif(user_id % 7, 6) as passenger_count,
       cast(props->>'$.k' as double) as trip_distance, event_type as payment_type,
       round(value - 2, 2) as fare_amount,
       case when event_id % 11 = 0 then null else floor((value - 2) * 15 + 0.5) / 100 end as tip_amount,
       case when event_id % 5 = 0 then null else cast(2.5 as double) end as congestion_surcharge
       from events""",
    "runs": """select cast(ts as date) as run_date, concat(event_type, '_pipeline') as job,
       count(*) * 20000 as rows_processed,
       cast(round(sum(cast(value as decimal(18,6))), 0) as bigint) % 180 as duration_sec,
       case when count(*) < 60 then 'failed' else 'success' end as status
       from events group by cast(ts as date), event_type""",
    "logs": """select event_id, strftime(ts, '%Y-%m-%d') as log_date,
       strftime(ts, '%H:%M:%S') as log_time,
       case event_type when 'error' then 'ERROR' when 'view' then 'WARN' else 'INFO' end as level,
       event_type || '_pipeline' as job,
       case event_id % 4 when 0 then 'ingest' when 1 then 'validate' when 2 then 'transform'
            else 'save' end as stage,
       case when event_type <> 'error' then cast(user_id as varchar) end as rows,
       case when event_type = 'error' then
            case event_id % 2 when 0 then 'file_not_found' else 'schema_mismatch' end end as error
       from events""",
    "lines": """select event_id, level, job, error, concat_ws(' ', log_date, log_time, level,
       'pipeline=' || job, 'stage=' || stage,
       case when error is null then 'rows=' || rows else 'error=' || error end) as line from logs""",
    "grid": """select cast(datediff('day', (select min(cast(ts as date)) from events), cast(ts as date))
       as int) as r, cast(hour(ts) as int) as c, count(*) as v from events group by 1, 2""",
    "line_rows": """select distinct l_orderkey, l_linenumber, l_partkey from lineitem""",
    "part_links": """select distinct least(a.l_partkey, b.l_partkey) as user1_id,
       greatest(a.l_partkey, b.l_partkey) as user2_id from line_rows a join line_rows b
       on a.l_orderkey = b.l_orderkey and b.l_linenumber = a.l_linenumber + 1
       where a.l_partkey <> b.l_partkey""",
    "order_chain": """select src, dst from (select lag(o_orderkey) over (partition by o_custkey
       order by o_orderdate, o_orderkey) as src, o_orderkey as dst from orders)
       where src is not null""",
    "flows": """select l.*, c.c_nationkey as buyer_nation, s.s_nationkey as seller_nation
       from lineitem l join orders o on l.l_orderkey = o.o_orderkey
       join customer c on o.o_custkey = c.c_custkey
       join supplier s on l.l_suppkey = s.s_suppkey""",
    "words": """select distinct word from (select unnest(regexp_split_to_array(lower(text),
       '[^\\p{L}]+')) as word from documents) where word <> ''""",
    "sessions": """select event_id, user_id, event_type, ts as start_ts,
       ts + to_minutes(cast(props->>'$.k' as int)) as end_ts from events""",
}
