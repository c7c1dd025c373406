"""Scans, sources and sinks."""

from pyspark.sql import functions as F

from heronlake.catalog.registry import query, r, total
from heronlake.operators.quality import trip_report
from heronlake.plans.shared import scratch_path
from heronlake.sources import tables as io

SUPPLIER = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"


@query("select l_orderkey, l_quantity from lineitem where l_shipdate >= date '1998-01-01'")
def scan_parquet(t):
    since = F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    return io.scan_parquet(t.spark, t.path("lineitem"), ["l_orderkey", "l_quantity"], since)


@query("select * from supplier")
def scan_csv(t):
    path = scratch_path(t.spark, "supplier-csv")
    t.supplier.write.csv(path, header=True)
    return io.scan_csv(t.spark, path, SUPPLIER)


@query("""select 'parquet' as source, s_suppkey, s_name from supplier
          union all select 'csv', s_suppkey, s_name from supplier""")
def ingest_by_format(t):
    path = scratch_path(t.spark, "supplier") + ".csv"
    t.supplier.write.csv(path, header=True)
    parts = [
        io.ingest_by_format(t.spark, p, schema).select(F.lit(kind).alias("source"), "s_suppkey", "s_name")
        for kind, p, schema in (("parquet", t.path("supplier"), None), ("csv", path, SUPPLIER))
    ]
    return parts[0].unionByName(parts[1])


@query("select log_date, log_time, level, job, stage, rows, error from logs", views="logs")
def scan_log_text(t):
    path = scratch_path(t.spark, "log")
    t.log_lines.select("value").write.text(path)
    return io.scan_log_text(t.spark, path).select(
        "log_date", "log_time", "level", "job", "stage",
        F.col("kv")["rows"].alias("rows"), F.col("kv")["error"].alias("error"),
    )


@query("select * from orders")
def write_parquet(t):
    return io.write_parquet(t.orders, scratch_path(t.spark, "orders"))


@query("select * from customer")
def write_csv(t):
    return io.write_csv(t.customer, scratch_path(t.spark, "customer"))


@query(f"""select payment_type, count(fare_amount) as trips, {r(total('fare_amount'))} as revenue,
           (select count(*) from trips) as rows, (select max(fare_amount) from trips) as max_fare
           from trips group by payment_type""", views="trips")
def write_json_report(t):
    saved = io.write_json_report(trip_report(t.trips), scratch_path(t.spark, "report"))
    rows = saved.select(F.explode("payment_breakdown").alias("payment_type", "p"), "rows", "fare_stats")
    return rows.select(
        "payment_type", F.col("p.trips").alias("trips"), F.col("p.revenue").alias("revenue"),
        "rows", F.col("fare_stats.max").alias("max_fare"),
    )


@query("""select m.name as month_name, count(o.o_orderkey) as orders
          from (values (1,'Jan'),(2,'Feb'),(3,'Mar'),(4,'Apr'),(5,'May'),(6,'Jun'),(7,'Jul'),
                (8,'Aug'),(9,'Sep'),(10,'Oct'),(11,'Nov'),(12,'Dec')) m(month, name)
          left join orders o on month(o.o_orderdate) = m.month group by m.name""")
def inline_values(t):
    from heronlake.operators.spines import month_names

    counts = t.orders.groupBy(F.month("o_orderdate").alias("month")).agg(F.count("*").alias("n"))
    return (
        month_names(t.spark).join(counts, "month", "left")
        .select(F.col("name").alias("month_name"), F.coalesce("n", F.lit(0)).alias("orders"))
    )
