"""Streaming jobs on the test tables."""

from heronlake.catalog.registry import query, total
from heronlake.sources import views
from heronlake.streaming import jobs


@query(f"""select count(*) as trips, {total('fare_amount')} as total_fare from trips where fare_amount > 0""",
       views="trips")
def stream_fare_total(t):
    events = jobs.file_stream(t.spark, t.path("events"), t.events.schema)
    return jobs.stream_fare_total(views.trips(events))


@query("""select (n - 1) // 1000 as batch, count(*) as rows from (select row_number() over () as n from orders)
          group by 1""")
def stream_batch_counts(t):
    return jobs.stream_batch_counts(jobs.file_stream(t.spark, t.path("orders"), t.orders.schema, files=1), 1000)
