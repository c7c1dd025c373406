"""File streams: a running total and counts per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from heronlake.functions.exact import total
from heronlake.plans.ordered import order_buckets, scan
from heronlake.plans.shared import scratch_path


def file_stream(spark: SparkSession, path: str, schema: StructType, files: int | None = None) -> DataFrame:
    """A Parquet table, one file or a folder of part files, as a stream.

    The path is turned into a pattern that matches its own name alone, which
    the file source takes for a file and for a folder.  ``files`` bounds the
    files of a batch.
    """
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    folder, name = path.rstrip("/").rsplit("/", 1)
    return reader.parquet(f"{folder}/[{name[0]}]{name[1:]}")


def _run(stream: DataFrame, batch, mode: str = "append") -> None:
    spark = stream.sparkSession
    writer = stream.writeStream.outputMode(mode).foreachBatch(batch)
    writer = writer.option("checkpointLocation", scratch_path(spark, "stream")).trigger(availableNow=True)
    writer.start().awaitTermination()


def stream_fare_total(trips: DataFrame) -> DataFrame:
    """Trips with a positive fare and their total, over all files present.

    The state is one row; every batch replaces it in a file.  A stream without
    files has no trips and no total.
    """
    spark = trips.sparkSession
    target = scratch_path(spark, "fare-total")
    sums = trips.where(F.col("fare_amount") > 0).agg(
        F.count("*").alias("trips"), total("fare_amount").alias("total_fare")
    )
    spark.createDataFrame([(0, None)], sums.schema).write.parquet(target)
    _run(sums, lambda batch, _: batch.write.mode("overwrite").parquet(target), "complete")
    return spark.read.schema(sums.schema).parquet(target)


def numbered_stream(source: DataFrame) -> DataFrame:
    """All rows of a stream as (row, number), numbered from 0 in the order they were written.

    Each micro-batch writes its rows into a folder of its own with the task
    and the place within the task; one that is run again after a failure
    replaces its folder.  A row's number is the count of all rows in earlier
    parts (micro-batch, task) and its place in its own.
    """
    spark = source.sparkSession
    target = scratch_path(spark, "numbered")
    row = F.struct(*[F.col(f"`{c}`") for c in source.columns]).alias("row")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    named = lambda df: df.select(row, F.spark_partition_id().alias("task"), place.alias("place"))
    schema = named(spark.createDataFrame([], source.schema)).schema

    def store(batch: DataFrame, number: int) -> None:
        named(batch).write.mode("overwrite").parquet(f"{target}/part={number}")

    spark.createDataFrame([], schema).write.parquet(f"{target}/part=-1")
    _run(source, store)
    rows = spark.read.schema(schema.add("part", "long")).parquet(target)
    parts = rows.groupBy("part", "task").agg(F.count("*").alias("n"))
    before = scan(order_buckets(parts, ["part", "task"]), [], ["part", "task"], {"first": ("sum", F.col("n"), False)})
    # one row per written part
    return rows.join(before.select("part", "task", "first"), ["part", "task"]).select("row", (F.col("first") + F.col("place")).alias("number"))


def stream_batches(source: DataFrame, size: int) -> DataFrame:
    """The rows of a stream with ``batch``: every ``size`` rows make one, over file and
    micro-batch borders; the last one holds what is left."""
    return numbered_stream(source).select("row.*", F.floor(F.col("number") / size).cast("long").alias("batch"))


def stream_batch_counts(source: DataFrame, size: int) -> DataFrame:
    """Rows of the batches of ``size`` rows that a stream fills: (batch, rows).  A stream without files has no batch."""
    return stream_batches(source, size).groupBy("batch").agg(F.count("*").alias("rows"))
