"""Where loops and sinks may write: the folder every executor can reach."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is named, one beside the warehouse tables.

    A folder on one machine serves one machine: on a cluster without a named
    folder and with a local warehouse this is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    on_one_machine = re.match(r"local(\[|$)", spark.sparkContext.master)
    if not on_one_machine and re.match(r"(file:|/)", warehouse):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_scratch".rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder for a written table."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows out once so that later rounds start from files."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table through Spark's own file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Rounds:
    """The state of a loop as Parquet files, one folder per round.

    A round is read back from files, so the plan stays short, a lost executor
    repeats one round at most and Spark knows the size.  The round before last
    is deleted once the next one is written.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.paths = spark, scratch_path(spark, name), []

    def save(self, df: DataFrame) -> DataFrame:
        path = f"{self.base}/round{len(self.paths)}"
        df.write.parquet(path)
        self.paths.append(path)
        if len(self.paths) > 2:
            remove(self.spark, self.paths[-3])
        return self.spark.read.schema(df.schema).parquet(path)
