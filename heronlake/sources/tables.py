"""Readers, writers and typed errors."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


class JobError(Exception):
    """A job cannot go on; what is wrong is in the fields of the subclass."""


class IngestionError(JobError):
    """The input at ``path`` cannot be read, and why."""

    def __init__(self, path: str, reason: str):
        super().__init__(f"cannot read {path}: {reason}")
        self.path, self.reason = path, reason


class ValidationError(JobError):
    """The input lacks columns a job needs."""

    def __init__(self, message: str, missing: list[str]):
        super().__init__(f"{message}: {', '.join(missing)}")
        self.missing = missing


def scan_parquet(
    spark: SparkSession, path: str, columns: list[str], predicate: Column | None = None
) -> DataFrame:
    """Read only the wanted columns and rows; both reach the file reader."""
    df = spark.read.parquet(path)
    if predicate is not None:
        df = df.where(predicate)
    return df.select(*columns)


def scan_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Headered CSV with a declared schema, so there is no inference pass."""
    return spark.read.schema(schema).csv(path, header=True)


def ingest_by_format(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """Pick the reader by suffix; anything unreadable is an IngestionError.

    A CSV file says nothing about its types, so it needs a schema.
    """
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix not in ("parquet", "csv"):
        raise IngestionError(path, "unsupported file type")
    if suffix == "csv" and schema is None:
        raise IngestionError(path, "a CSV file needs a schema")
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.parquet(path) if suffix == "parquet" else reader.csv(path, header=True)
    except AnalysisException as error:
        raise IngestionError(path, error.getCondition()) from error


def parse_log(lines: DataFrame, line: str = "value") -> DataFrame:
    """Split ``date time LEVEL k=v ...`` lines into columns and a key map."""
    parts = F.split(F.regexp_replace(F.col(line), r"\s+", " "), " ", 4)
    pairs = F.str_to_map(F.element_at(parts, 4), F.lit(" "), F.lit("="))
    out = lines.withColumns({"_parts": parts, "kv": pairs})
    return out.select(
        *lines.columns,
        F.get("_parts", F.lit(0)).alias("log_date"),
        F.get("_parts", F.lit(1)).alias("log_time"),
        F.get("_parts", F.lit(2)).alias("level"),
        F.col("kv")["pipeline"].alias("job"),
        F.col("kv")["stage"].alias("stage"),
        "kv",
    )


def scan_log_text(spark: SparkSession, path: str) -> DataFrame:
    return parse_log(spark.read.text(path))


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Save as Parquet and return what was written."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> DataFrame:
    """Save as headered CSV and return what was written."""
    df.write.mode("overwrite").csv(path, header=True)
    return scan_csv(df.sparkSession, path, df.schema)


def write_json_report(report: DataFrame, path: str) -> DataFrame:
    """Save a one-row nested report as JSON and return what was written."""
    report.write.mode("overwrite").json(path)
    return report.sparkSession.read.schema(report.schema).json(path)


def lines_per_file(spark: SparkSession, paths: list[str], needle: str) -> DataFrame:
    """Lines, and lines holding a text, per input file."""
    lines = spark.read.text(paths).withColumn("file", F.input_file_name())
    return lines.groupBy("file").agg(
        F.count("*").alias("lines"), F.count_if(F.contains("value", F.lit(needle))).alias("matches")
    )
