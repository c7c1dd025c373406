"""Log lines and run history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from heronlake.functions.exact import rnd, ratio
from heronlake.plans.ordered import order_buckets, row_numbers


def log_lines_by_level(lines: DataFrame, key: str, level: str, invert: bool = False) -> DataFrame:
    """Numbered lines that hold a level, or that do not."""
    numbered = row_numbers(order_buckets(lines, key), [], [key], "line_no")
    holds = F.contains("value", F.lit(level))
    return numbered.where(~holds if invert else holds).select("line_no", F.col("value").alias("line"))


def log_lines_by_patterns(lines: DataFrame, key: str, patterns: dict[str, tuple[str, bool]]) -> DataFrame:
    """Numbered lines per pattern; a pattern is a level and whether to invert.  Lines are numbered once."""
    numbered = row_numbers(order_buckets(lines, key), [], [key], "line_no")
    met = [F.when(F.contains("value", F.lit(level)) != F.lit(invert), name) for name, (level, invert) in patterns.items()]
    named = numbered.withColumn("pattern", F.explode(F.array_compact(F.array(*met))))
    return named.select("pattern", "line_no", F.col("value").alias("line"))


def log_regex_filter(lines: DataFrame, level: str, job: str) -> DataFrame:
    """Lines with the level and the job, in either order."""
    pattern = f"{level}.*{job}|{job}.*{level}"
    return lines.where(F.rlike("value", F.lit(pattern))).select(F.col("value").alias("line"))


def log_replace_level(lines: DataFrame, old: str, new: str, drop: str) -> DataFrame:
    """One level renamed everywhere, lines with another level dropped."""
    kept = lines.where(~F.contains("value", F.lit(drop)))
    return kept.select(F.replace("value", F.lit(old), F.lit(new)).alias("line"))


def run_projection(runs: DataFrame, columns: list[str]) -> DataFrame:
    return runs.select(*columns)


def run_total_rows(runs: DataFrame) -> DataFrame:
    return runs.agg(F.sum("rows_processed").alias("total_rows"))


def runs_over_threshold(runs: DataFrame, limit: int = 1_000_000) -> DataFrame:
    return runs.where(F.col("rows_processed") > limit).select("run_date", "job", "rows_processed")


def runs_per_job(runs: DataFrame) -> DataFrame:
    """Runs per job, most first."""
    return runs.groupBy("job").agg(F.count("*").alias("runs")).orderBy(F.desc("runs"), "job")


def top_error_types(lines: DataFrame, level: str = "ERROR") -> DataFrame:
    """Last field of the lines of a level, counted, most first."""
    last = F.element_at(F.split("value", " "), -1)
    errors = lines.where(F.contains("value", F.lit(level)))
    return errors.groupBy(last.alias("error")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "error")


def failed_runs(runs: DataFrame) -> DataFrame:
    return runs.where("status = 'failed'").select("run_date", "job").orderBy("run_date", "job")


def health_report(runs: DataFrame) -> DataFrame:
    """Runs, successes, failures, rows and mean positive duration."""
    took = F.when(F.col("duration_sec") > 0, F.col("duration_sec"))
    return runs.agg(
        F.count("*").alias("total_runs"), F.count_if(F.col("status") == "success").alias("successful_runs"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"), F.sum("rows_processed").alias("total_rows"),
        rnd(ratio(F.sum(took), F.count(took)), 1).alias("avg_duration_sec"),
    )
