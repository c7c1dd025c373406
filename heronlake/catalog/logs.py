"""Logs and run history on the test tables."""

from pyspark.sql import functions as F

from heronlake.catalog.registry import query, r
from heronlake.operators import logs as op
from heronlake.plans.shared import scratch_path
from heronlake.sources import tables as io


@query("""with n as (select *, row_number() over (order by event_id) as line_no from lines)
          select 'ERROR' as pattern, line_no, line from n where level = 'ERROR'
          union all select 'not INFO', line_no, line from n where level <> 'INFO'""", views="logs lines")
def log_lines_by_level(t):
    return op.log_lines_by_patterns(t.log_lines, "line_key", {"ERROR": ("ERROR", False), "not INFO": ("INFO", True)})


@query("select line from lines where level = 'ERROR' and job = 'error_pipeline'", views="logs lines")
def log_regex_filter(t):
    return op.log_regex_filter(t.log_lines, "ERROR", "error_pipeline")


@query("select replace(line, 'ERROR', 'CRITICAL') as line from lines where level <> 'WARN'", views="logs lines")
def log_replace_level(t):
    return op.log_replace_level(t.log_lines, "ERROR", "CRITICAL", "WARN")


@query("select job, status from runs", views="runs")
def run_projection(t):
    return op.run_projection(t.runs, ["job", "status"])


@query("select cast(sum(rows_processed) as bigint) as total_rows from runs", views="runs")
def run_total_rows(t):
    return op.run_total_rows(t.runs)


@query("select run_date, job, rows_processed from runs where rows_processed > 1000000", views="runs")
def runs_over_threshold(t):
    return op.runs_over_threshold(t.runs)


@query("select job, count(*) as runs from runs group by 1", views="runs")
def runs_per_job(t):
    return op.runs_per_job(t.runs)


@query("select 'error=' || error as error, count(*) as n from logs where level = 'ERROR' group by 1", views="logs")
def top_error_types(t):
    return op.top_error_types(t.log_lines)


@query("select run_date, job from runs where status = 'failed'", views="runs")
def failed_runs(t):
    return op.failed_runs(t.runs)


@query("""select case when level = 'ERROR' then 'errors' else 'others' end as folder, count(*) as lines,
          count(*) filter (where level = 'ERROR') as matches from logs group by 1""", views="logs")
def lines_per_file(t):
    base = scratch_path(t.spark, "lines")
    is_error = F.contains("value", F.lit("ERROR"))
    t.log_lines.where(is_error).select("value").write.text(f"{base}/errors")
    t.log_lines.where(~is_error).select("value").write.text(f"{base}/others")
    files = io.lines_per_file(t.spark, [f"{base}/errors", f"{base}/others"], "ERROR")
    folder = F.element_at(F.split("file", "/"), -2)
    return files.groupBy(folder.alias("folder")).agg(F.sum("lines").alias("lines"), F.sum("matches").alias("matches"))


@query(f"""select count(*) as total_runs, count(*) filter (where status = 'success') as successful_runs,
           count(*) filter (where status = 'failed') as failed_runs, cast(sum(rows_processed) as bigint) as total_rows,
           {r('avg(duration_sec) filter (where duration_sec > 0)', 1)} as avg_duration_sec from runs""", views="runs")
def health_report(t):
    return op.health_report(t.runs)
