"""Gaps and islands, and merges of intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from heronlake.functions.timeparts import in_year
from heronlake.plans.ordered import (
    consecutive_runs,
    interval_runs,
    order_buckets,
    row_numbers,
    scan,
)
from heronlake.plans.shared import cut_lineage
from heronlake.plans.skew import keep_matching


def busy_stadium_runs(stadium: DataFrame, people: int = 100, k: int = 3) -> DataFrame:
    """Rows in runs of at least k consecutive ids with enough people."""
    busy = stadium.where(F.col("people") >= people)
    numbered = row_numbers(order_buckets(busy, "id"), [], ["id"]).withColumn("island", F.col("id") - F.col("rn"))
    long_runs = numbered.groupBy("island").agg(F.count("*").alias("_n")).where(F.col("_n") >= k)
    return keep_matching(numbered, long_runs, ["island"]).select(*stadium.columns)


def continuous_ranges(logs: DataFrame) -> DataFrame:
    """First and last id of each run of consecutive ids."""
    return consecutive_runs(logs.select("log_id").distinct(), [], "log_id").select("start_id", "end_id")


def summary_ranges(logs: DataFrame) -> DataFrame:
    """The same runs as text: ``a`` or ``a->b``."""
    first, last = F.col("start_id").cast("string"), F.col("end_id").cast("string")
    text = F.when(F.col("start_id") == F.col("end_id"), first).otherwise(F.concat(first, F.lit("->"), last))
    return continuous_ranges(logs).select("start_id", text.alias("range"))


def contiguous_dates(failed: DataFrame, succeeded: DataFrame, year: int) -> DataFrame:
    """Periods of consecutive days in one state within a year."""
    rows = failed.select(F.col("fail_date").alias("dt"), F.lit("failed").alias("period_state")).unionAll(
        succeeded.select(F.col("success_date").alias("dt"), F.lit("succeeded").alias("period_state"))
    ).where(in_year("dt", year)).distinct()
    epoch = F.lit("1970-01-01").cast("date")
    runs = consecutive_runs(rows.withColumn("n", F.date_diff("dt", epoch)), ["period_state"], "n")
    return runs.select(
        "period_state", F.date_add(epoch, F.col("start_id")).alias("start_date"),
        F.date_add(epoch, F.col("end_id")).alias("end_date"),
    )


def longest_streak(matches: DataFrame) -> DataFrame:
    """Longest run of calendar days with a win per player, 0 without a win."""
    epoch = F.lit("1970-01-01").cast("date")
    wins = matches.where("result = 'Win'").select("player_id", F.date_diff("match_day", epoch).alias("n"))
    runs = consecutive_runs(wins.distinct(), ["player_id"], "n")
    best = runs.groupBy("player_id").agg(F.max("length").alias("best"))
    players = matches.select("player_id").distinct()
    return players.join(best, "player_id", "left").select(
        "player_id", F.coalesce("best", F.lit(0).cast("long")).alias("longest_streak")
    )


def consecutive_with_streak(logs: DataFrame, k: int = 3) -> DataFrame:
    """Values with k in a row; only the value of the one longest run shows its length."""
    runs = consecutive_runs(logs, ["num"], "id").groupBy("num").agg(F.max("length").alias("length"))
    longest = runs.orderBy(F.desc("length"), "num").limit(1).select("num", F.col("length").alias("max_consecutive_count"))
    return runs.where(F.col("length") >= k).select("num").join(longest, "num", "left")


def longest_consecutive(numbers: DataFrame, column: str) -> DataFrame:
    """Length of the longest run of consecutive integers, 0 on empty input."""
    runs = consecutive_runs(numbers.select(column).where(F.col(column).isNotNull()).distinct(), [], column)
    return runs.agg(F.coalesce(F.max("length"), F.lit(0).cast("long")).alias("longest"))


def merge_hall_events(halls: DataFrame) -> DataFrame:
    """Overlapping events of one hall as one event."""
    return interval_runs(halls, ["hall_id"], "start_day", "end_day").select("hall_id", "start_day", "end_day")


def merge_intervals(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """Overlapping and touching intervals of the whole table merged."""
    return interval_runs(intervals, [], start, end).select(start, end)


def insert_interval(intervals: DataFrame, new: DataFrame, start: str, end: str) -> DataFrame:
    """Add one interval to a disjoint set and merge what it meets."""
    return merge_intervals(intervals.select(start, end).unionAll(new.select(start, end)), start, end)


def erase_overlaps(intervals: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Fewest intervals to drop per key so that the rest do not overlap.

    Keeping the interval that ends first is best.  An interval that holds
    another one is never kept, so only rows whose start is above all starts
    before them (in order of end) remain; their successor is the first one that
    starts at or after their end.  The chain from the first row is counted by
    doubling the successor links, so it takes few rounds and no task walks
    through one key.  An interval of no length is always kept.
    """
    at_point = F.col(start) == F.col(end)
    ends = intervals.groupBy(key, end).agg(
        F.max(F.when(~at_point, F.col(start))).alias("s"), F.max(F.when(at_point, F.col(start))).alias("p")
    )
    seen = scan(
        order_buckets(ends, end, [key]), [key], [end],
        {"_s": ("max", F.col("s"), False), "_p": ("max", F.col("p"), False)},
    )
    free = (F.col("_s").isNull() | (F.col("_s") < F.col("s"))) & (F.col("_p").isNull() | (F.col("_p") <= F.col("s")))
    rows = cut_lineage(seen.where(free & F.col("s").isNotNull()).select(key, F.col("s"), F.col(end).alias("e")))
    asked = rows.select(key, F.col("e").alias("at"), F.lit(0).alias("kind"), F.col("e").alias("node"))
    starts = rows.select(key, F.col("s").alias("at"), F.lit(1).alias("kind"), F.col("e").alias("node"))
    linked = scan(
        order_buckets(asked.unionByName(starts), ["at", "kind"], [key]), [key], ["at", "kind"],
        {"next": ("last", F.when(F.col("kind") == 1, F.col("node")), True)}, reverse=True,
    ).where("kind = 0").select(key, "node", "next", F.lit(1).cast("long").alias("kept"))
    heads = rows.groupBy(key).agg(F.min("e").alias("node"))
    links = cut_lineage(linked)
    while not links.join(heads, [key, "node"], "left_semi").where("next is not null").isEmpty():
        ahead = links.select(
            key, F.col("node").alias("next"), F.col("next").alias("_after"), F.col("kept").alias("_more")
        )
        links = cut_lineage(
            links.join(ahead, [key, "next"], "left").select(
                key, "node", F.col("_after").alias("next"),
                (F.col("kept") + F.coalesce("_more", F.lit(0))).alias("kept"),
            )
        )
    chains = links.join(heads, [key, "node"], "left_semi").select(key, "kept")
    counts = intervals.groupBy(key).agg(F.count("*").alias("n"), F.count_if(at_point).alias("points"))
    left = F.col("n") - F.col("points") - F.coalesce("kept", F.lit(0))
    return counts.join(chains, key, "left").select(key, left.alias("removed"))


def max_concurrency(intervals: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Most intervals open at once; one that ends frees its place first."""
    edge = lambda c, d: F.struct(F.col(c).alias("at"), F.lit(d).alias("d"))
    edges = intervals.select(*keys, F.explode(F.array(edge(start, 1), edge(end, -1))).alias("_e"))
    steps = edges.select(*keys, "_e.*").groupBy(*keys, "at").agg(F.sum("d").alias("d"))
    run = scan(order_buckets(steps, "at", keys), keys, ["at"], {"open": ("sum", F.col("d"), True)})
    return run.groupBy(*keys).agg(F.max("open").alias("max_open"))


def partition_by_key_span(seq: DataFrame, keys: list[str], order: list[str], letter: str) -> DataFrame:
    """Cut each sequence so that no letter lies in two pieces; piece lengths."""
    numbered = row_numbers(order_buckets(seq, order, keys), keys, order, "_pos")
    spans = numbered.groupBy(*keys, letter).agg(F.min("_pos").alias("first"), F.max("_pos").alias("last"))
    pieces = interval_runs(spans, keys, "first", "last")
    return pieces.select(*keys, "first", (F.col("last") - F.col("first") + 1).alias("length"))
