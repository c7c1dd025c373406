"""Schema checks, quality counts, the clean-enrich-report job, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from heronlake.functions.exact import mean, ratio, rnd, total
from heronlake.functions.timeparts import is_rush_hour, is_weekend, minutes_between
from heronlake.operators.cleaning import dedup_keep, fill_by_column, iqr_fences
from heronlake.operators.scalar import bucket_cut
from heronlake.plans.ordered import order_buckets, quantiles, row_numbers
from heronlake.plans.shared import cut_lineage
from heronlake.sources.tables import ValidationError

# Columns a trip job needs, defaults for its nulls, duplicate key.
REQUIRED = ("pickup_ts", "dropoff_ts", "fare_amount", "trip_distance", "passenger_count", "payment_type", "tip_amount")
DEFAULTS = {"passenger_count": 1, "congestion_surcharge": 0.0, "airport_fee": 0.0, "tip_amount": 0.0}
TRIP_KEY = ("pickup_ts", "fare_amount", "trip_distance")


def missing_columns(df: DataFrame, required=REQUIRED) -> list[str]:
    """Required names the frame lacks; reads only its schema."""
    return sorted(set(required) - set(df.columns))


def validate_schema(df: DataFrame, required=REQUIRED) -> DataFrame:
    """The frame itself, or a ValidationError that names what is missing."""
    missing = missing_columns(df, required)
    if missing:
        raise ValidationError("missing columns", missing)
    return df


def trip_rules(max_fare: float = 500) -> dict[str, Column]:
    """Quality rules as conditions on a trip."""
    fare = F.col("fare_amount")
    return {
        "negative_fares": fare < 0,
        "zero_distance": F.col("trip_distance") == 0,
        "null_fare": fare.isNull(),
        "fare_over_max": fare > max_fare,
        "zero_passenger": F.col("passenger_count") == 0,
    }


def quality_counts(trips: DataFrame, max_fare: float = 500) -> DataFrame:
    """Rows that break each rule, all breaks and their rate, in one pass."""
    rules = trip_rules(max_fare)
    one = trips.agg(F.count("*").alias("_rows"), *[F.count_if(c).alias(n) for n, c in rules.items()])
    one = one.withColumn("total_issues", sum((F.col(n) for n in rules), F.lit(0).cast("long")))
    long = one.unpivot(["_rows"], [*rules, "total_issues"], "issue", "issue_count")
    return long.select("issue", "issue_count", rnd(100 * ratio("issue_count", "_rows")).alias("issue_rate_pct"))


def audit_rules(max_fare: float = 500) -> dict[str, Column]:
    """Rules of the revenue audit."""
    rules = trip_rules(max_fare)
    return {
        "negative_fare": rules["negative_fares"], "zero_distance": rules["zero_distance"],
        "fare_over_max": rules["fare_over_max"], "negative_tip": F.col("tip_amount") < 0,
        "zero_passenger": rules["zero_passenger"],
    }


def quality_revenue_audit(trips: DataFrame, max_fare: float = 500) -> DataFrame:
    """Rows, percent of trips and revenue at stake per rule, and what stays clean."""
    rules = audit_rules(max_fare)
    broken = F.lit(False)
    for c in rules.values():
        broken = broken | F.coalesce(c, F.lit(False))
    groups = {**rules, "clean": ~broken}
    cells = [
        F.struct(
            F.lit(n).alias("issue"), F.count_if(c).alias("issue_count"),
            rnd(100 * ratio(F.count_if(c), F.count("*"))).alias("pct_trips"),
            rnd(F.coalesce(total(F.when(c, F.col("fare_amount"))), F.lit(0.0))).alias("revenue"),
        )
        for n, c in groups.items()
    ]
    return trips.agg(F.array(*cells).alias("rows")).select(F.inline("rows"))


def _flagged(trips: DataFrame) -> DataFrame:
    names = [c for c in ("passenger_count", "congestion_surcharge", "airport_fee") if c in trips.columns]
    return trips.withColumns({f"{c}_was_null": F.col(c).isNull() for c in names})


def _in_range(max_fare: float, min_distance: float) -> Column:
    fare = F.col("fare_amount")
    return (
        (fare > 0) & (fare <= max_fare) & (F.col("trip_distance") >= min_distance) & (F.col("passenger_count") > 0)
    )


def clean_trips(
    trips: DataFrame, max_fare: float = 500, min_distance: float = 0.1, order: str = "trip_id"
) -> DataFrame:
    """Flag and fill nulls, drop rows out of range, keep the first of each copy."""
    filled = fill_by_column(_flagged(trips), DEFAULTS)
    return dedup_keep(filled.where(_in_range(max_fare, min_distance)), list(TRIP_KEY), [order], "first")


def clean_counts(trips: DataFrame, max_fare: float = 500, min_distance: float = 0.1) -> DataFrame:
    """Rows before and after :func:`clean_trips`; the percent is null on empty input."""
    stages = run_metrics(trips, max_fare, min_distance)
    return stages.agg(
        F.max("rows_in").alias("rows_before"), F.min("rows_out").alias("rows_after")
    ).withColumn("removal_pct", rnd(100 * ratio(F.col("rows_before") - F.col("rows_after"), "rows_before")))


def run_metrics(trips: DataFrame, max_fare: float = 500, min_distance: float = 0.1) -> DataFrame:
    """Rows in, out and dropped per stage.

    Copies are counted per key first, so one pass and one small shuffle give
    every stage.
    """
    filled = fill_by_column(trips, DEFAULTS)
    good = F.coalesce(_in_range(max_fare, min_distance), F.lit(False))
    keys = filled.groupBy(*TRIP_KEY).agg(F.count("*").alias("n"), F.count_if(good).alias("g"))
    one = keys.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("g"), F.lit(0)).alias("g"),
        F.count_if(F.col("g") > 0).alias("k"),
    )
    row = lambda name, a, b: F.struct(
        F.lit(name).alias("stage"), F.col(a).alias("rows_in"), F.col(b).alias("rows_out"),
        (F.col(a) - F.col(b)).alias("rows_dropped"),
    )
    stages = F.array(row("ingest", "n", "n"), row("filter", "n", "g"), row("dedup", "g", "k"))
    return one.select(F.inline(stages))


def enrich_trips(trips: DataFrame) -> DataFrame:
    """Time features, duration, revenue per mile, total, bucket and outlier flag.

    The trips are written out once, as the fences read their fares several
    times.
    """
    trips = cut_lineage(trips)
    fare = F.col("fare_amount")
    extra = F.coalesce("congestion_surcharge", F.lit(0.0)) if "congestion_surcharge" in trips.columns else F.lit(0.0)
    out = trips.withColumn("_f", iqr_fences(trips, "fare_amount"))
    return out.withColumns(
        {
            "hour": F.hour("pickup_ts"),
            "day_of_week": F.date_format("pickup_ts", "EEEE"),
            "month": F.month("pickup_ts"),
            "is_weekend": is_weekend("pickup_ts"),
            "is_rush_hour": is_rush_hour("pickup_ts"),
            "duration_min": rnd(minutes_between("pickup_ts", "dropoff_ts")),
            "revenue_per_mile": rnd(ratio(fare, "trip_distance")),
            "total_amount_calc": rnd(fare + F.col("tip_amount") + extra),
            "fare_bucket": bucket_cut("fare_amount"),
            "is_fare_outlier": (fare < F.col("_f.low")) | (fare > F.col("_f.high")),
        }
    ).drop("_f")


def revenue_per_mile_stats(trips: DataFrame) -> DataFrame:
    """Mean, median and 95th percentile of revenue per mile of sensible trips."""
    good = trips.where((F.col("trip_distance") > 0) & (F.col("fare_amount") > 0))
    per_mile = good.select((F.col("fare_amount") / F.col("trip_distance")).alias("v"))
    q = quantiles(per_mile, "v", {"median": 0.5, "p95": 0.95}).select(F.struct("median", "p95")).scalar()
    return per_mile.agg(rnd(F.avg("v"), 4).alias("mean")).withColumn("_q", q).select(
        "mean", rnd("_q.median", 4).alias("median"), rnd("_q.p95", 4).alias("p95")
    )


def trip_summary_report(clean: DataFrame) -> DataFrame:
    """Headline numbers of an enriched trip table as one row."""
    fare = F.col("fare_amount")
    median = quantiles(clean, "fare_amount", {"m": 0.5}).select("m").scalar()
    share = lambda c: rnd(100 * ratio(F.count_if(F.col(c)), F.count(c)))
    return clean.agg(
        F.count("*").alias("rows"), rnd(mean(fare)).alias("fare_mean"), F.max(fare).alias("fare_max"),
        F.min(fare).alias("fare_min"), rnd(mean("trip_distance")).alias("avg_distance"),
        rnd(mean("duration_min")).alias("avg_duration_min"), rnd(total(fare)).alias("total_revenue"),
        share("is_weekend").alias("weekend_pct"), share("is_rush_hour").alias("rush_hour_pct"),
        share("is_fare_outlier").alias("outlier_pct"),
    ).withColumn("fare_median", rnd(median))


def trip_report(trips: DataFrame) -> DataFrame:
    """One nested row: rows, fare numbers, payment types and bucket counts."""
    fare = F.col("fare_amount")
    stats = F.struct(rnd(mean(fare)).alias("mean"), F.max(fare).alias("max"), F.min(fare).alias("min"))
    by_type = trips.groupBy("payment_type").agg(
        F.count(fare).alias("trips"), rnd(total(fare)).alias("revenue"), rnd(mean(fare)).alias("avg_fare")
    )
    breakdown = by_type.agg(
        F.map_from_entries(F.collect_list(F.struct("payment_type", F.struct("trips", "revenue", "avg_fare"))))
    ).scalar()
    buckets = trips.select(bucket_cut("fare_amount").alias("b")).where("b is not null").groupBy("b").agg(
        F.count("*").alias("n")
    ).agg(F.map_from_entries(F.collect_list(F.struct("b", "n")))).scalar()
    return trips.agg(F.count("*").alias("rows"), stats.alias("fare_stats")).withColumns(
        {"payment_breakdown": breakdown, "fare_bucket_counts": buckets}
    )


def dataset_overview(df: DataFrame, name: str) -> DataFrame:
    """Table, rows, column, type and null count, one row per column."""
    types = dict(df.dtypes)
    cells = [
        F.struct(
            F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
            F.count("*").alias("rows"), F.count_if(F.col(c).isNull()).alias("null_count"),
        )
        for c in df.columns
    ]
    return df.agg(F.array(*cells).alias("rows")).select(F.inline("rows"))


def batch_counts(df: DataFrame, order: str, size: int) -> DataFrame:
    """Rows per batch of a fixed size, in order."""
    numbered = row_numbers(order_buckets(df.select(order), order), [], [order])
    batch = F.floor((F.col("rn") - 1) / size).cast("long")
    return numbered.groupBy(batch.alias("batch")).agg(F.count("*").alias("rows"))
