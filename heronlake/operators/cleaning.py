"""Nulls, duplicates, outliers, strings and dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from heronlake.functions.exact import mean, ratio, rnd
from heronlake.functions.timeparts import is_rush_hour, is_weekend, minutes_between
from heronlake.plans.ordered import quantiles
from heronlake.plans.skew import attach, keep_matching


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and percent of every column that has nulls, in one pass."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    long = counts.unpivot(["_rows"], df.columns, "column_name", "null_count")
    return long.where("null_count > 0").select(
        "column_name", "null_count", rnd(100 * ratio("null_count", "_rows")).alias("null_pct")
    )


def drop_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that have every required column."""
    return df.dropna(subset=columns)


def drop_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """How many rows :func:`drop_nulls` removes."""
    lacks = F.lit(False)
    for c in columns:
        lacks = lacks | F.col(c).isNull()
    return df.agg(
        F.count("*").alias("rows_before"), F.count_if(~lacks).alias("rows_after"),
        F.count_if(lacks).alias("dropped"), rnd(100 * ratio(F.count_if(lacks), F.count("*"))).alias("dropped_pct"),
    )


def fill_by_column(df: DataFrame, defaults: dict) -> DataFrame:
    """Per-column defaults; names the frame lacks are skipped."""
    return df.fillna({c: v for c, v in defaults.items() if c in df.columns})


def flag_and_fill(df: DataFrame, column: str, default) -> DataFrame:
    """Note which values were null, then fill them."""
    return df.withColumn(f"{column}_was_null", F.col(column).isNull()).fillna({column: default})


def fill_group_median(df: DataFrame, key: str, column: str) -> DataFrame:
    """Nulls become the median of their group."""
    medians = quantiles(df, column, {"_median": 0.5}, [key])
    groups = df.groupBy(key).agg(F.count("*").alias("_n")).join(medians, key, "left")
    return attach(df, groups, [key]).withColumn(column, F.coalesce(column, "_median")).drop("_median")


def count_exact_duplicates(df: DataFrame) -> DataFrame:
    """Rows equal to another row that was counted before, on all columns."""
    return count_key_duplicates(df, df.columns)


def count_key_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def dedup_keep(df: DataFrame, keys: list[str], order: list[str], keep: str = "first") -> DataFrame:
    """One row per key, the first or last in an explicit order.

    An aggregate, not a window: a key with many copies leaves each map task as
    one row.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by if keep == "first" else F.max_by
    best = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def all_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row whose key occurs more than once."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    return keep_matching(df, repeated, keys)


def dedup_row_number(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Row number one of each key."""
    return dedup_keep(df, keys, order, "first")


def fuzzy_time_duplicates(trips: DataFrame) -> DataFrame:
    """Trips beyond the first with the same minute, fare and passengers."""
    minute = F.date_format("pickup_ts", "yyyy-MM-dd HH:mm").alias("pickup_minute")
    return count_key_duplicates(
        trips.select(minute, "fare_amount", "passenger_count"), ["pickup_minute", "fare_amount", "passenger_count"]
    )


def iqr_fences(df: DataFrame, column: str, width: float = 1.5) -> Column:
    """Scalar struct of q1, q3 and both fences."""
    q = quantiles(df, column, {"q1": 0.25, "q3": 0.75})
    spread = (F.col("q3") - F.col("q1")) * width
    return q.select(
        F.struct("q1", "q3", (F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high"))
    ).scalar()


def iqr_outliers(df: DataFrame, column: str) -> DataFrame:
    """Quartiles, fences, and how many values lie outside."""
    fenced = df.select(column, iqr_fences(df, column).alias("f"))
    out = (F.col(column) < F.col("f.low")) | (F.col(column) > F.col("f.high"))
    return fenced.agg(
        *[rnd(F.first(f"f.{n}"), 4).alias(n) for n in ("q1", "q3", "low", "high")],
        F.count_if(out).alias("outliers"), rnd(100 * ratio(F.count_if(out), F.count("*")), 4).alias("outlier_pct"),
    )


def zscore_outliers(df: DataFrame, column: str, limit: float = 3) -> DataFrame:
    """Rows further than the limit from the mean, in sample deviations."""
    stats = df.agg(F.struct(mean(column).alias("m"), F.stddev_samp(column).alias("s"))).scalar()
    z = ratio(F.col(column) - F.col("_s.m"), "_s.s")
    scored = df.withColumn("_s", stats).withColumn("zscore", rnd(z, 4)).drop("_s")
    return scored.where(F.abs("zscore") > limit)


def log_skewness(df: DataFrame, column: str) -> DataFrame:
    """Bias-corrected skewness of the positive values and of log1p of all."""
    plain = F.when(F.col(column) > 0, F.col(column))
    logged = F.log1p(F.greatest(F.col(column), F.lit(0.0)))

    def corrected(c):
        n = F.count(c).cast("double")
        return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))

    return df.agg(rnd(corrected(plain), 4).alias("skewness"), rnd(corrected(logged), 4).alias("log_skewness"))


def winsorize(df: DataFrame, column: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Cap values at two quantiles and mark what was capped."""
    limits = quantiles(df, column, {"lo": low, "hi": high}).select(F.struct("lo", "hi")).scalar()
    value = F.col(column)
    capped = F.least(F.greatest(value, F.col("_q.lo")), F.col("_q.hi"))
    return df.withColumn("_q", limits).withColumns(
        {
            "capped": F.when(value.isNotNull(), capped),
            "was_capped": F.coalesce((value < F.col("_q.lo")) | (value > F.col("_q.hi")), F.lit(False)),
        }
    ).drop("_q")


# Characters that clean names and phone numbers lose.
NAME_MARKS, PHONE_MARKS = r"['-]", r"[\s().+-]"


def clean_store_name(name) -> Column:
    """Trimmed lower case without apostrophes and hyphens, single blanks."""
    plain = F.regexp_replace(F.lower(F.trim(name)), NAME_MARKS, "")
    return F.regexp_replace(plain, r"\s+", " ")


def clean_phone(phone) -> Column:
    """Digits without punctuation and without the leading country code 1."""
    return F.regexp_replace(F.regexp_replace(phone, PHONE_MARKS, ""), "^1", "")


# Fixed value: shape of a mail address.
EMAIL = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"


def valid_email(mail) -> Column:
    """Whether the trimmed, lower-case text looks like a mail address."""
    return F.rlike(F.lower(F.trim(mail)), F.lit(EMAIL))


def normalize_category(name) -> Column:
    """Lower case, hyphens and underscores as blanks, single blanks."""
    return F.regexp_replace(F.regexp_replace(F.trim(F.lower(name)), "[-_]", " "), r"\s+", " ")


def extract_zip(text) -> Column:
    """First five digits in a row once blanks are out, null when there are none."""
    return F.nullif(F.regexp_extract(F.regexp_replace(text, r"\s", ""), r"(\d{5})", 1), F.lit(""))


def parse_timestamp_strict(text, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """A timestamp without a zone, null for anything that does not fit the format."""
    shape = F.rlike(text, F.lit(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"))
    return F.when(shape, F.try_to_timestamp(text, F.lit(fmt))).cast("timestamp_ntz")


# Date formats in the order they are tried, with their shape.
DATE_FORMATS = (
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^\d{2}/\d{2}/\d{4}$", "MM/dd/yyyy"),
    (r"^[A-Z][a-z]+ \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^\d{8}$", "yyyyMMdd"),
)


def parse_mixed_dates(text) -> Column:
    """The first format that fits; null when none does."""
    tries = [
        F.when(F.rlike(text, F.lit(shape)), F.try_to_timestamp(text, F.lit(fmt))).cast("date")
        for shape, fmt in DATE_FORMATS
    ]
    return F.coalesce(*tries)


def to_utc(ts, zone: str = "America/New_York") -> Column:
    """Wall time in a zone as wall time in UTC."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)


def time_components(df: DataFrame, ts: str) -> DataFrame:
    """Hour, weekday name, month, weekend flag and rush-hour flag."""
    return df.withColumns(
        {
            "hour": F.hour(ts), "day_of_week": F.date_format(ts, "EEEE"), "month": F.month(ts),
            "is_weekend": is_weekend(ts), "is_rush_hour": is_rush_hour(ts),
        }
    )


def duration_stats(trips: DataFrame) -> DataFrame:
    """Mean and median minutes of sensible trips, very short and very long ones."""
    timed = trips.select(minutes_between("pickup_ts", "dropoff_ts").alias("d"))
    good = (F.col("d") > 0) & (F.col("d") < 180)
    median = quantiles(timed.where(good), "d", {"m": 0.5}).select("m").scalar()
    return timed.agg(
        rnd(mean(F.when(good, F.col("d")))).alias("avg_min"),
        F.count_if(F.col("d") < 2).alias("under_2"), F.count_if(F.col("d") > 120).alias("over_120"),
    ).withColumn("median_min", rnd(median))
