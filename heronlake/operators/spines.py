"""Reports over a full spine: months, dates, ids, categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from heronlake.functions.exact import dec, ratio, rnd
from heronlake.functions.timeparts import in_year
from heronlake.operators.reshape import MONTHS
from heronlake.plans.skew import keys_of


def month_spine(spark: SparkSession) -> DataFrame:
    """The numbers 1 to 12 as ``month``."""
    return spark.range(1, 13).select(F.col("id").cast("int").alias("month"))


def month_names(spark: SparkSession) -> DataFrame:
    """Literal rows: month number and label."""
    return spark.createDataFrame(list(enumerate(MONTHS, 1)), "month int, name string")


def _joined_by_month(joined_on: str, year: int):
    """1..12 for a date inside the year, 0 for earlier years, null for later ones."""
    y = F.year(joined_on)
    return F.when(y < year, 0).when(y == year, F.month(joined_on))


def monthly_active_and_rides(drivers: DataFrame, rides: DataFrame, accepted: DataFrame, year: int) -> DataFrame:
    """Drivers signed up so far and rides accepted, for each month of a year.

    Drivers are counted per month of joining and summed up over the twelve
    rows, so no driver meets every month.
    """
    spark = drivers.sparkSession
    joined = drivers.groupBy(_joined_by_month("join_date", year).alias("month")).agg(F.count("*").alias("n"))
    taken = rides.where(in_year("requested_at", year)).join(accepted, "ride_id")
    per_month = taken.groupBy(F.month("requested_at").alias("month")).agg(F.count("*").alias("accepted"))
    months = spark.range(0, 13).select(F.col("id").cast("int").alias("month"))
    upto = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    out = months.join(joined, "month", "left").join(per_month, "month", "left").select(
        "month", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("active_drivers"),
        F.coalesce("accepted", F.lit(0)).alias("accepted_rides"),
    )
    return out.where("month > 0")


def working_driver_pct(drivers: DataFrame, rides: DataFrame, accepted: DataFrame, year: int) -> DataFrame:
    """Percent of the drivers so far who accepted a ride in each month."""
    spark = drivers.sparkSession
    since = drivers.select("driver_id", _joined_by_month("join_date", year).alias("since")).where("since is not null")
    since = since.groupBy("driver_id").agg(F.min("since").alias("since"))
    joined = since.groupBy(F.col("since").alias("month")).agg(F.count("*").alias("n"))
    taken = rides.where(in_year("requested_at", year)).join(accepted, "ride_id")
    worked = taken.select(F.month("requested_at").alias("month"), "driver_id").distinct()
    active = worked.join(since, "driver_id").where("since <= month")
    busy = active.groupBy("month").agg(F.count("*").alias("busy"))
    months = spark.range(0, 13).select(F.col("id").cast("int").alias("month"))
    upto = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    out = months.join(joined, "month", "left").join(busy, "month", "left").withColumn("all", F.sum("n").over(upto))
    pct = rnd(F.coalesce(100 * ratio(F.coalesce("busy", F.lit(0)), "all"), F.lit(0.0)))
    return out.where("month > 0").select("month", pct.alias("working_percentage"))


def purchase_platform(spending: DataFrame) -> DataFrame:
    """Amount and users per date and platform, zeros included.

    Users of both platforms form a third class that the spine does not hold,
    so they are not reported; this follows the source statement.
    """
    dates = spending.select("spend_date").distinct()
    spine = dates.withColumn("platform", F.explode(F.array(F.lit("desktop"), F.lit("mobile"))))
    users = spending.groupBy("spend_date", "user_id").agg(
        F.min("platform").alias("lo"), F.max("platform").alias("hi"), F.sum(dec("amount")).alias("s")
    )
    kind = F.when(F.col("lo") == F.col("hi"), F.col("hi")).otherwise("both")
    sums = users.groupBy("spend_date", kind.alias("platform")).agg(F.sum("s").alias("s"), F.count("*").alias("n"))
    return spine.join(sums, ["spend_date", "platform"], "left").select(
        "spend_date", "platform", F.coalesce("s", F.lit(0)).cast("double").alias("total_amount"),
        F.coalesce("n", F.lit(0)).alias("total_users"),
    )


def transactions_per_visit(visits: DataFrame, txn: DataFrame) -> DataFrame:
    """How many visits had 0, 1, 2, ... transactions, up to the largest count."""
    days = visits.groupBy("user_id", "visit_date").agg(F.count("*").alias("times"))
    made = txn.groupBy("user_id", F.col("transaction_date").alias("visit_date")).agg(F.count("*").alias("n"))
    joined = days.join(made, ["user_id", "visit_date"], "left")
    counts = joined.groupBy(
        F.coalesce(F.col("times") * F.col("n"), F.lit(0).cast("long")).alias("transactions_count")
    ).agg(F.count("*").alias("visits_count"))
    top = counts.agg(F.max("transactions_count")).first()[0]
    spine = visits.sparkSession.range(0 if top is None else top + 1).withColumnRenamed("id", "transactions_count")
    return spine.join(counts, "transactions_count", "left").fillna(0, ["visits_count"])


def missing_subtasks(tasks: DataFrame, executed: DataFrame) -> DataFrame:
    """Subtasks 1..n of each task that were not executed."""
    every = tasks.select(
        "task_id", F.explode(F.sequence(F.lit(1), F.col("subtasks_count"))).alias("subtask_id")
    )
    return every.join(keys_of(executed, "task_id", "subtask_id"), ["task_id", "subtask_id"], "left_anti")


def missing_ids(ids: DataFrame, column: str) -> DataFrame:
    """Numbers from 1 to the largest id that are not in use.

    Only the largest id comes to the driver; the range is made by the tasks.
    """
    top = ids.agg(F.max(column)).first()[0] or 0
    every = ids.sparkSession.range(1, top + 1).select(F.col("id").alias("ids"))
    return every.join(ids.select(F.col(column).alias("ids")).distinct(), "ids", "left_anti")


def experiment_matrix(runs: DataFrame, platforms: list[str], experiments: list[str]) -> DataFrame:
    """Experiments per platform and name, with zeros for the pairs not tried."""
    spark = runs.sparkSession
    pairs = [(p, e) for p in platforms for e in experiments]
    spine = spark.createDataFrame(pairs, "platform string, experiment_name string")
    counts = runs.groupBy("platform", "experiment_name").agg(F.count("*").alias("num_experiments"))
    return spine.join(counts, ["platform", "experiment_name"], "left").fillna(0, ["num_experiments"])


# Income classes and their limits.
LOW_INCOME, HIGH_INCOME = 20000, 50000


def salary_categories(accounts: DataFrame) -> DataFrame:
    """Accounts per income class, zeros included."""
    income = F.col("income")
    one = accounts.agg(
        F.count_if(income < LOW_INCOME).alias("Low Salary"),
        F.count_if(F.coalesce((income >= LOW_INCOME) & (income <= HIGH_INCOME), F.lit(True))).alias("Average Salary"),
        F.count_if(income > HIGH_INCOME).alias("High Salary"),
    )
    return one.unpivot([], ["Low Salary", "Average Salary", "High Salary"], "category", "accounts_count")
