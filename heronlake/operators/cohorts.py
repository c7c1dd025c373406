"""Retention, first and latest rows per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from heronlake.functions.exact import ratio, rnd
from heronlake.plans.skew import keep_matching


def _returns(activity: DataFrame) -> DataFrame:
    """Per player the install date and whether the player came back the day after."""
    days = activity.select("player_id", "event_date").distinct()
    first = days.groupBy("player_id").agg(F.min("event_date").alias("install_date"))
    back = days.withColumn("install_date", F.date_sub("event_date", 1)).drop("event_date")
    return first.join(back.withColumn("back", F.lit(1)), ["player_id", "install_date"], "left")


def day1_return_fraction(activity: DataFrame) -> DataFrame:
    """Share of players back on the day after their first one."""
    return _returns(activity).agg(rnd(ratio(F.count("back"), F.count("*"))).alias("fraction"))


def install_retention(activity: DataFrame) -> DataFrame:
    """Installs and next-day retention per install date."""
    return _returns(activity).groupBy("install_date").agg(
        F.count("*").alias("installs"), rnd(ratio(F.count("back"), F.count("*"))).alias("day1_retention")
    )


def first_year_sales(sales: DataFrame) -> DataFrame:
    """All sales of a product in its first year."""
    years = sales.groupBy("product_id", "year").agg(F.count("*").alias("_n"))
    first = years.groupBy("product_id").agg(F.min("year").alias("year"), F.min_by("_n", "year").alias("_n"))
    return keep_matching(sales, first, ["product_id", "year"])


def latest_orders_per_product(orders: DataFrame, products: DataFrame) -> DataFrame:
    """All orders on the latest date of each product, ties kept."""
    dates = orders.groupBy("product_id", "order_date").agg(F.count("*").alias("_n"))
    last = dates.groupBy("product_id").agg(
        F.max("order_date").alias("order_date"), F.max_by("_n", "order_date").alias("_n")
    )
    return keep_matching(orders, last, ["product_id", "order_date"]).join(products, "product_id")
