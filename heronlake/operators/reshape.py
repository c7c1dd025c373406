"""Set operations, pivots and unpivots."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from heronlake.functions.exact import rnd, total
from heronlake.functions.timeparts import month_key
from heronlake.plans.ordered import order_buckets, row_numbers


def transactions_chargebacks(txn: DataFrame, chargebacks: DataFrame) -> DataFrame:
    """Approved amounts and chargebacks side by side per month and country."""
    approved = txn.where("state = 'approved'").select(
        month_key("trans_date").alias("month"), "country", F.lit("approved").alias("type"), "amount"
    )
    returned = chargebacks.join(txn.select("id", "country", "amount"), F.col("trans_id") == F.col("id"))
    returned = returned.select(
        month_key("trans_date").alias("month"), "country", F.lit("chargeback").alias("type"), "amount"
    )
    columns = []
    for kind in ("approved", "chargeback"):
        one = F.col("type") == kind
        columns += [
            F.count_if(one).alias(f"{kind}_count"),
            total(F.when(one, F.col("amount")).otherwise(F.lit(0.0))).alias(f"{kind}_amount"),
        ]
    return approved.unionByName(returned).groupBy("month", "country").agg(*columns)


def primary_department(emp: DataFrame) -> DataFrame:
    """The flagged department of each employee, or the only one."""
    flagged = emp.where("primary_flag = 'Y'").select("employee_id", "department_id")
    single = emp.groupBy("employee_id").agg(
        F.any_value("department_id").alias("department_id"), F.count("*").alias("n")
    ).where("n = 1").drop("n")
    return flagged.unionByName(single).distinct()


def interview_candidates(contests: DataFrame, k: int = 3) -> DataFrame:
    """Users with k gold medals, or with golds in k contests in a row."""
    golds = contests.where("gold_medal = user_id").select("user_id", "contest_id").distinct()
    ranged = order_buckets(golds, "contest_id", ["user_id"])
    islands = row_numbers(ranged, ["user_id"], ["contest_id"]).groupBy(
        "user_id", (F.col("contest_id") - F.col("rn")).alias("island")
    ).agg(F.count("*").alias("n"))
    many = golds.groupBy("user_id").agg(F.count("*").alias("n"))
    return many.where(F.col("n") >= k).select("user_id").unionByName(
        islands.where(F.col("n") >= k).select("user_id")
    ).distinct()


def team_scores(teams: DataFrame, matches: DataFrame) -> DataFrame:
    """League table: matches, points, goals for, against and their difference."""

    def side(own: str, other: str):
        mine, theirs = F.col(f"{own}_goals"), F.col(f"{other}_goals")
        points = F.when(mine > theirs, 3).when(mine == theirs, 1).otherwise(0)
        return F.struct(
            F.col(f"{own}_team").alias("team_id"), points.alias("p"), mine.alias("f"), theirs.alias("a")
        )

    sides = F.explode(F.array(side("host", "guest"), side("guest", "host")))
    both = matches.select(sides.alias("m")).groupBy("m.team_id").agg(
        F.count("*").alias("matches_played"), F.sum("m.p").alias("points"),
        F.sum("m.f").alias("goal_for"), F.sum("m.a").alias("goal_against"),
    )
    diff = F.col("goal_for") - F.col("goal_against")
    return teams.join(both, "team_id").withColumn("goal_diff", diff).orderBy(
        F.desc("points"), F.desc("goal_diff"), "team_name"
    )


def merge_sorted(left: DataFrame, right: DataFrame, order: list[str]) -> DataFrame:
    """Two inputs as one ordered output, duplicates kept."""
    return left.unionByName(right).orderBy(*order)


def unpivot_stores(products: DataFrame, stores: list[str]) -> DataFrame:
    """One row per product and store that has a price."""
    return products.unpivot("product_id", stores, "store", "price").where("price is not null")


def pivot_stores(prices: DataFrame, stores: list[str]) -> DataFrame:
    """One price column per store."""
    return prices.groupBy("product_id").pivot("store", stores).agg(F.max("price"))


# Day numbers with Sunday as 1, week shown from Monday.
WEEK = {2: "monday", 3: "tuesday", 4: "wednesday", 5: "thursday", 6: "friday", 7: "saturday", 1: "sunday"}


def pivot_weekday(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Quantity per category and weekday; a category without orders shows 0."""
    sold = orders.groupBy("item_id", F.dayofweek("order_date").alias("dow")).agg(F.sum("quantity").alias("q"))
    columns = [
        F.sum(F.when(F.col("dow") == n, F.col("q")).otherwise(F.lit(0))).alias(name)
        for n, name in WEEK.items()
    ]
    return items.join(sold, "item_id", "left").groupBy("category").agg(*columns)


# Month labels.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def pivot_months(dept: DataFrame) -> DataFrame:
    """Twelve revenue columns per department, null where there is none."""
    wide = dept.groupBy("id").pivot("month", list(MONTHS)).agg(F.max("revenue"))
    return wide.select("id", *[F.col(m).alias(f"{m.lower()}_revenue") for m in MONTHS])


def pivot_by_rownum(students: DataFrame, continents: dict[str, str], order: str) -> DataFrame:
    """Names of each continent in order, side by side."""
    ranged = order_buckets(students, order, ["continent"])
    numbered = row_numbers(ranged, ["continent"], [order])
    wide = numbered.groupBy("rn").pivot("continent", list(continents)).agg(F.max("name"))
    return wide.select("rn", *[F.col(c).alias(out) for c, out in continents.items()])


def pivot_table_sum(trips: DataFrame, kinds: list[str]) -> DataFrame:
    """Revenue per hour and payment type, absent cells null."""
    return trips.groupBy(F.hour("pickup_ts").alias("hour")).pivot("payment_type", kinds).agg(
        rnd(total("fare_amount"))
    )
