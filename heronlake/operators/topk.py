"""Sorts with a limit: each map task keeps only its best rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from heronlake.functions.exact import ratio, rnd
from heronlake.functions.timeparts import in_month


def nth_highest_salary(emp: DataFrame, n: int) -> DataFrame:
    """The n-th highest distinct salary, null when there are fewer."""
    levels = emp.select("salary").distinct().orderBy(F.desc("salary")).limit(n)
    summary = levels.agg(F.min("salary").alias("low"), F.count("*").alias("have"))
    return summary.select(F.when(F.col("have") == n, F.col("low")).alias("nth_highest"))


def kth_largest(numbers: DataFrame, column: str, k: int) -> DataFrame:
    """The k-th largest value, duplicates counted."""
    best = numbers.select(column).orderBy(F.desc(column)).limit(k)
    summary = best.agg(F.min(column).alias("low"), F.count("*").alias("have"))
    return summary.select(F.when(F.col("have") == k, F.col("low")).alias("kth_largest"))


def most_friends(requests: DataFrame) -> DataFrame:
    """The person with most accepted requests on either side."""
    sides = F.explode(F.array("requester_id", "accepter_id"))
    both = requests.select(sides.alias("id")).groupBy("id").agg(F.count("*").alias("num"))
    return both.orderBy(F.desc("num"), "id").limit(1)


def movie_rating(ratings: DataFrame, users: DataFrame, movies: DataFrame, month: str) -> DataFrame:
    """The most active user, and the best rated title of one month."""
    counts = ratings.groupBy("user_id").agg(F.count("*").alias("n"))
    named = counts.join(users, "user_id").groupBy("name").agg(F.sum("n").alias("n"))
    user = named.orderBy(F.desc("n"), "name").limit(1).select(F.col("name").alias("results"))
    inside = ratings.where(in_month("created_at", month))
    sums = inside.groupBy("movie_id").agg(F.sum("rating").alias("s"), F.count("rating").alias("n"))
    titled = sums.join(movies, "movie_id").groupBy("title").agg(
        rnd(ratio(F.sum("s"), F.sum("n")), 6).alias("score")
    )
    movie = titled.orderBy(F.desc("score"), "title").limit(1).select(F.col("title").alias("results"))
    return user.unionAll(movie)


def sort_desc(df: DataFrame, column: str, key: str, n: int | None = None) -> DataFrame:
    """Rows by falling value, key order on ties; the head of them when n is given."""
    ordered = df.orderBy(F.desc(column), key)
    return ordered if n is None else ordered.limit(n)


def ordered_head(df: DataFrame, key: str, n: int, columns: list[str]) -> DataFrame:
    """The first n rows by a key, chosen columns."""
    return df.orderBy(key).limit(n).select(*columns)


def busiest_hours(trips: DataFrame, k: int = 5) -> DataFrame:
    """The k busiest and the k quietest hours."""
    hourly = trips.groupBy(F.hour("pickup_ts").alias("hour")).agg(F.count("*").alias("trips"))
    top = hourly.orderBy(F.desc("trips"), "hour").limit(k).withColumn("kind", F.lit("busiest"))
    low = hourly.orderBy("trips", "hour").limit(k).withColumn("kind", F.lit("quietest"))
    return top.unionByName(low)
