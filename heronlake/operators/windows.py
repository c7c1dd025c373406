"""Ranks, running values and comparisons with neighbouring rows.

Windows run on rows that are already aggregated, are cut early by a rank
filter, or go through ordered ranges (:mod:`heronlake.plans.ordered`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from heronlake.functions.exact import dec, flag, mean, ratio, rnd, total
from heronlake.functions.timeparts import in_year
from heronlake.plans.ordered import order_buckets, scan
from heronlake.plans.skew import attach, keep_matching


def department_top3(emp: DataFrame, dept: DataFrame, k: int = 3) -> DataFrame:
    """Everyone on one of the k highest distinct salaries of a department."""
    levels = emp.groupBy("dept_id", "salary").agg(F.count("*").alias("_n"))
    order = Window.partitionBy("dept_id").orderBy(F.desc("salary"))
    best = levels.withColumn("rnk", F.row_number().over(order)).where(F.col("rnk") <= k)
    top = keep_matching(emp, best, ["dept_id", "salary"]).join(dept, "dept_id")
    return top.select("department", "employee", "salary")


def rank_scores(scores: DataFrame) -> DataFrame:
    """Dense rank of every score, highest first.

    Only distinct scores are numbered; the rank is joined back by score.
    """
    levels = order_buckets(scores.groupBy("score").agg(F.count("*").alias("_n")), "score")
    ranks = scan(levels, [], ["score"], {"rank": ("sum", F.lit(1).cast("long"), True)}, reverse=True)
    return attach(scores, ranks.select("score", "rank", "_n"), ["score"])


def tournament_winners(players: DataFrame, matches: DataFrame) -> DataFrame:
    """Best player per group by total points, the smaller id on a tie."""
    side = lambda s: F.struct(
        F.col(f"{s}_player").alias("player_id"), F.col(f"{s}_score").alias("score")
    )
    sides = matches.select(F.explode(F.array(side("first"), side("second"))).alias("m")).select("m.*")
    points = sides.groupBy("player_id").agg(F.sum("score").alias("points"))
    scored = players.join(points, "player_id")
    best = F.max_by("player_id", F.struct("points", -F.col("player_id")))
    return scored.groupBy("group_id").agg(best.alias("player_id"))


def most_frequent_products(orders: DataFrame, products: DataFrame) -> DataFrame:
    """The products each customer ordered most often, ties kept."""
    counts = orders.groupBy("customer_id", "product_id").agg(F.count("*").alias("n"))
    levels = counts.groupBy("customer_id", "n").agg(F.count("*").alias("_n"))
    most = levels.groupBy("customer_id").agg(F.max("n").alias("n"), F.max_by("_n", "n").alias("_n"))
    return keep_matching(counts, most, ["customer_id", "n"]).join(products, "product_id").select(
        "customer_id", "product_id", "product_name"
    )


def max_txn_per_day(txn: DataFrame) -> DataFrame:
    """Transactions with the highest amount of their day, ties kept."""
    levels = txn.groupBy("day", "amount").agg(F.count("*").alias("_n"))
    most = levels.groupBy("day").agg(F.max("amount").alias("amount"), F.max_by("_n", "amount").alias("_n"))
    return keep_matching(txn, most, ["day", "amount"]).select("transaction_id")


def top_sellers_per_state(items: DataFrame, sellers: DataFrame, k: int = 3) -> DataFrame:
    """Sellers ranked by revenue within their state, the first k ranks."""
    sums = items.groupBy("seller_id").agg(
        F.count_distinct("order_id").alias("total_orders"), rnd(total("price")).alias("revenue")
    )
    order = Window.partitionBy("seller_state").orderBy(F.desc("revenue"))
    ranked = sums.join(sellers, "seller_id").withColumn("seller_rank", F.rank().over(order))
    return ranked.where(F.col("seller_rank") <= k).select(
        "seller_state", "seller_id", "total_orders", "revenue", "seller_rank"
    )


def second_most_recent(activity: DataFrame) -> DataFrame:
    """Second latest activity per user, or the only one.

    Two rows per user survive the first rank, cut before the shuffle.
    """
    order = Window.partitionBy("username").orderBy(
        F.desc("end_date"), F.desc("start_date"), F.desc("activity")
    )
    two = activity.withColumn("rn", F.row_number().over(order)).where("rn <= 2")
    last = F.max_by(F.struct("activity", "start_date", "end_date"), "rn")
    return two.groupBy("username").agg(last.alias("a")).select("username", "a.*")


def team_size(emp: DataFrame) -> DataFrame:
    """Size of each employee's team."""
    sizes = emp.groupBy("team_id").agg(F.count("*").alias("team_size"), F.count("*").alias("_n"))
    return attach(emp, sizes, ["team_id"]).select("employee_id", "team_size")


def active_businesses(events: DataFrame) -> DataFrame:
    """Businesses above the mean of more than one event type."""
    means = events.groupBy("event_type").agg(
        ratio(F.sum("occurrences"), F.count("*")).alias("m"), F.count("*").alias("_n")
    )
    above = attach(events, means, ["event_type"]).where("occurrences > m")
    return above.groupBy("business_id").agg(F.count("*").alias("n")).where("n > 1").select("business_id")


def running_total_by_group(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Sum of all values of the group up to and including each row."""
    ranged = order_buckets(df, order, [key])
    run = scan(ranged, [key], order, {"running_total": ("sum", dec(value), True)})
    return run.withColumn("running_total", F.col("running_total").cast("double"))


def moving_average_7(payments: DataFrame, days: int = 7) -> DataFrame:
    """Sum and mean of the last seven daily totals, full windows only."""
    daily = payments.groupBy("visited_on").agg(F.sum(dec("amount")).alias("s"))
    order = Window.orderBy("visited_on")
    week = order.rowsBetween(1 - days, 0)
    out = daily.select(
        "visited_on", F.row_number().over(order).alias("rn"), F.sum("s").over(week).alias("w")
    ).where(F.col("rn") >= days)
    return out.select(
        "visited_on", F.col("w").cast("double").alias("amount"),
        rnd(ratio("w", F.lit(days))).alias("average_amount"),
    )


def rolling_3_month(months: DataFrame, rides: DataFrame, year: int) -> DataFrame:
    """Mean distance and duration of each month and the two before; no ride is 0."""
    sums = rides.where(in_year("requested_at", year)).groupBy(F.month("requested_at").alias("month")).agg(
        F.sum(dec("ride_distance")).alias("d"), F.sum(dec("ride_duration")).alias("m")
    )
    filled = months.join(sums, "month", "left").fillna(0)
    w = Window.orderBy("month").rowsBetween(-2, 0)
    mean_of = lambda c: rnd(ratio(F.sum(c).over(w), F.count(F.lit(1)).over(w)))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("decimal(18,6)"))
    filled = filled.withColumns({"d": zero("d"), "m": zero("m")})
    return filled.select(
        "month", mean_of("d").alias("average_ride_distance"), mean_of("m").alias("average_ride_duration")
    )


def cumulative_salary(emp: DataFrame) -> DataFrame:
    """Three-row running pay per employee without the latest month."""
    months = emp.groupBy("id", "month").agg(F.sum(dec("salary")).alias("salary"))
    last = months.groupBy("id").agg(F.max("month").alias("last"))
    kept = months.join(last, "id").where("month <> last")
    w = Window.partitionBy("id").orderBy("month").rowsBetween(-2, 0)
    return kept.select("id", "month", F.sum("salary").over(w).cast("double").alias("salary"))


def last_to_fit(queue: DataFrame, capacity: int = 1000) -> DataFrame:
    """Last person in the queue before the total weight passes the capacity."""
    ranged = order_buckets(queue, "turn")
    run = scan(ranged, [], ["turn"], {"load": ("sum", F.col("weight"), True)})
    fits = run.where(F.col("load") <= capacity)
    return fits.orderBy(F.desc("load"), F.desc("turn")).limit(1).select("person_name")


def hiring_budget(candidates: DataFrame, budget: float = 70000) -> DataFrame:
    """Seniors hired cheapest first, then juniors from what is left."""
    ranged = order_buckets(candidates, ["salary", "employee_id"], ["experience"])
    cost = {"cost": ("sum", dec("salary"), True)}
    run = scan(ranged, ["experience"], ["salary", "employee_id"], cost)
    seniors = run.where((F.col("experience") == "Senior") & (F.col("cost") <= budget))
    spent = seniors.agg(F.coalesce(F.sum(dec("salary")), F.lit(0))).scalar()
    counts = run.agg(
        F.count_if((F.col("experience") == "Senior") & (F.col("cost") <= budget)).alias("Senior"),
        F.count_if((F.col("experience") == "Junior") & (F.col("cost") <= F.lit(budget) - spent)).alias("Junior"),
    )
    return counts.unpivot([], ["Senior", "Junior"], "experience", "accepted_candidates")


def median_rows(emp: DataFrame) -> DataFrame:
    """The middle row, or the two middle rows, of each company by salary."""
    ranged = order_buckets(emp, ["salary", "id"], ["company"])
    one = F.lit(1).cast("long")
    joined = scan(ranged, ["company"], ["salary", "id"], {"rn": ("sum", one, True), "n": ("total", one, True)})
    return joined.where("rn * 2 >= n and rn * 2 <= n + 2").select("id", "company", "salary")


def frequency_median(numbers: DataFrame) -> DataFrame:
    """Median of numbers given with their frequency."""
    counts = numbers.groupBy("num").agg(F.sum("frequency").alias("frequency"))
    ranged = order_buckets(counts, "num")
    size = F.col("frequency")
    run = scan(ranged, [], ["num"], {"upto": ("sum", size, True), "all": ("total", size, True)})
    after = F.col("all") - F.col("upto") + F.col("frequency")
    middle = run.where(
        (F.col("upto") * 2 >= F.col("all")) & (after * 2 >= F.col("all"))
    )
    return middle.agg(rnd(mean("num"), 1).alias("median"))


def increasing_purchases(txn: DataFrame) -> DataFrame:
    """Customers whose yearly total rises every year without a gap."""
    yearly = txn.groupBy("customer_id", F.year("transaction_date").alias("yr")).agg(
        F.sum(dec("amount")).alias("s")
    )
    w = Window.partitionBy("customer_id").orderBy("yr")
    prior = yearly.select("customer_id", "yr", "s", F.lag("s").over(w).alias("ps"), F.lag("yr").over(w).alias("py"))
    broken = flag(F.col("ps").isNotNull() & ((F.col("s") <= F.col("ps")) | (F.col("yr") != F.col("py") + 1)))
    return prior.groupBy("customer_id").agg(F.max(broken).alias("b")).where("b = 0").select("customer_id")


def hourly_drop_flag(trips: DataFrame, drop: float = -20) -> DataFrame:
    """Revenue per hour, change from the hour before and whether it fell too far."""
    hourly = trips.groupBy(F.hour("pickup_ts").alias("hour")).agg(total("fare_amount").alias("total_revenue"))
    before = F.lag("total_revenue").over(Window.orderBy("hour"))
    change = rnd(100 * ratio(F.col("total_revenue") - F.col("prev"), "prev"))
    return (
        hourly.withColumn("prev", before).withColumn("pct_change", change)
        .select(
            "hour", "total_revenue", "pct_change",
            F.coalesce(F.col("pct_change") < drop, F.lit(False)).alias("revenue_drop_flag"),
        )
    )


def group_outlier_flag(trips: DataFrame, key: str, value: str, width: float = 2) -> DataFrame:
    """Each row with whether it lies over its group's mean plus two deviations."""
    stats = trips.groupBy(key).agg(
        mean(value).alias("_m"), F.stddev_samp(value).alias("_s"), F.count("*").alias("_n")
    )
    high = F.col(value) > F.col("_m") + width * F.col("_s")
    return attach(trips, stats, [key]).withColumn("is_outlier", F.coalesce(high, F.lit(False))).drop("_m", "_s")


def vendor_vs_overall(trips: DataFrame) -> DataFrame:
    """Mean, deviation and count per vendor, and whether above the overall mean."""
    overall = trips.agg(mean("fare_amount")).scalar()
    stats = trips.groupBy("vendor_id").agg(
        rnd(mean("fare_amount")).alias("vendor_avg"), rnd(F.stddev_samp("fare_amount")).alias("vendor_std"),
        F.count("fare_amount").alias("trip_count"),
    )
    return stats.withColumn("above_overall_avg", F.col("vendor_avg") > overall)


def pct_of_group(df: DataFrame, key: str, value: str) -> DataFrame:
    """Each value as percent of the total of its group, four places."""
    sums = df.groupBy(key).agg(total(value).alias("_t"), F.count("*").alias("_n"))
    return attach(df, sums, [key]).withColumn("pct_of_group", rnd(100 * ratio(value, "_t"), 4)).drop("_t")


def average_rank(df: DataFrame, column: str, out: str) -> DataFrame:
    """Descending rank; tied rows share their mean rank, cut to an integer."""
    levels = order_buckets(df.groupBy(column).agg(F.count("*").alias("_n")), column)
    ranked = scan(levels, [], [column], {"_ahead": ("sum", F.col("_n"), False)}, reverse=True)
    shared = F.col("_ahead") + (F.col("_n") + 1) / F.lit(2.0)
    return attach(df, ranked.select(column, F.floor(shared).cast("int").alias(out), "_n"), [column])
