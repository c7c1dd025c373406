"""Grouped and global aggregates.

All of them are partial + final hash aggregates: rows are added up before the
shuffle, so a hot group reaches its task as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from heronlake.functions.exact import dec, flag, mean, ratio, rnd, total
from heronlake.functions.timeparts import in_year, month_key, seconds_between
from heronlake.operators.scalar import bucket_case
from heronlake.plans.ordered import quantiles
from heronlake.plans.skew import keys_of


def monthly_transactions(txn: DataFrame) -> DataFrame:
    """Counts and sums per month and country, all and approved, in one pass."""
    ok = F.col("state") == "approved"
    return txn.groupBy(month_key("trans_date").alias("month"), "country").agg(
        F.count("*").alias("trans_count"),
        F.count_if(ok).alias("approved_count"),
        total("amount").alias("trans_total"),
        total(F.when(ok, F.col("amount")).otherwise(F.lit(0.0))).alias("approved_total"),
    )


def immediate_delivery_pct(delivery: DataFrame) -> DataFrame:
    """Percent of deliveries wanted on the day of the order."""
    same = flag(F.col("order_date") == F.col("pref_date"))
    return delivery.agg(rnd(100 * ratio(F.sum(same), F.count("*"))).alias("immediate_percentage"))


def first_order_immediate_pct(delivery: DataFrame) -> DataFrame:
    """The same percentage over each customer's first order date only."""
    same = flag(F.col("order_date") == F.col("pref_date"))
    dates = delivery.groupBy("customer_id", "order_date").agg(F.sum(same).alias("hits"), F.count("*").alias("n"))
    first = dates.groupBy("customer_id").agg(
        F.min_by("hits", "order_date").alias("hits"), F.min_by("n", "order_date").alias("n")
    )
    return first.agg(rnd(100 * ratio(F.sum("hits"), F.sum("n"))).alias("immediate_percentage"))


def capital_gain_loss(stocks: DataFrame) -> DataFrame:
    """Sales minus purchases per stock."""
    signed = F.when(F.col("operation") == "Sell", dec("price")).when(
        F.col("operation") == "Buy", -dec("price")
    )
    return stocks.groupBy("stock_name").agg(F.sum(signed).cast("double").alias("capital_gain_loss"))


def fruit_balance_days(sales: DataFrame) -> DataFrame:
    """Dates on which as many apples as oranges were sold."""
    signed = F.when(F.col("fruit") == "apples", F.col("sold_num")).when(
        F.col("fruit") == "oranges", -F.col("sold_num")
    )
    daily = sales.groupBy("sale_date").agg(F.sum(signed).alias("diff"))
    return daily.where("diff = 0").select("sale_date")


def dept_vs_company(salary: DataFrame) -> DataFrame:
    """Department mean against the company mean, month by month."""
    by_dept = salary.groupBy(month_key("pay_date").alias("pay_month"), "department_id").agg(
        F.sum(dec("amount")).alias("s"), F.count("amount").alias("n")
    )
    company = by_dept.groupBy("pay_month").agg(F.sum("s").alias("cs"), F.sum("n").alias("cn"))
    ours, all_of_it = rnd(ratio("s", "n"), 6), rnd(ratio("cs", "cn"), 6)
    verdict = F.when(ours > all_of_it, "higher").when(ours < all_of_it, "lower").otherwise("same")
    return by_dept.join(company, "pay_month").select(
        "pay_month", "department_id", verdict.alias("comparison")
    )


def customers_all_products(bought: DataFrame, products: DataFrame) -> DataFrame:
    """Customers who bought every product."""
    wanted = products.agg(F.count_distinct("product_key")).scalar()
    held = bought.groupBy("customer_id").agg(F.count_distinct("product_key").alias("n"))
    return held.where(F.col("n") == wanted).select("customer_id")


def calls_between_pairs(calls: DataFrame) -> DataFrame:
    """Calls and seconds between two people, whoever called."""
    return calls.groupBy(
        F.least("from_id", "to_id").alias("person1"), F.greatest("from_id", "to_id").alias("person2")
    ).agg(F.count("*").alias("call_count"), F.sum("duration").alias("total_duration"))


def followers_count(follows: DataFrame) -> DataFrame:
    return follows.groupBy("user_id").agg(F.count("follower_id").alias("followers_count"))


def unique_subjects(teaching: DataFrame) -> DataFrame:
    return teaching.groupBy("teacher_id").agg(F.count_distinct("subject_id").alias("cnt"))


def rich_customers(store: DataFrame, limit: float = 500) -> DataFrame:
    """Number of customers with some amount above the limit."""
    return store.where(F.col("amount") > limit).agg(F.count_distinct("customer_id").alias("rich_count"))


def biggest_single_number(numbers: DataFrame) -> DataFrame:
    """Largest value that occurs once; null when there is none."""
    once = numbers.groupBy("num").agg(F.count("*").alias("n")).where("n = 1")
    return once.agg(F.max("num").alias("num"))


def positive_revenue(invoices: DataFrame, year: int) -> DataFrame:
    """Customers whose revenue in one year is above zero."""
    yearly = invoices.where(in_year("billed_on", year)).groupBy("customer_id")
    return yearly.agg(F.sum(dec("revenue")).alias("s")).where("s > 0").select("customer_id")


def rich_balance(users: DataFrame, txn: DataFrame, limit: float = 10000) -> DataFrame:
    """Users whose transactions add up to more than the limit."""
    sums = txn.groupBy("account").agg(total("amount").alias("balance"))
    return users.join(sums.where(F.col("balance") > limit), "account").select("name", "balance")


def contest_percentage(register: DataFrame, users: DataFrame) -> DataFrame:
    """Percent of all users registered in each contest."""
    everyone = users.agg(F.count("*")).scalar()
    return register.groupBy("contest_id").agg(F.count_distinct("user_id").alias("n")).select(
        "contest_id", rnd(100 * ratio("n", everyone)).alias("percentage")
    )


def query_quality(searches: DataFrame) -> DataFrame:
    """Mean rating/position and percent of ratings under 3 per query name."""
    return searches.where("query_name is not null").groupBy("query_name").agg(
        rnd(F.avg(ratio("rating", "position"))).alias("quality"),
        rnd(100 * ratio(F.count_if(F.col("rating") < 3), F.count("*"))).alias("poor_query_percentage"),
    )


def reported_posts(actions: DataFrame, removals: DataFrame) -> DataFrame:
    """Mean over days of the percent of posts reported as spam and removed.

    As in the source statement the denominator counts all posts of the day and
    days without a removed report do not take part.
    """
    removed = actions.where("extra = 'spam'").join(keys_of(removals, "post_id"), "post_id", "left_semi")
    hits = removed.groupBy("action_date").agg(F.count_distinct("post_id").alias("hits"))
    posts = actions.groupBy("action_date").agg(F.count_distinct("post_id").alias("posts"))
    daily = hits.join(posts, "action_date").select((100 * ratio("hits", "posts")).alias("p"))
    return daily.agg(rnd(ratio(F.sum("p"), F.count("*"))).alias("average_daily_percent"))


def suspicious_accounts(txn: DataFrame, accounts: DataFrame) -> DataFrame:
    """Accounts with some month of credits above their limit."""
    credits = txn.where("type = 'Creditor'")
    monthly = credits.groupBy("account_id", month_key("day").alias("month")).agg(
        F.sum(dec("amount")).alias("s")
    )
    most = monthly.groupBy("account_id").agg(F.max("s").alias("s"))
    return most.join(accounts, "account_id").where("s > max_income").select("account_id")


def active_sessions(activity: DataFrame, until: str, days: int = 30) -> DataFrame:
    """Distinct sessions per day in the window that ends on a date."""
    last = F.lit(until).cast("date")
    when = F.col("activity_date")
    recent = activity.where((when > F.date_sub(last, days)) & (when <= last))
    return recent.groupBy(when.alias("day")).agg(F.count_distinct("session_id").alias("active_sessions"))


def products_by_date(activities: DataFrame) -> DataFrame:
    """Number of products sold per date and their names in order."""
    kinds = activities.select("sell_date", "product").distinct()
    names = F.array_join(F.array_sort(F.collect_list("product")), ",")
    return kinds.groupBy("sell_date").agg(F.count("product").alias("num_sold"), names.alias("products"))


def latest_login(logins: DataFrame, year: int) -> DataFrame:
    """Latest login of each user in one year."""
    inside = logins.where(in_year("time_stamp", year))
    return inside.groupBy("user_id").agg(F.max("time_stamp").alias("last_stamp"))


def confirmation_rate(signups: DataFrame, confirmations: DataFrame) -> DataFrame:
    """Share of confirmed requests per user, 0 without requests."""
    rates = confirmations.groupBy("user_id").agg(
        ratio(F.count_if(F.col("action") == "confirmed"), F.count("action")).alias("rate")
    )
    return signups.join(rates, "user_id", "left").select(
        "user_id", rnd(F.coalesce("rate", F.lit(0.0))).alias("confirmation_rate")
    )


def category_revenue_top10(items: DataFrame, products: DataFrame, names: DataFrame, k: int = 10) -> DataFrame:
    """Orders, revenue and mean price of the best-selling categories."""
    joined = items.join(products, "product_id").join(names, "category_name")
    sums = joined.groupBy("category").agg(
        F.count_distinct("order_id").alias("total_orders"),
        total("price").alias("total_revenue"),
        rnd(mean("price")).alias("avg_price"),
    )
    return sums.orderBy(F.desc("total_revenue"), "category").limit(k)


def delivery_days_by_state(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Mean days from purchase to delivery of delivered orders."""
    done = orders.where("order_status = 'delivered' and delivered_at is not null")
    days = seconds_between("purchased_at", "delivered_at") / 86400
    return done.join(customers, "customer_id").groupBy("customer_state").agg(
        rnd(mean(days), 1).alias("avg_delivery_days"), F.count("*").alias("total_orders")
    )


def review_distribution(
    reviews: DataFrame, orders: DataFrame, items: DataFrame, products: DataFrame,
    at_least: int = 100, k: int = 15,
) -> DataFrame:
    """Reviews per category with the share of bad ones, worst first.

    A review counts once per item of its order.  Both sides are counted per
    order before the join, so no review x item pairs are built.
    """
    score = F.col("review_score")
    per_order = reviews.groupBy("order_id").agg(
        F.count("*").alias("n"), F.sum(score).alias("s"),
        F.count_if(score >= 4).alias("hi"), F.count_if(score <= 2).alias("lo"),
    ).join(keys_of(orders, "order_id"), "order_id", "left_semi")
    baskets = items.groupBy("order_id", "product_id").agg(F.count("*").alias("m"))
    per_kind = baskets.join(products, "product_id").groupBy("order_id", "category").agg(F.sum("m").alias("m"))
    times = lambda c: F.sum(F.col(c) * F.col("m"))
    sums = per_order.join(per_kind, "order_id").groupBy("category").agg(
        times("n").alias("total_reviews"), times("s").alias("score"),
        times("hi").alias("positive"), times("lo").alias("negative"),
    )
    return (
        sums.where(F.col("total_reviews") > at_least)
        .select(
            "category", "total_reviews", rnd(ratio("score", "total_reviews")).alias("avg_score"),
            "positive", "negative",
            rnd(100 * ratio("negative", "total_reviews")).alias("negative_rate_pct"),
        )
        .orderBy(F.desc("negative_rate_pct"), "category").limit(k)
    )


def repeat_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers, those with more than one order, and their share."""
    per_id = orders.groupBy("customer_id").agg(F.count("*").alias("n"))
    per_person = per_id.join(customers, "customer_id").groupBy("customer_unique_id").agg(F.sum("n").alias("n"))
    again = F.count_if(F.col("n") > 1)
    return per_person.agg(
        F.count("*").alias("total_customers"), again.alias("repeat_customers"),
        rnd(100 * ratio(again, F.count("*"))).alias("repeat_rate_pct"),
    )


def late_delivery_by_state(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Delivered orders per state, late or on time."""
    done = orders.where("order_status = 'delivered' and delivered_at is not null")
    status = F.when(F.col("delivered_at") > F.col("estimated_at"), "Late").otherwise("On time")
    return done.join(customers, "customer_id").groupBy(
        "customer_state", status.alias("delivery_status")
    ).agg(F.count("*").alias("total_orders"))


def revenue_rollup(items: DataFrame, sellers: DataFrame) -> DataFrame:
    """Orders and revenue per state and city with subtotals and a grand total.

    An order may have sellers in several cities, so each level counts orders of
    its own.  Rows are placed by order once; there each (order, state, city) is
    marked if it is the first of its order in the state, and the first at all.
    Every level then adds up marks of the small table by city.  A state that
    is really null keeps its null and is no subtotal.
    """
    placed = items.join(sellers, "seller_id").repartition("order_id")
    sold = placed.groupBy("order_id", "seller_state", "seller_city").agg(F.sum(dec("price")).alias("p"))
    in_state = F.row_number().over(Window.partitionBy("order_id", "seller_state").orderBy("seller_city"))
    at_all = F.row_number().over(Window.partitionBy("order_id").orderBy("seller_state", "seller_city"))
    marked = sold.select("seller_state", "seller_city", "p", flag(in_state == 1).alias("s"), flag(at_all == 1).alias("a"))
    sums = [F.sum("s").alias("s"), F.sum("a").alias("a"), F.sum("p").alias("p")]
    by_city = marked.groupBy("seller_state", "seller_city").agg(F.count("*").alias("n"), *sums)
    by_state = by_city.groupBy("seller_state").agg(*sums)
    total_row = by_state.agg(F.coalesce(F.sum("a"), F.lit(0).cast("long")).alias("n"), F.sum("p").alias("p"))

    every_state, every_city = F.lit("ALL STATES"), F.lit("ALL CITIES")
    levels = (
        (by_city, F.col("seller_state"), F.col("seller_city")),
        (by_state.withColumnRenamed("s", "n"), F.col("seller_state"), every_city),
        (total_row, every_state, every_city),
    )
    rows = [
        df.select(state.alias("state"), city.alias("city"), F.col("n").alias("total_orders"), rnd("p").alias("revenue"))
        for df, state, city in levels
    ]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


def group_sum(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rounded sum per key; rows with a null key are left out."""
    return df.dropna(subset=keys).groupBy(*keys).agg(rnd(total(value)).alias(f"{value}_sum"))


def group_mean_multi(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rounded mean per several keys; rows with a null key are left out."""
    return df.dropna(subset=keys).groupBy(*keys).agg(rnd(mean(value)).alias(f"{value}_mean"))


def group_sum_mean_count(df: DataFrame, key: str, value: str) -> DataFrame:
    """Sum, mean and count per key, in key order."""
    return df.groupBy(key).agg(
        total(value).alias("total_revenue"), rnd(mean(value), 6).alias("avg_fare"),
        F.count(value).alias("trip_count"),
    ).orderBy(key)


def lazy_revenue_per_mile(trips: DataFrame) -> DataFrame:
    """Two filters, a projection, a ratio and a group, richest group first."""
    return (
        trips.where(F.col("fare_amount") > 0).where(F.col("trip_distance") > 0)
        .select("fare_amount", "trip_distance", "payment_type")
        .withColumn("per_mile", F.col("fare_amount") / F.col("trip_distance"))
        .groupBy("payment_type")
        .agg(
            total("fare_amount").alias("total_revenue"),
            rnd(F.avg("per_mile"), 6).alias("avg_revenue_per_mile"), F.count("fare_amount").alias("trips"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def describe_column(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, quartiles and range of a column."""
    c = F.col(column)
    basic = df.agg(
        F.count(c).alias("count"), rnd(mean(c), 4).alias("mean"), rnd(F.stddev_samp(c), 4).alias("std"),
        F.min(c).alias("min"), F.max(c).alias("max"),
    )
    q = quantiles(df, column, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    found = q.select(F.struct("q25", "q50", "q75")).scalar()
    return basic.withColumn("_q", found).select(
        "count", "mean", "std", "min", "max",
        *[rnd(F.col(f"_q.{p}"), 4).alias(p) for p in ("q25", "q50", "q75")],
    )


def sign_counts(df: DataFrame, column: str, limit: float) -> DataFrame:
    """How many values are negative, zero and above a limit."""
    c = F.col(column)
    return df.agg(
        F.count_if(c < 0).alias("negative"), F.count_if(c == 0).alias("zero"),
        F.count_if(c > limit).alias("over_limit"),
    )


def distance_stats(trips: DataFrame, far: float = 50) -> DataFrame:
    """Mean, median, maximum, zero trips and far trips."""
    d = F.col("trip_distance")
    median = quantiles(trips, "trip_distance", {"m": 0.5}).select("m").scalar()
    return trips.agg(
        rnd(mean(d)).alias("avg_distance"), F.max(d).alias("max_distance"),
        F.count_if(d == 0).alias("zero_distance"), F.count_if(d > far).alias("far_trips"),
    ).withColumn("median_distance", rnd(median))


def value_share(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value and their percent of all rows."""
    everything = df.agg(F.count("*")).scalar()
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", rnd(100 * ratio("n", everything), 1))


def value_counts_top(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values; ties go to the smaller value."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(k)


def tip_stats_by_payment(trips: DataFrame, codes: list) -> DataFrame:
    """Mean tip, median tip and tips of zero for chosen payment types."""
    chosen = trips.where(F.col("payment_type").isin(codes))
    basic = chosen.groupBy("payment_type").agg(
        rnd(mean("tip_amount")).alias("avg_tip"), F.count_if(F.col("tip_amount") == 0).alias("zero_tips")
    )
    medians = quantiles(chosen, "tip_amount", {"m": 0.5}, ["payment_type"])
    return basic.join(medians, "payment_type", "left").select(
        "payment_type", "avg_tip", rnd("m").alias("median_tip"), "zero_tips"
    )


def bucket_summary(trips: DataFrame) -> DataFrame:
    """Trips, revenue and mean fare per fare bucket."""
    return trips.groupBy(bucket_case("fare_amount").alias("fare_bucket")).agg(
        F.count("fare_amount").alias("trips"), rnd(total("fare_amount")).alias("revenue"),
        rnd(mean("fare_amount")).alias("avg_fare"),
    )


def weekday_cohort(trips: DataFrame) -> DataFrame:
    """Revenue, trips, mean tip, revenue rank and busiest hour per weekday."""
    from heronlake.operators.windows import average_rank

    hourly = trips.groupBy(
        F.date_format("pickup_ts", "EEEE").alias("day_of_week"), F.hour("pickup_ts").alias("hour")
    ).agg(
        F.sum(dec("fare_amount")).alias("rev"), F.count("fare_amount").alias("trips"),
        F.sum(dec("tip_amount")).alias("tips"), F.count("tip_amount").alias("tipped"),
    )
    busiest = F.max_by("hour", F.struct("trips", -F.col("hour")))
    daily = hourly.groupBy("day_of_week").agg(
        F.sum("rev").cast("double").alias("total_revenue"), F.sum("trips").alias("total_trips"),
        rnd(ratio(F.sum("tips"), F.sum("tipped"))).alias("avg_tip"), busiest.alias("busiest_hour"),
        F.max("trips").alias("trips"),
    )
    return average_rank(daily, "total_revenue", "revenue_rank")


def month_over_month(orders: DataFrame, items: DataFrame, status: str = "delivered") -> DataFrame:
    """Monthly revenue, the month before and the growth in percent.

    Items are added up per order first; then both sides of the join are
    partitioned by order and only monthly totals reach the window.
    """
    from pyspark.sql import Window

    per_order = items.groupBy("order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("revenue")
    )
    sold = orders.where(F.col("order_status") == status).join(per_order, "order_id")
    monthly = sold.groupBy(F.trunc(F.to_date("purchased_at"), "month").alias("month")).agg(
        F.sum("revenue").alias("revenue")
    )
    before = F.lag("revenue").over(Window.orderBy("month"))
    return monthly.withColumn("prev", before).select(
        "month", rnd("revenue").alias("revenue"), rnd("prev").alias("prev_month"),
        rnd(100 * ratio(F.col("revenue") - F.col("prev"), "prev")).alias("mom_growth_pct"),
    )


def payment_share(payments: DataFrame) -> DataFrame:
    """Value, mean instalments and share of the grand total per payment type."""
    from pyspark.sql import Window

    sums = payments.groupBy("payment_type").agg(
        F.sum(dec("payment_value")).alias("s"), rnd(mean("installments"), 1).alias("avg_installments")
    )
    share = 100 * ratio("s", F.sum("s").over(Window.partitionBy()))
    return sums.select(
        "payment_type", rnd("s").alias("total_value"), "avg_installments",
        rnd(share).alias("revenue_share_pct"),
    )
