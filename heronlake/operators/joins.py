"""Joins: outer, semi, anti, as-of, range, self and spine joins.

Facts are added up by their join key before the join wherever the result
allows it, so a key that holds much of the table arrives as one row.
No side is broadcast by hint; Spark decides from its size limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from heronlake.functions.exact import dec, flag, mean, ratio, rnd, total
from heronlake.functions.timeparts import in_year, seconds_between
from heronlake.plans.ordered import interval_runs
from heronlake.plans.skew import attach, keep_matching, keys_of


def person_address(person: DataFrame, address: DataFrame) -> DataFrame:
    """Every person with the address, null when there is none."""
    return _left_rows(person, address, "person_id")


def _left_rows(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left outer join whose right side may hold one key very often.

    Spark splits a crowded key of the right side in an inner join only, so
    rows with and without a match are found apart.
    """
    matched = left.join(right, key)
    alone = left.join(keys_of(right, key), key, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def managers_min_reports(emp: DataFrame, k: int = 5) -> DataFrame:
    """Managers with at least k direct reports."""
    enough = emp.groupBy(F.col("manager_id").alias("id")).agg(F.count("*").alias("n"))
    return emp.join(enough.where(F.col("n") >= k), "id", "left_semi").select("id", "name")


def reports_per_manager(emp: DataFrame) -> DataFrame:
    """Number of reports and their rounded mean age; managers only."""
    reports = emp.groupBy(F.col("manager_id").alias("id")).agg(
        F.count("*").alias("reports_count"), rnd(mean("age"), 0).alias("average_age")
    )
    return emp.select("id", "name").join(reports, "id")


def dept_highest_salary(emp: DataFrame, dept: DataFrame) -> DataFrame:
    """Everyone who earns the department maximum."""
    levels = emp.groupBy("dept_id", "salary").agg(F.count("*").alias("_n"))
    best = levels.groupBy("dept_id").agg(F.max("salary").alias("salary"), F.max_by("_n", "salary").alias("_n"))
    top = keep_matching(emp, best, ["dept_id", "salary"]).join(dept, "dept_id")
    return top.select("department", "employee", "salary")


def product_sales(sales: DataFrame, product: DataFrame) -> DataFrame:
    """Product name, year and price of every sale."""
    return sales.join(product, "product_id").select("product_name", "year", "price")


def warehouse_volume(stock: DataFrame, product: DataFrame) -> DataFrame:
    """Total volume held by each warehouse."""
    units = stock.groupBy("warehouse", "product_id").agg(F.sum("units").alias("units"))
    volume = F.sum(F.col("width") * F.col("length") * F.col("height") * F.col("units"))
    return units.join(product, "product_id").groupBy("warehouse").agg(volume.alias("volume"))


def employee_bonus(emp: DataFrame, bonus: DataFrame, limit: float = 1000) -> DataFrame:
    """Employees with a bonus under the limit, or with none."""
    joined = _left_rows(emp, bonus, "emp_id")
    return joined.where((F.col("bonus") < limit) | F.col("bonus").isNull()).select("emp_id", "bonus")


def cancellation_rate(trips: DataFrame, users: DataFrame, start: str, end: str) -> DataFrame:
    """Share of cancelled trips per day between unbanned clients and drivers."""
    allowed = users.where("banned = 'No'").select("user_id")
    clients = allowed.withColumnRenamed("user_id", "client_id")
    drivers = allowed.withColumnRenamed("user_id", "driver_id")
    kept = (
        trips.where(F.col("request_at").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        .join(clients, "client_id", "left_semi").join(drivers, "driver_id", "left_semi")
    )
    cancelled = F.sum(flag(F.startswith("status", F.lit("cancelled"))))
    return kept.groupBy(F.col("request_at").alias("day")).agg(
        rnd(ratio(cancelled, F.count("*"))).alias("cancellation_rate")
    )


def market_analysis(users: DataFrame, orders: DataFrame, year: int) -> DataFrame:
    """Every user with the number of orders in one year, 0 for none."""
    made = orders.where(in_year("order_date", year)).groupBy("user_id").agg(F.count("*").alias("n"))
    return users.join(made, "user_id", "left").select(
        "user_id", "join_date", F.coalesce("n", F.lit(0)).alias("orders_in_year")
    )


def top_travellers(users: DataFrame, rides: DataFrame) -> DataFrame:
    """Total distance of every user, 0 for none, longest first."""
    ridden = rides.groupBy("user_id").agg(total("distance").alias("travelled"))
    return (
        users.join(ridden, "user_id", "left")
        .select("name", F.coalesce("travelled", F.lit(0.0)).alias("travelled_distance"))
        .orderBy(F.desc("travelled_distance"), "name")
    )


def second_item_brand(users: DataFrame, sales: DataFrame, items: DataFrame) -> DataFrame:
    """Whether the second item each seller sold is of the favourite brand."""
    from pyspark.sql import Window

    order = Window.partitionBy("seller_id").orderBy("order_date", "item_id")
    second = sales.withColumn("rn", F.row_number().over(order)).where("rn = 2")
    branded = second.join(items, "item_id", "left").select("seller_id", "item_brand")
    same = F.col("item_brand") == F.col("favorite_brand")
    return users.join(branded, "seller_id", "left").select(
        "seller_id", F.when(same, "yes").otherwise("no").alias("second_item_fav_brand")
    )


def visits_without_txn(visits: DataFrame, txn: DataFrame) -> DataFrame:
    """Visits without a transaction, counted per customer."""
    quiet = visits.join(keys_of(txn, "visit_id"), "visit_id", "left_anti")
    return quiet.groupBy("customer_id").agg(F.count("*").alias("count_no_trans"))


def sellers_no_sales(sellers: DataFrame, orders: DataFrame, year: int) -> DataFrame:
    """Sellers without an order in one year."""
    active = orders.where(in_year("sale_date", year))
    return sellers.join(keys_of(active, "seller_id"), "seller_id", "left_anti").select("seller_name")


def orders_no_payment(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders that no payment row refers to."""
    return orders.join(keys_of(payments, "order_id"), "order_id", "left_anti")


def quiet_students(students: DataFrame, exams: DataFrame) -> DataFrame:
    """Students who took an exam and never held its highest or lowest score."""
    extremes = exams.groupBy("exam_id").agg(
        F.max("score").alias("hi"), F.min("score").alias("lo"), F.count("*").alias("_n")
    )
    noisy = attach(exams, extremes, ["exam_id"]).where("score = hi or score = lo")
    return students.join(keys_of(exams, "student_id"), "student_id", "left_semi").join(
        keys_of(noisy, "student_id"), "student_id", "left_anti"
    )


def only_in_window(sales: DataFrame, products: DataFrame, start: str, end: str) -> DataFrame:
    """Products sold, and sold only, inside the date window."""
    inside = F.col("sale_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    days = sales.groupBy("product_id").agg(F.min(inside).alias("only"))
    return products.join(days.where("only"), "product_id", "left_semi")


def investments_in(policies: DataFrame) -> DataFrame:
    """Later value of policies whose earlier value is shared and whose place is not."""
    shared = policies.groupBy("tiv_2015").agg(F.count("*").alias("_n")).where("_n > 1")
    alone = policies.groupBy("lat", "lon").agg(
        F.count("*").alias("n"), F.first("tiv_2015").alias("tiv_2015"), F.first("tiv_2016").alias("tiv_2016")
    ).where("n = 1")
    kept = keep_matching(alone, shared.where("tiv_2015 is not null"), ["tiv_2015"])
    return kept.agg(rnd(total("tiv_2016")).alias("tiv_2016"))


def price_at_date(changes: DataFrame, on: str, default: float = 10.0) -> DataFrame:
    """Latest price on or before a date per product, else the default."""
    known = F.when(F.col("change_date") <= F.lit(on).cast("date"), F.col("change_date"))
    return changes.groupBy("product_id").agg(
        F.coalesce(F.max_by("new_price", known), F.lit(default)).alias("price")
    )


def rising_temperature(weather: DataFrame) -> DataFrame:
    """Days warmer than the calendar day before; a gap never matches."""
    before = weather.select(
        F.date_add("record_date", 1).alias("record_date"), F.col("temperature").alias("before")
    )
    return weather.join(before, "record_date").where("temperature > before").select("record_date")


def adjacent_free_seats(seats: DataFrame) -> DataFrame:
    """Free seats next to another free seat, by equality on seat +- 1."""
    free = seats.where("free")
    beside = free.select(F.explode(F.array(F.col("seat_id") - 1, F.col("seat_id") + 1)).alias("seat_id"))
    return free.join(beside, "seat_id", "left_semi").select("seat_id").distinct()


def consecutive_numbers(logs: DataFrame) -> DataFrame:
    """Values that stand on three consecutive ids."""
    shifted = [logs.select((F.col("id") - i).alias("id"), "num") for i in (1, 2)]
    rows = logs.join(shifted[0], ["id", "num"], "left_semi").join(shifted[1], ["id", "num"], "left_semi")
    return rows.select("num").distinct()


def average_selling_price(prices: DataFrame, units: DataFrame) -> DataFrame:
    """Units-weighted mean price per product over its price periods, 0 if unsold."""
    daily = units.groupBy("product_id", "purchase_date").agg(F.sum("units").alias("units"))
    inside = F.col("purchase_date").between(F.col("start_date"), F.col("end_date"))
    on = (F.col("p.product_id") == F.col("u.product_id")) & inside
    joined = prices.alias("p").join(daily.alias("u"), on, "left")
    spent = F.sum(dec("price") * F.col("units"))
    return joined.groupBy("p.product_id").agg(
        rnd(F.coalesce(ratio(spent, F.sum("units")), F.lit(0.0))).alias("average_price")
    )


def overlapping_sessions(sessions: DataFrame) -> DataFrame:
    """Accounts with overlapping sessions from different addresses.

    Sessions that overlap in a chain form one run.  A run with two addresses
    always has two neighbours in the chain that differ, so no pair is built.
    """
    address = F.col("ip_address")
    extra = {"a": (F.min(address), F.min), "b": (F.max(address), F.max)}
    mixed = interval_runs(sessions, ["account_id"], "login", "logout", extra)
    return mixed.where("a <> b").select("account_id").distinct()


def process_time(activity: DataFrame) -> DataFrame:
    """Mean seconds from start to end over the processes of a machine."""
    at = lambda kind: F.max(F.when(F.col("activity_type") == kind, F.col("timestamp")))
    spans = activity.groupBy("machine_id", "process_id").agg(
        seconds_between(at("start"), at("end")).alias("took")
    )
    return spans.where("took is not null").groupBy("machine_id").agg(
        rnd(mean("took"), 3).alias("processing_time")
    )


def students_examinations(students: DataFrame, subjects: list[str], exams: DataFrame) -> DataFrame:
    """Exams taken per student and subject, zeros included."""
    spine = students.withColumn("subject", F.explode(F.array(*[F.lit(s) for s in subjects])))
    taken = exams.groupBy("student_id", "subject").agg(F.count("*").alias("n"))
    return spine.join(taken, ["student_id", "subject"], "left").select(
        "student_id", "student_name", "subject", F.coalesce("n", F.lit(0)).alias("attended_exams")
    )
