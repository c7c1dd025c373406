"""Row-wise operators: computed columns, filters, labels, buckets, patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from heronlake.functions.exact import ratio, rnd

# Bucket edges and labels of fares and amounts.
BUCKET_EDGES = (10, 30, 100)
BUCKET_LABELS = ("low", "medium", "high", "premium")


def select_computed(trips: DataFrame) -> DataFrame:
    """Fare, revenue per mile (null at zero distance) and a three-way bucket."""
    fare = F.col("fare_amount")
    return trips.withColumns(
        {
            "fare": fare,
            "revenue_per_mile": rnd(ratio(fare, "trip_distance")),
            "fare_bucket": F.when(fare < 10, "low").when(fare < 30, "medium").otherwise("high"),
        }
    ).select("trip_id", "fare", "revenue_per_mile", "fare_bucket")


def filter_threshold(df: DataFrame, column: str, limit: float) -> DataFrame:
    """Rows whose value is above the limit."""
    return df.where(F.col(column) > limit)


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Lower-case names with underscores for spaces."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def bucket_case(
    column: str, cuts: tuple = BUCKET_EDGES, labels: tuple = BUCKET_LABELS
) -> Column:
    """Chained condition: the first cut the value lies below names the bucket."""
    value = F.col(column)
    out = F.when(value < cuts[0], labels[0])
    for cut, label in zip(cuts[1:], labels[1:]):
        out = out.when(value < cut, label)
    return out.otherwise(labels[len(cuts)])


def bucket_cut(
    column: str, bins: tuple = (0, *BUCKET_EDGES, float("inf")), labels: tuple = BUCKET_LABELS
) -> Column:
    """Left-closed bins; values outside every bin, and nulls, give null."""
    value, out = F.col(column), None
    for low, high, label in zip(bins, bins[1:], labels):
        inside = (value >= low) & (value < high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def triangle_judgement(sides: DataFrame) -> DataFrame:
    """Yes when x, y and z can be the sides of a triangle."""
    closes = F.expr("x + y > z and y + z > x and x + z > y")
    return sides.withColumn("triangle", F.when(closes, "Yes").otherwise("No"))


def special_bonus(employees: DataFrame, initial: str = "M") -> DataFrame:
    """Salary for odd ids whose name does not start with the initial, else 0."""
    earns = (F.col("employee_id") % 2 == 1) & ~F.startswith("name", F.lit(initial))
    return employees.select(
        "employee_id", F.when(earns, F.col("salary")).otherwise(F.lit(0.0)).alias("bonus")
    )


def exchange_seats(seats: DataFrame) -> DataFrame:
    """Swap neighbours 1-2, 3-4, ...; an odd last row keeps its seat."""
    seat = F.col("id")
    last = seats.agg(F.count("*")).scalar()
    moved = (
        F.when((seat % 2 == 1) & (seat + 1 <= last), seat + 1)
        .when(seat % 2 == 0, seat - 1)
        .otherwise(seat)
    )
    return seats.select(moved.alias("id"), "student")


def prefix_token_match(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Rows where some blank-separated token starts with the prefix."""
    return df.where(F.col(column).like(f"{prefix}%") | F.col(column).like(f"% {prefix}%"))


# Fixed value: shape of the part of a mail address before the domain.
MAIL_NAME = r"^[a-zA-Z][a-zA-Z0-9_.-]*@"


def valid_email_sql(users: DataFrame, domain: str) -> DataFrame:
    """Users whose mail starts with a letter and is at the one domain."""
    pattern = MAIL_NAME + domain.replace(".", r"\.") + "$"
    return users.where(F.rlike("mail", F.lit(pattern)))


def fix_names(users: DataFrame) -> DataFrame:
    """First character upper case, the rest lower case."""
    first, rest = F.substring("name", 1, 1), F.expr("substring(name, 2)")
    return users.withColumn("name", F.concat(F.upper(first), F.lower(rest)))


def label_map_lookup(column: str, labels: dict[int, str]) -> Column:
    """Label of a code, ``Type {code}`` for a code without one."""
    pairs = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    unknown = F.concat(F.lit("Type "), F.col(column).cast("string"))
    return F.coalesce(F.try_element_at(pairs, F.col(column)), unknown)


def null_safe_double(column: str) -> Column:
    """Twice the value; null stays null."""
    return F.col(column) * 2
