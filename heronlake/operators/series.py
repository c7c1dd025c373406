"""Ordered series per key: prefix values, windows of rows, frequencies.

A series is a frame with key columns, unique order columns and a value.  All
running values go through ordered ranges, so a series that is a third of the
table is worked on by many tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from heronlake.functions.exact import dec, flag, rnd
from heronlake.plans.ordered import BUCKET, null_free_keys, order_buckets, row_numbers, scan, with_halo
from heronlake.plans.shared import cut_lineage


def max_single_profit(df: DataFrame, keys: list[str], order: list[str], price: str) -> DataFrame:
    """Best gain from one buy and one later sale, at least 0."""
    low = scan(order_buckets(df, order, keys), keys, order, {"_low": ("min", F.col(price), True)})
    return low.groupBy(*keys).agg(rnd(F.max(F.col(price) - F.col("_low"))).alias("profit"))


def max_multi_profit(df: DataFrame, keys: list[str], order: list[str], price: str) -> DataFrame:
    """Sum of all rises from one row to the next."""
    prev = scan(order_buckets(df, order, keys), keys, order, {"_prev": ("last", dec(price), False)})
    rise = F.greatest(dec(price) - F.coalesce("_prev", dec(price)), F.lit(0).cast("decimal(18,6)"))
    return prev.groupBy(*keys).agg(F.sum(rise).cast("double").alias("profit"))


def max_run_sum(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Largest sum of a run of neighbouring rows; the run is never empty."""
    sums = scan(order_buckets(df, order, keys), keys, order, {"_p": ("sum", dec(value), True)})
    lows = scan(sums, keys, order, {"_low": ("min", F.col("_p"), False)})
    start = F.least(F.coalesce("_low", F.lit(0)), F.lit(0))
    return lows.groupBy(*keys).agg(F.max(F.col("_p") - start).cast("double").alias("best"))


def product_except_self(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Product of all other rows of the group, without division."""
    number = F.col(value).cast("double")
    left = scan(order_buckets(df, order, keys), keys, order, {"_left": ("product", number, False)})
    both = scan(left, keys, order, {"_right": ("product", number, False)}, reverse=True)
    return both.withColumn("product", F.col("_left") * F.col("_right")).drop("_left", "_right", BUCKET)


def sliding_max(df: DataFrame, keys: list[str], order: list[str], value: str, k: int) -> DataFrame:
    """Largest value of every full window of k rows, at its last row."""
    numbered = row_numbers(order_buckets(df, order, keys), keys, order).drop(BUCKET)
    blocks = with_halo(numbered, keys, "rn", k - 1)
    w = Window.partitionBy(*keys, "_block").orderBy("rn").rowsBetween(1 - k, 0)
    out = blocks.withColumn("window_max", F.max(value).over(w))
    return out.where(F.col("_own") & (F.col("rn") >= k)).drop("rn", "_block", "_own")


def count_runs_with_sum(df: DataFrame, keys: list[str], order: list[str], value: str, total: int) -> DataFrame:
    """How many runs of neighbouring rows add up to the total.

    A run ends where the running sum is the total above an earlier one.  Sums
    seen so far are counted along the order, per sum, so no pair of rows is
    built.
    """
    marks = _marks(df, keys, order, value, total)
    seen = scan(
        order_buckets(marks, ["_pos", "_start"], [*keys, "_at"]), [*keys, "_at"], ["_pos", "_start"],
        {"_seen": ("sum", F.col("_start").cast("long"), True)},
    )
    counts = F.sum(F.when(F.col("_start") == 0, F.col("_seen")).otherwise(0))
    return seen.groupBy(*keys).agg(counts.alias("runs"))


def _marks(df: DataFrame, keys: list[str], order: list[str], value: str, total: int) -> DataFrame:
    """Running sums as possible starts, and the sums a run that ends here needs.

    Columns: position, sum (``_at``) and whether the mark is a start.  Position
    0 is the start before the first row.
    """
    sums = scan(
        order_buckets(df, order, keys), keys, order,
        {"_p": ("sum", F.col(value), True), "_pos": ("sum", F.lit(1).cast("long"), True)},
    )
    mark = lambda pos, at, start: F.struct(
        pos.cast("long").alias("_pos"), at.cast("long").alias("_at"), F.lit(start).alias("_start")
    )
    p, pos, zero = F.col("_p"), F.col("_pos"), F.lit(0)
    here = [mark(pos, p, 1), mark(pos, p - total, 0)]
    both = F.when(pos == 1, F.array(mark(zero, zero, 1), *here)).otherwise(F.array(*here))
    return cut_lineage(sums.select(*keys, F.explode(both).alias("_m")).select(*keys, "_m.*"))


def shortest_run_at_least(df: DataFrame, keys: list[str], order: list[str], value: str, target: int) -> DataFrame:
    """Rows in the shortest run with at least the target sum, 0 if none; values are positive.

    For every row the latest start whose sum before it is low enough is found
    by sorting sums and targets together.
    """
    marks = order_buckets(_marks(df, keys, order, value, target).withColumn("_ask", 1 - F.col("_start")), ["_at", "_ask", "_pos"], keys)
    start = F.when(F.col("_start") == 1, F.col("_pos"))
    found = scan(marks, keys, ["_at", "_ask", "_pos"], {"_from": ("last", start, True)})
    length = F.when(F.col("_ask") == 1, F.col("_pos") - F.col("_from"))
    return found.groupBy(*keys).agg(F.coalesce(F.min(length), F.lit(0).cast("long")).alias("length"))


def next_greater_gap(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows until a larger value comes, 0 when none does; a null is never larger and gets 0.

    Answers inside one (key, range) come from numpy: every row points to the
    next one and jumps along that row's own pointer while it finds nothing
    larger, for all rows at once, which no built-in expresses.  A row without
    an answer looks for the first later range with a larger maximum, and there
    for the first larger value among the range's new highs.
    """
    keyed, groups = null_free_keys(df, keys)
    sized = row_numbers(order_buckets(keyed, order, groups), groups, order)
    number = F.nanvl(F.col(value).cast("double"), F.lit(float("inf")))
    numbered = sized.select(*groups, *keys, "rn", BUCKET, number.alias("_v"))
    rows = numbered.where("_v is not null").select(*groups, BUCKET, "rn", "_v")
    schema = f"{_ddl(rows, rows.columns)}, _next long, _record boolean"

    def inside(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("rn")
        v, places = part["_v"].to_numpy(), part["rn"].to_numpy()
        ahead, open_ = np.arange(1, len(v) + 1), np.arange(len(v))
        while len(open_):
            open_ = open_[ahead[open_] < len(v)]
            to = ahead[open_]
            low = v[to] <= v[open_]
            open_ = open_[low]
            ahead[open_] = ahead[to[low]]
        found = pd.array(np.append(places, -1)[ahead], dtype="Int64")
        found[ahead == len(v)] = pd.NA
        before = np.append(-np.inf, np.maximum.accumulate(v)[:-1])
        record = v > before
        record[:1] = True
        return part.assign(_next=found, _record=record)

    local = cut_lineage(rows.groupBy(*groups, BUCKET).applyInPandas(inside, schema))
    open_rows = local.where("_next is null").select(*groups, "rn", BUCKET, "_v")
    asked = _first_higher_range(local.groupBy(*groups, BUCKET).agg(F.max("_v").alias("m")), open_rows, groups)
    asked = asked.withColumnRenamed(BUCKET, "_from")
    routes = asked.select(*groups, "_from", "_to").distinct()
    highs = local.where("_record").select(*groups, F.col(BUCKET).alias("_to"), "rn", "_v").join(routes, [*groups, "_to"])
    marks = asked.select(*groups, "_from", "_to", "rn", "_v", F.lit(0).alias("_high")).unionByName(
        highs.select(*groups, "_from", "_to", "rn", "_v", F.lit(1).alias("_high"))
    )
    w = Window.partitionBy(*groups, "_from", "_to").orderBy(F.desc("_v"), "_high")
    found = marks.withColumn("_next", F.last(F.when(F.col("_high") == 1, F.col("rn")), ignorenulls=True).over(w))
    answers = local.where("_next is not null").select(*groups, "rn", "_next").unionByName(
        found.where("_high = 0").select(*groups, "rn", "_next")
    )
    hops = numbered.join(answers, [*groups, "rn"], "left")
    return hops.select(*keys, "rn", F.coalesce(F.col("_next") - F.col("rn"), F.lit(0).cast("long")).alias("gap"))


def _first_higher_range(tops: DataFrame, rows: DataFrame, groups: list[str]) -> DataFrame:
    """Adds ``_to``, the first later range of the key whose maximum ``m`` is above ``_v``; rows without one are left out.

    Every range knows the maxima of the 1, 2, 4.. ranges from it on.  From the
    largest stretch down, a row skips each stretch that has nothing above
    it.  Only keys that lie in several ranges have rows in the table; a cut
    between ranges lies in one key, so there are at most twice as many as ranges, and it is broadcast.
    """
    line, whole = Window.partitionBy(*groups).orderBy(BUCKET), Window.partitionBy(*groups)
    placed = tops.withColumns({"_at": F.row_number().over(line), "_n": F.count("*").over(whole)}).where("_n > 1")
    placed = cut_lineage(placed)
    levels = int(placed.agg(F.max("_n")).first()[0] or 1).bit_length()
    highs = [F.max("m").over(line.rowsBetween(0, (1 << k) - 1)) for k in range(levels)]
    table = cut_lineage(placed.select(*groups, "_at", BUCKET, F.array(*highs).alias("_highs")))
    out = rows.join(F.broadcast(table.select(*groups, BUCKET, (F.col("_at") + 1).alias("_at"))), [*groups, BUCKET])
    for k in reversed(range(levels)):
        ahead = F.broadcast(table.select(*groups, "_at", F.get("_highs", F.lit(k)).alias("_high")))
        skip = F.when(F.col("_high") <= F.col("_v"), 1 << k).otherwise(0)
        out = out.join(ahead, [*groups, "_at"], "left").withColumn("_at", F.col("_at") + skip).drop("_high")
    ends = table.select(*groups, "_at", F.col(BUCKET).alias("_to"))
    return out.join(F.broadcast(ends), [*groups, "_at"]).drop("_at")


def ranks_along(known: np.ndarray, own: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """For every i the ``ranks[i]``-th smallest (from 1) of ``known`` and ``own[:i + 1]``.

    All rows descend a tree over the sorted values together, one bit of the
    place per step.  At each step the values of ``own`` are parted by that
    bit, keeping their order, and running counts say how many of a row's
    values went left.
    """
    values = np.sort(np.concatenate([known, own]))
    # equal values take places one after the other, those of known first
    order = np.argsort(np.concatenate([known, own]), kind="stable")
    place = np.empty(len(values), dtype=np.int64)
    place[order] = np.arange(len(values))
    bits = max(1, int(len(values)).bit_length())
    have = np.zeros((1 << bits) + 1, dtype=np.int64)
    have[place[:len(known)] + 1] = 1
    have = np.cumsum(have)
    line, left = place[len(known):], ranks.astype(np.int64).copy()
    first, last = np.zeros(len(own), dtype=np.int64), np.arange(1, len(own) + 1)
    node = np.zeros(len(own), dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        right = (line >> bit) & 1
        zeros = np.append(0, np.cumsum(1 - right))
        count = zeros[last] - zeros[first] + have[node + (1 << bit)] - have[node]
        up = left > count
        left -= np.where(up, count, 0)
        node += np.where(up, 1 << bit, 0)
        first = np.where(up, zeros[-1] + first - zeros[first], zeros[first])
        last = np.where(up, zeros[-1] + last - zeros[last], zeros[last])
        line = np.concatenate([line[right == 0], line[right == 1]])
    return values[node]


def running_median(
    df: DataFrame, keys: list[str], order: list[str], value: str, block: int = 50_000
) -> DataFrame:
    """Median of all values of the key up to each row; a null row carries the median along.

    Values that are not null are numbered and cut into blocks.  While one
    block is read, the median moves by at most one block of ranks, so a block
    needs only the earlier values around the middle and a count of those
    below.  Which earlier values these are follows from counts per (block,
    range of ranks).  A block has at least ``block`` rows and n^(2/3) of a
    series of n, so these counts are at most n^(2/3) as well.  A group in
    pandas holds a few blocks of rows, never a whole series; the k-th value of
    a growing set has no built-in.
    """
    keyed, groups = null_free_keys(df, keys)
    there = F.col(value).isNotNull().cast("long")
    numbered = scan(order_buckets(keyed, order, groups), groups, order, {"rn": ("sum", there, True), "_all": ("total", there, True)})
    numbered = numbered.drop(BUCKET)
    valid = numbered.where(F.col(value).isNotNull()).withColumn(
        "_size", F.greatest(F.lit(block), F.ceil(F.pow("_all", F.lit(2 / 3)))).cast("long")
    )
    ranked = row_numbers(order_buckets(valid, [value, "rn"], groups), groups, [value, "rn"], "_vr")
    part = lambda c: F.floor((F.col(c) - 1) / F.col("_size")).cast("long")
    rows = cut_lineage(ranked.select(
        *groups, "rn", F.col(value).cast("double").alias("_x"), part("rn").alias("_p"), part("_vr").alias("_v"), "_size"
    ))
    cells = rows.groupBy(*groups, "_p", "_v").agg(F.count("*").alias("_n"))
    size = rows.groupBy(*groups).agg(F.max("_p").alias("_last"), F.max("_size").alias("_size")).where("_last > 0")
    upto = F.explode(F.sequence(F.lit(0).cast("long"), "_last"))
    grid = size.withColumn("_v", upto).withColumn("_p", upto)
    filled = grid.join(cells, [*groups, "_p", "_v"], "left").fillna(0, ["_n"])
    earlier = Window.partitionBy(*groups, "_v").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    lower = Window.partitionBy(*groups, "_p").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    base = filled.withColumn("_g", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    base = base.withColumn("_below", F.coalesce(F.sum("_g").over(lower), F.lit(0)))
    have = F.col("_p") * F.col("_size")
    low, high = F.floor(have / 2) - F.col("_size"), F.floor((have + F.col("_size")) / 2) + 1
    needed = base.where((F.col("_p") > 0) & (F.col("_g") > 0) & (F.col("_below") <= high) & (F.col("_below") + F.col("_g") >= low))
    needed = needed.select(*groups, "_p", "_v", "_below")
    wanted = needed.select(
        *groups, "_v", F.col("_p").alias("_for"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_p") - 1)).alias("_p")
    )
    near = rows.join(wanted, [*groups, "_v", "_p"]).select(*groups, F.col("_for").alias("_p"), "_x", F.lit(0).alias("_own"))
    below = needed.groupBy(*groups, "_p").agg(F.min("_below").cast("double").alias("_x")).withColumn("_own", F.lit(2))
    blocks = rows.select(*groups, "_p", "_x", F.lit(1).alias("_own"), "rn", "_size").unionByName(
        near.unionByName(below.select(*groups, "_p", "_x", "_own")), allowMissingColumns=True
    )
    schema = _ddl(blocks, [*groups, "rn"]) + ", running_median double"

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        own = group[group["_own"] == 1].sort_values("rn")
        under = group.loc[group["_own"] == 2, "_x"]
        skipped = int(under.iloc[0]) if len(under) else 0
        known, values, seen = group.loc[group["_own"] == 0, "_x"].to_numpy(), own["_x"].to_numpy(), own["rn"].to_numpy()
        a = ranks_along(known, values, (seen - 1) // 2 + 1 - skipped)
        b = ranks_along(known, values, seen // 2 + 1 - skipped)
        return own[[*groups, "rn"]].assign(running_median=a + (b - a) / 2)

    medians = blocks.groupBy(*groups, "_p").applyInPandas(walk, schema)
    out = numbered.join(medians, [*groups, "rn"], "left")
    return out.select(*keys, *[o for o in order if o not in keys], "running_median")


def _ddl(df: DataFrame, columns: list[str]) -> str:
    types = dict(df.dtypes)
    return ", ".join(f"`{c}` {types[c]}" for c in columns)


def balance_start(stations: DataFrame) -> DataFrame:
    """First position from which the running balance never falls below zero, else -1."""
    net = (F.col("gas") - F.col("cost")).cast("long")
    run = scan(order_buckets(stations, "pos"), [], ["pos"], {"_p": ("sum", net, True)})
    low = F.min_by(F.struct("_p", "pos"), F.struct("_p", "pos"))
    summary = run.agg(F.sum(net).alias("total"), low.alias("low"))
    start = F.when(F.col("total") < 0, -1).when(F.col("low._p") < 0, F.col("low.pos") + 1).otherwise(0)
    return summary.select(start.cast("long").alias("start"))


def min_schedule_length(tasks: DataFrame, column: str, rest: int) -> DataFrame:
    """Slots needed when equal tasks must be ``rest`` slots apart."""
    counts = tasks.groupBy(column).agg(F.count("*").alias("n"))
    top = counts.agg(F.max("n")).scalar()
    one = counts.withColumn("top", top).agg(
        F.max("top").alias("top"), F.count_if(F.col("n") == F.col("top")).alias("ties"), F.sum("n").alias("rows")
    )
    return one.select(F.greatest((F.col("top") - 1) * (rest + 1) + F.col("ties"), "rows").alias("slots"))


def top_k_frequent(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values, the smaller one on a tie."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(k)


def majority_value(df: DataFrame, key: str, column: str) -> DataFrame:
    """The value that fills more than half of a group's rows, if there is one."""
    counts = df.groupBy(key, column).agg(F.count("*").alias("n"))
    best = counts.groupBy(key).agg(F.max_by(column, "n").alias(column), F.max("n").alias("m"), F.sum("n").alias("all"))
    return best.where("m * 2 > all").select(key, column)


def contains_duplicate(df: DataFrame, key: str, column: str) -> DataFrame:
    """Whether some value occurs twice in a group."""
    counts = df.groupBy(key, column).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg((F.max("n") > 1).alias("has_duplicate"))


def nearby_duplicate(df: DataFrame, keys: list[str], order: list[str], column: str, k: int) -> DataFrame:
    """Whether some value comes again within k positions."""
    numbered = row_numbers(order_buckets(df, order, keys), keys, order)
    prev = scan(numbered, [*keys, column], order, {"_prev": ("last", F.col("rn"), False)})
    near = flag(F.col("rn") - F.col("_prev") <= k)
    return prev.groupBy(*keys).agg((F.max(near) == 1).alias("has_nearby"))


def pairs_with_sum(df: DataFrame, key: str, column: str, total: int) -> DataFrame:
    """Value pairs of a group that add up to the total, with how many row pairs they stand for."""
    counts = df.groupBy(key, column).agg(F.count("*").alias("n"))
    low = counts.select(key, F.col(column).alias("a"), F.col("n").alias("na"), (F.lit(total) - F.col(column)).alias("b"))
    high = counts.select(key, F.col(column).alias("b"), F.col("n").alias("nb"))
    joined = low.where("a <= b").join(high, [key, "b"])
    same = F.expr("na * (na - 1) div 2")
    pairs = F.when(F.col("a") == F.col("b"), same).otherwise(F.col("na") * F.col("nb"))
    return joined.select(key, "a", "b", pairs.alias("pairs")).where("pairs > 0")


def triples_with_sum(df: DataFrame, key: str, column: str, total: int = 0) -> DataFrame:
    """Distinct value triples a <= b <= c of a group that add up to the total.

    The smallest of three is at most a third of the total and the middle one
    at most half of what is left, so only such pairs are built.  Second values
    are dealt over parts by a hash and first values repeated per part, so a
    group is paired in many tasks.
    """
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    counts = df.groupBy(key, column).agg(F.count("*").alias("n"))
    side = lambda x: counts.select(key, F.col(column).alias(x), F.col("n").alias(f"n{x}"))
    first = side("a").where(F.col("a") * 3 <= total).withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    second = side("b").withColumn("_part", F.pmod(F.xxhash64("b"), F.lit(parts)).cast("int"))
    ab = first.join(second, [key, "_part"]).where((F.col("a") <= F.col("b")) & (F.col("b") * 2 <= F.lit(total) - F.col("a")))
    ab = ab.withColumn("c", F.lit(total) - F.col("a") - F.col("b"))
    needed = "na >= 1 + int(a = b) + int(a = c) and nb >= 1 + int(b = c)"
    return ab.join(side("c"), [key, "c"]).where(needed).select(key, "a", "b", "c")
