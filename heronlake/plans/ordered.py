"""Running values over an order, without putting one key in one task.

A plain ``Window.partitionBy(key).orderBy(pos)`` sends a whole key to a single
task, and a window without a key sends the whole table.  Here the order column
is cut into ranges of about equal row count.  The window runs inside
(key, range); the totals of each range are few and are summed over the ranges
before; a join on (key, range) adds what came earlier.  Every group then holds
about 1/n of the table, however large one key is.

Where there are keys, ranges follow a hash of the key first, so the totals are
about as many as keys and ranges together.  The cuts are found once and go into
the plan as constants, so a task that is
run again after a lost executor gets the same ranges.
"""

from __future__ import annotations

from collections import Counter

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from heronlake.functions.timeparts import as_number

BUCKET = "_bucket"


# Bytes of a text that fit into one double.
CHUNK = 6
LOWEST, HIGHEST = -1.7e308, 1.7e308


def _levels(df: DataFrame, order: list[str], keys: list[str]):
    """Numbers to cut by, in turn, and the text that goes on after each of them."""
    types = dict(df.dtypes)
    if keys:
        yield F.xxhash64(*keys).cast("double"), None
    for c in order:
        if types[c] == "string":
            start = 0
            while True:
                chunk = F.rpad(F.hex(F.substring(F.encode(c, "utf-8"), 1 + start, CHUNK)), 2 * CHUNK, "0")
                start += CHUNK
                # what is sent back tells whether rows that are still crowded go on
                goes_on = yield F.conv(chunk, 16, 10).cast("double"), F.octet_length(c) > start
                if not goes_on:
                    break
        else:
            yield as_number(c, types[c]), None


def order_buckets(
    df: DataFrame, order: str | list[str], keys: list[str] | None = None, buckets: int | None = None
) -> DataFrame:
    """Add ``_bucket``, a range number that grows along ``order`` within a key.

    Rows are cut into ranges of about equal count by a hash of ``keys``, if
    there are any, so a key with few rows lies in one range.  A value that
    fills whole ranges (a crowded key, a third of the rows at one time stamp)
    is cut further by the next column, and so on, column by column, so ranges
    never run against the order.  Such a value opens its range; the other
    values there come after all of its parts.  Nulls come first, as Spark
    sorts them.  Texts are cut by their bytes, six at a time.
    """
    order = [order] if isinstance(order, str) else list(order)
    n = buckets or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    out, open_rows, crowd = df.withColumn(BUCKET, F.lit(0).cast("long")), df, F.lit(True)
    levels = _levels(df, order, keys or [])
    level = next(levels)
    while level is not None:
        number, longer = level
        number = F.coalesce(F.nanvl(number, F.lit(HIGHEST)), F.lit(LOWEST))
        seen = Counter(open_rows.select(number.alias("x")).approxQuantile("x", [i / n for i in range(1, n)], 0.2 / n))
        if not seen:
            break
        splits = [float("-inf"), *sorted(seen), float("inf")]
        placed = Bucketizer(splits=splits, inputCol="_x", outputCol="_b", handleInvalid="keep").transform(out.withColumn("_x", number))
        step = F.when(crowd, F.col("_b").cast("long")).otherwise(len(splits))
        out = placed.withColumn(BUCKET, F.col(BUCKET) * (len(splits) + 1) + step).drop("_x", "_b")
        heavy = [v for v, times in seen.items() if times > 1]
        if not heavy:
            break
        crowd = crowd & number.isin(heavy)
        open_rows = df.where(crowd)
        try:
            level = levels.send(longer is not None and not open_rows.where(longer).isEmpty())
        except StopIteration:
            break
    return out


# Stand-ins for a null key, told apart by a separate mark.
_STAND_IN = {"string": "", "boolean": False, "date": "1970-01-01", "timestamp": "1970-01-01", "timestamp_ntz": "1970-01-01"}


def null_free_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Add key columns without nulls that tell groups apart as the keys do.

    Plain equality on them matches null keys too, and rows already placed by
    them for a window need no second shuffle for the join.
    """
    if not keys:
        return df, []
    types = dict(df.dtypes)
    plain = {f"_g{i}": F.coalesce(k, F.lit(_STAND_IN.get(types[k], 0)).cast(types[k])) for i, k in enumerate(keys)}
    marks = sum((F.when(F.col(k).isNull(), 1 << i).otherwise(0) for i, k in enumerate(keys)), F.lit(0))
    return df.withColumns({**plain, "_gz": marks}), [*plain, "_gz"]


_RUNNING = {"sum": F.sum, "min": F.min, "max": F.max, "product": F.product}


def scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    specs: dict[str, tuple],
    reverse: bool = False,
) -> DataFrame:
    """Add running values to a frame that went through :func:`order_buckets`.

    ``specs`` maps an output name to ``(kind, column, inclusive)`` with kind
    ``sum``, ``product``, ``min``, ``max`` or ``last`` (latest non-null value),
    or ``total`` for the sum over the whole key.  An
    exclusive value looks only at earlier rows; with ``reverse`` at later ones.
    """
    direction = (lambda c: F.col(c).desc()) if reverse else (lambda c: F.col(c).asc())
    keyed, groups = null_free_keys(df, keys)
    parts = [*groups, BUCKET]
    local = Window.partitionBy(*parts).orderBy(*[direction(c) for c in order])
    across = Window.partitionBy(*groups).orderBy(direction(BUCKET))
    across = across.rowsBetween(Window.unboundedPreceding, -1)
    stamp = F.struct(*order)
    columns, totals, carried, final = {}, [], [], {}
    for name, (kind, value, inclusive) in specs.items():
        frame = local.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        here, before = F.col(f"_l_{name}"), F.col(f"_c_{name}")
        if kind == "total":
            totals.append(F.sum(value).alias(f"_t_{name}"))
            carried.append(F.sum(f"_t_{name}").over(Window.partitionBy(*groups)).alias(f"_c_{name}"))
            final[name] = before
        elif kind == "last":
            columns[f"_l_{name}"] = F.last(value, ignorenulls=True).over(frame)
            pick = F.min_by if reverse else F.max_by
            totals.append(pick(value, F.when(value.isNotNull(), stamp)).alias(f"_t_{name}"))
            carried.append(F.last(f"_t_{name}", ignorenulls=True).over(across).alias(f"_c_{name}"))
            final[name] = F.coalesce(here, before)
        else:
            columns[f"_l_{name}"] = _RUNNING[kind](value).over(frame)
            totals.append(_RUNNING[kind](value).alias(f"_t_{name}"))
            carried.append(_RUNNING[kind](f"_t_{name}").over(across).alias(f"_c_{name}"))
            if kind == "sum":
                final[name] = F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0))
            elif kind == "product":
                final[name] = F.coalesce(here, F.lit(1.0)) * F.coalesce(before, F.lit(1.0))
            else:
                final[name] = (F.least if kind == "min" else F.greatest)(here, before)
    sums = keyed.groupBy(*parts).agg(*totals).select(*parts, *carried)
    joined = keyed.withColumns(columns).join(sums, parts)
    return joined.select(*df.columns, *[c.alias(n) for n, c in final.items()])


def row_numbers(df: DataFrame, keys: list[str], order: list[str], out: str = "rn") -> DataFrame:
    """Row number per key over an order, for a frame with ``_bucket``."""
    return scan(df, keys, order, {out: ("sum", F.lit(1).cast("long"), True)})


def with_halo(df: DataFrame, keys: list[str], rn: str, width: int, block: int = 200_000):
    """Cut numbered rows into blocks that repeat the last ``width`` rows before.

    Returns the frame with ``_block`` and ``_own``; a frame of up to
    ``width`` preceding rows inside (key, block) is then exact on own rows.
    """
    block = max(block, 4 * width)
    slot = F.floor((F.col(rn) - 1) / F.lit(block)).cast("long")
    late = (F.col(rn) - 1) % block >= block - width
    copies = F.when(late, F.array(slot, slot + 1)).otherwise(F.array(slot))
    spread = df.withColumn("_home", slot).withColumn("_block", F.explode(copies))
    return spread.withColumn("_own", F.col("_home") == F.col("_block")).drop("_home")


def quantiles(
    df: DataFrame, value: str, probs: dict[str, float], keys: list[str] | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per key.

    Counts each distinct value first, then finds the two values at each rank
    from running counts, so no histogram of a whole column sits in one task.
    """
    keys = keys or []
    rows = df.where(F.col(value).isNotNull()).select(*keys, value)
    counts = order_buckets(rows, value, keys).groupBy(*keys, value, BUCKET).agg(F.count("*").alias("_n"))
    size = F.col("_n")
    ranked = scan(counts, keys, [value], {"_cum": ("sum", size, True), "_all": ("total", size, True)})
    picks = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("_all") - 1)
        low, high = F.floor(at), F.ceil(at)
        picks += [
            F.min(F.when(F.col("_cum") > low, F.col(value))).alias(f"_lo_{name}"),
            F.min(F.when(F.col("_cum") > high, F.col(value))).alias(f"_hi_{name}"),
            F.max(at - low).alias(f"_f_{name}"),
        ]
    found = ranked.groupBy(*keys).agg(*picks)
    return found.select(
        *keys,
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}"))
            .cast("double")
            .alias(n)
            for n in probs
        ],
    )


def interval_runs(
    df: DataFrame, keys: list[str], start: str, end: str, extra: dict[str, tuple] | None = None
) -> DataFrame:
    """Merge intervals that overlap or touch, one row per key and run.

    Intervals with one start are merged first, so the order is unique and a
    crowd on one start is one row.  ``extra`` maps a name to an aggregate of
    the input and the function that combines it over a run.
    """
    extra = extra or {}
    starts = df.groupBy(*keys, start).agg(
        F.max(end).alias(end), *[first.alias(n) for n, (first, _) in extra.items()]
    )
    ranged = order_buckets(starts, start, keys)
    reach = scan(ranged, keys, [start], {"_reach": ("max", F.col(end), False)})
    fresh = F.when(F.col("_reach").isNull() | (F.col(start) > F.col("_reach")), 1).otherwise(0)
    runs = scan(reach, keys, [start], {"run": ("sum", fresh.cast("long"), True)})
    return runs.groupBy(*keys, "run").agg(
        F.min(start).alias(start), F.max(end).alias(end),
        *[combine(n).alias(n) for n, (_, combine) in extra.items()],
    )


def consecutive_runs(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Runs of consecutive integers per key: start, end and length.

    The column must be unique within a key; the value minus its row number is
    constant along a run.
    """
    numbered = row_numbers(order_buckets(df, column, keys), keys, [column], "_rn")
    island = (F.col(column) - F.col("_rn")).alias("_island")
    return numbered.groupBy(*keys, island).agg(
        F.min(column).alias("start_id"), F.max(column).alias("end_id"), F.count("*").alias("length")
    ).drop("_island")
