"""Brackets, stretches, covering windows, palindromes, word cuts and letter grids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from heronlake.plans.ordered import BUCKET, order_buckets, row_numbers, scan
from heronlake.plans.shared import Rounds, cut_lineage, scratch_path

# Opening and closing brackets.
OPEN, CLOSE = "([{<", ")]}>"


def bracket_report(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Per text the number of brackets, the deepest level and whether all are matched.

    A running sum over the brackets gives levels; an opening bracket and the
    one that closes it are neighbours within one level, so a closing bracket
    is matched if the bracket before it on its level opens the same kind.
    Texts are cut into ranges of brackets, so a long text is many tasks'
    work.  Null and empty texts have no brackets and are matched.
    """
    marks = F.array(*[F.lit(c) for c in OPEN + CLOSE])
    chars = F.filter(F.transform(F.split(F.col(text), ""), lambda c, i: F.struct(i.alias("pos"), c.alias("c"))), lambda x: F.array_contains(marks, x["c"]))
    rows = texts.select(F.col(key), F.explode(chars).alias("x")).select(key, "x.pos", "x.c")
    opens = F.instr(F.lit(OPEN), F.col("c")) > 0
    kind = F.instr(F.lit(OPEN + CLOSE), F.col("c")) % len(OPEN)
    rows = cut_lineage(rows.select(key, F.col("pos").cast("long").alias("pos"), opens.alias("opens"), kind.alias("kind")))
    step = F.when(F.col("opens"), 1).otherwise(-1).cast("long")
    deep = scan(order_buckets(rows, "pos", [key]), [key], ["pos"], {"depth": ("sum", step, True)}).drop(BUCKET)
    deep = deep.withColumn("level", F.when(F.col("opens"), F.col("depth")).otherwise(F.col("depth") + 1))
    # an opening bracket is told by its kind, a closing one by zero less its kind
    told = F.when(F.col("opens"), F.col("kind") + 1).otherwise(-(F.col("kind") + 1))
    paired = scan(order_buckets(deep.withColumn("told", told), "pos", [key, "level"]), [key, "level"], ["pos"], {"_before": ("last", F.col("told"), False)})
    lost = ~F.col("opens") & ((F.col("level") < 1) | F.coalesce(F.col("_before") != F.col("kind") + 1, F.lit(True)))
    found = paired.groupBy(key).agg(
        F.count("*").alias("brackets"), F.max("depth").alias("deepest"),
        ((F.count_if(lost) == 0) & (F.sum(step) == 0)).alias("is_balanced"),
    )
    none = F.lit(0).cast("long")
    every = texts.select(key).join(found.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key")), "left")
    return every.select(
        key, F.coalesce("brackets", none).alias("brackets"), F.greatest(F.coalesce("deepest", none), none).alias("deepest"),
        F.coalesce("is_balanced", F.lit(True)).alias("is_balanced"),
    )


def longest_distinct_run(df: DataFrame, keys: list[str], order: list[str], column: str) -> DataFrame:
    """Rows in the longest stretch of a series without a repeated value; nulls are one value.

    A stretch that ends at a row starts after the latest place at which any
    value up to it occurred before: a running maximum over the places of the row
    before with the same value.
    """
    numbered = cut_lineage(row_numbers(order_buckets(df, order, keys), keys, order).drop(BUCKET).select(*keys, "rn", column))
    again = scan(order_buckets(numbered, "rn", [*keys, column]), [*keys, column], ["rn"], {"_seen": ("last", F.col("rn"), False)}).drop(BUCKET)
    from_ = scan(order_buckets(again, "rn", keys), keys, ["rn"], {"_from": ("max", F.col("_seen"), True)})
    return from_.groupBy(*keys).agg(F.max(F.col("rn") - F.coalesce("_from", F.lit(0))).alias("longest"))


def covering_window(df: DataFrame, keys: list[str], order: list[str], column: str, wanted: dict[str, int]) -> DataFrame:
    """The shortest stretch of a series that holds each wanted value often enough: (first_row, length).

    Rows count from 1; of stretches of one length the first is taken; a series
    that never holds all has nulls.  At the c-th occurrence of a value wanted
    k times, a window must start at its occurrence c-k+1 or before; these
    starts only grow, so a running maximum per wanted value carries them along,
    and the window that ends at a row starts at the smallest of them.
    """
    numbered = row_numbers(order_buckets(df, order, keys), keys, order).drop(BUCKET)
    rows = cut_lineage(numbered.select(*keys, "rn", F.col(column).alias("_v")))
    asked = rows.where(F.col("_v").isin(*wanted))
    turn = row_numbers(order_buckets(asked, "rn", [*keys, "_v"]), [*keys, "_v"], ["rn"], "_c").drop(BUCKET)
    turn = cut_lineage(turn)
    need = F.create_map(*[F.lit(x) for pair in wanted.items() for x in pair])
    earlier = turn.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_v").alias("_w"), (F.col("_c") + need[F.col("_v")] - 1).alias("_at"), F.col("rn").alias("_start"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    starts = turn.join(earlier, [*same, F.col("_v") == F.col("_w"), F.col("_c") == F.col("_at")]).select(*keys, "rn", "_v", "_start")
    specs = {f"_s{i}": ("max", F.when(F.col("_v") == v, F.col("_start")), True) for i, v in enumerate(wanted)}
    carried = scan(order_buckets(starts, "rn", keys), keys, ["rn"], specs)
    complete = carried.where(" and ".join(f"_s{i} is not null" for i in range(len(wanted))))
    begin = F.least(*[F.col(f"_s{i}") for i in range(len(wanted))]) if len(wanted) > 1 else F.col("_s0")
    best = complete.groupBy(*keys).agg(F.min(F.struct((F.col("rn") - begin + 1).alias("length"), begin.alias("first_row"))).alias("_b"))
    every = rows.select(*keys).distinct()
    named = best.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_b")
    return every.join(named, same, "left").select(*keys, F.col("_b.first_row").alias("first_row"), F.col("_b.length").alias("length"))


def _prefix_hashes(codes: np.ndarray, powers: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((codes + np.uint64(1)) * powers[:len(codes)], dtype=np.uint64)])


def palindrome_at_all_centres(text: str) -> tuple[int, int]:
    """(start, length) of the longest palindrome, the first of several, in code points.

    Prefix hashes of the text and of its reverse tell whether two halves
    are the same; a binary search finds the longest arm of every centre at
    once.  The answer is compared letter by letter; should two hashes ever
    fall together, its centre is measured anew and the longest is sought again.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    n = len(codes)
    if n == 0:
        return 0, 0
    factor = np.uint64(0x9E3779B97F4A7C15)
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, factor)]), dtype=np.uint64)
    there, back = _prefix_hashes(codes, powers), _prefix_hashes(codes[::-1], powers)

    def same(left: np.ndarray, right: np.ndarray, arm: np.ndarray) -> np.ndarray:
        """Whether ``arm`` letters from ``right`` on are those before ``left`` read backwards."""
        a = (there[right + arm] - there[right]) * powers[n - right]
        from_ = n - left
        b = (back[from_ + arm] - back[from_]) * powers[n - from_]
        return a == b

    centre = np.arange(2 * n - 1)
    right, left = (centre + 2) // 2, (centre + 1) // 2
    low, high = np.zeros(len(centre), dtype=np.int64), np.minimum(left, n - right)
    while (low < high).any():
        middle = (low + high + 1) // 2
        fits = same(left, right, middle)
        low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
    length = 2 * low + right - left
    while True:
        at = int(np.argmax(length))
        start = int(left[at] - low[at])
        part = codes[start:start + int(length[at])]
        if (part == part[::-1]).all():
            return start, len(part)
        arm = int(low[at])
        wrong = codes[left[at] - arm:left[at]][::-1] != codes[right[at]:right[at] + arm]
        low[at] = int(np.argmax(wrong))
        length[at] = 2 * low[at] + right[at] - left[at]


def longest_palindrome(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Per text start and length of its longest palindrome (:func:`palindrome_at_all_centres`); nulls have length 0."""
    source = texts.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kind = dict(source.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [palindrome_at_all_centres(t) for t in batch.column(1).to_pylist()]
            starts, sizes = ([f[i] for f in found] for i in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], [key, "start", "length"])

    return source.mapInArrow(run, f"`{key}` {kind}, start long, length long")


def word_cuts(texts: DataFrame, vocabulary: DataFrame, key: str, text: str) -> DataFrame:
    """Whether each text is a row of vocabulary words without gaps: (key, words_found, can_cut).

    Pieces of each length that a word has are joined to the vocabulary by
    value; what joins are steps between places of a text.  From a place
    that can be reached, all steps from it lead on: places are settled in the
    order of the text, as every step goes forward.  Null and empty texts need no word.
    """
    words = vocabulary.select("word").where("word <> ''").distinct()
    lengths = words.select(F.length("word").alias("n")).distinct().agg(F.array_sort(F.collect_set("n"))).scalar()
    sized = texts.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_t")).withColumn("_ns", lengths)
    starts = sized.select(key, "_t", "_ns", F.explode(F.sequence(F.lit(0), F.length("_t") - 1)).alias("at")).where("_t <> ''")
    fits = starts.select(key, "at", "_t", F.explode(F.filter("_ns", lambda n: n + F.col("at") <= F.length("_t"))).alias("n"))
    pieces = fits.select(key, "at", (F.col("at") + F.col("n")).alias("to"), F.substring(F.col("_t"), F.col("at") + 1, F.col("n")).alias("word"))
    steps = pieces.join(words, "word", "left_semi").select(key, "at", "to")
    # bounded by one text: at most its places times the lengths of words
    per = steps.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "to"))).alias("steps"))
    named = per.withColumnRenamed(key, "_key")
    full = sized.join(named, F.col(key).eqNullSafe(F.col("_key")), "left")
    reached = F.aggregate(
        F.coalesce("steps", F.array().cast("array<struct<at:int,to:int>>")),
        F.struct(F.array(F.lit(0)).alias("open"), F.lit(0).alias("seen")),
        lambda s, e: F.struct(
            F.when(F.array_contains(s["open"], e["at"]), F.array_union(F.filter(s["open"], lambda p: p >= e["at"]), F.array(e["to"]))).otherwise(s["open"]).alias("open"),
            s["seen"].alias("seen"),
        ),
    )
    ends = F.array_contains(reached["open"], F.length("_t"))
    count = F.coalesce(F.size("steps"), F.lit(0))
    return full.select(key, F.greatest(count, F.lit(0)).cast("long").alias("words_found"), ((F.col("_t") == "") | ends).alias("can_cut"))


def words_on_grid(grid: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Words that can be traced over neighbouring cells, each cell used once: (word, paths).

    ``grid`` has (r, c, letter).  All beginnings of the words are a table;
    paths grow a cell at a time and are joined to it, so a path that starts no
    word ends there.  Rounds grow with the longest beginning on the grid.
    """
    spark = grid.sparkSession
    words = vocabulary.select("word").where("word <> ''").distinct()
    starts = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word")), lambda n: F.struct(
        F.substring(F.col("word"), F.lit(1), n).alias("prefix"), (n == F.length("word")).alias("whole")
    ))).alias("p")).groupBy("p.prefix").agg(F.max("p.whole").alias("whole"))
    starts = cut_lineage(starts)
    cells = cut_lineage(grid.select("r", "c", "letter"))
    steps = F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in ((0, 1), (0, -1), (1, 0), (-1, 0))])
    rounds, base = Rounds(spark, "paths"), scratch_path(spark, "grid-words")
    place = lambda r, c: F.struct(F.col(r).alias("r"), F.col(c).alias("c"))
    first = cells.select("r", "c", F.col("letter").alias("prefix"), F.array(place("r", "c")).alias("path"))
    paths = rounds.save(first.join(starts, "prefix").select("r", "c", "prefix", "path", "whole"))
    size = 0
    while True:
        done = paths.where("whole").groupBy(F.col("prefix").alias("word")).agg(F.count("*").alias("paths"))
        done.write.parquet(f"{base}/size={size}")
        if paths.isEmpty():
            return spark.read.schema(done.schema).parquet(base).select("word", "paths")
        around = paths.select("prefix", "path", F.col("r").alias("_r"), F.col("c").alias("_c"), F.explode(steps).alias("s")).select(
            "prefix", "path", (F.col("_r") + F.col("s.dr")).alias("r"), (F.col("_c") + F.col("s.dc")).alias("c")
        )
        on = around.join(cells, ["r", "c"]).where(~F.array_contains("path", place("r", "c")))
        longer = on.select("r", "c", F.concat("prefix", "letter").alias("prefix"), F.array_append("path", place("r", "c")).alias("path"))
        paths = rounds.save(longer.join(starts, "prefix").select("r", "c", "prefix", "path", "whole"))
        size += 1
