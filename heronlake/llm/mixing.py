"""Mixing sources to target weights by repeating documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from heronlake.llm.common import WORD, whole_text, written

# Weights by place in the order of sources.
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Target per source from (source, source_size): adds ``target`` and ``rate``.

    Sources go by code point, null last, and take the weights in turn.  They
    share ``share`` times all sizes by weight.  A target stops at ``most``
    times its source's size and the rest is shared again: sources fill up in
    the order of cap over weight, so one pass over them sorted that way finds
    the level at which the remaining sources share what is left.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    ranked = sizes.select("source", "source_size", w.alias("_w"))
    cap = F.col("source_size") * F.lit(most)
    fill = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before, rest = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = ranked.withColumn("_cap", cap).withColumn(
        "_level",
        (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        / F.sum("_w").over(rest),
    )
    # the first source that the level does not fill sets it for all after it
    open_ = F.col("_cap") > F.col("_level") * F.col("_w")
    level = F.max(F.when(open_, F.col("_level"))).over(everything)
    target = F.least(F.col("_cap"), F.coalesce(level * F.col("_w"), F.col("_cap")))
    ranked = ranked.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return ranked.select("source", "source_size", "target", rate.alias("rate"))


def draw(seed: str, key: Column) -> Column:
    """A number in [0, 1) that depends on seed and key alone."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 12), 16, 10).cast("double")
    return bits / F.lit(float(16**12))


def source_rates(facts: DataFrame) -> DataFrame:
    """(_source, source_size, target, rate) from rows of (source, size), one row per source.

    Written out, so that Spark knows its size: small, it is broadcast and no
    document moves; large, the join goes by hash and splits a crowded source.
    """
    sizes = facts.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    return written(source_targets(sizes), "mix-rates").withColumnRenamed("source", "_source")


def copies_of(seed: str, key: Column) -> Column:
    """floor(rate) copies and one more where the draw falls below the fraction."""
    whole = F.floor("rate").cast("long")
    return whole + (draw(seed, key) < F.col("rate") - whole).cast("long")


def draw_key() -> Column:
    """What decides a document's draw: its id, or its text where that is null."""
    return F.coalesce(F.col("doc_id").cast("string"), F.md5(whole_text()))


def mix_sizes(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies.

    A document of rate r comes floor(r) times and once more with probability
    r - floor(r), drawn from a hash of seed and id, so reruns agree and no
    order matters.  ``taken`` is copies times size.

    Null text has size 0; a null source is a source of its own, after all
    others; empty documents take part with no words.  A null id draws by its
    text.  Repeated rows draw alike.  An empty table gives no rows; further
    columns are not looked at.
    """
    facts = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(whole_text()).alias("size"), draw_key().alias("_key"),
    ), "mix-sizes")
    joined = facts.join(source_rates(facts), F.col("source").eqNullSafe(F.col("_source")))
    copies = copies_of(seed, F.col("_key"))
    return joined.select(
        "doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies")
    )


def mix_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it, columns as they were."""
    sizes = docs.select(F.col("source").cast("string").alias("source"), word_count(whole_text()).alias("size"))
    rates = source_rates(sizes).select("_source", F.col("rate"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    keyed = docs.select(row, F.col("source").cast("string").alias("_own"), draw_key().alias("_key"))
    joined = keyed.join(rates, F.col("_own").eqNullSafe(F.col("_source")))
    times = copies_of(seed, F.col("_key")).cast("int")
    taken = joined.select("_row", times.alias("_times")).where("_times > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_row.*")
