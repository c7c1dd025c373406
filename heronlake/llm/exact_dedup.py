"""Exact duplicates by content hash, with bytes compared inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from heronlake.llm.common import row_key, whole_text, without, written


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(text))


def exact_groups(
    docs: DataFrame, keep: str = "min", hash_of: Callable[[Column], Column] = content_hash
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are grouped by a 128-bit hash of the whole text; only hashes and ids
    move.  ``keep`` says whether the smallest or the largest id stays.  Where
    a hash occurs more than once, the texts are compared byte by byte (they
    are the grouping key), and a hash that stands for several texts is split.

    Null texts equal empty ones.  Null ids count in the group and lose to any
    other id.  Repeated rows all count and carry the same answer.  An empty
    table gives no rows, and further columns are not looked at.
    """
    pick = F.min if keep == "min" else F.max
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    hashed = rows.withColumn("h", hash_of(F.col("text")))
    marks = written(hashed.select("doc_id", "h", F.sha2("text", 256).alias("text_sha256")), "dedup-marks")
    groups = marks.groupBy("h").agg(F.count("*").alias("group_size"), pick("doc_id").alias("keep_id"))
    several = written(groups.where("group_size > 1"), "dedup-groups")

    # bytes: one row per text of each shared hash, copies merged before the shuffle
    shared = hashed.join(several.select("h"), "h", "left_semi")
    texts = shared.groupBy("h", "text").agg(F.count("*").alias("_n"))
    clashes = written(texts.groupBy("h").agg(F.count("*").alias("_n")).where("_n > 1").select("h"), "dedup-clashes")

    plain = marks.join(clashes, "h", "left_anti").join(several, "h", "left")
    plain = plain.select(
        "doc_id", F.coalesce("keep_id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "text_sha256",
    )
    same = Window.partitionBy("h", "text")
    split = hashed.join(clashes, "h", "left_semi").select(
        "doc_id", pick("doc_id").over(same).alias("keep_id"), F.count("*").over(same).alias("group_size"),
        F.sha2("text", 256).alias("text_sha256"),
    )
    out = plain.unionByName(split)
    return out.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_exact_copies(docs: DataFrame, keep: str = "min") -> DataFrame:
    """The documents without copies, all their columns as they were.

    Of each group the row with the smallest (or largest) id stays; of rows
    that repeat both text and id, one.  Null texts equal empty ones; an empty
    table gives no rows; columns of any name are kept.
    """
    groups = exact_groups(docs, keep).where("group_size > 1").select(row_key(F.col("doc_id"), F.col("text_sha256")).alias("key"), "kept")
    groups = written(groups, "dedup-report")
    gone = written(groups.where("not kept").select("key").distinct(), "dedup-gone")
    again = written(groups.where("kept").groupBy("key").count().where("count > 1").select("key"), "dedup-again")
    return without(docs, gone, again)
