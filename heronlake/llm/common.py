"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heronlake.plans.shared import remove, scratch_path

# The six ASCII white space characters that part words.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
# Places of the screen before a join.
PLACES = 1 << 21


def whole_text(column: str = "text") -> Column:
    """The text as it stands; null is empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Work ``value`` out once and hand it to ``use``, inside one expression."""
    return F.element_at(F.transform(F.array(value), use), 1)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, stored once in the cluster's shared folder.

    What follows starts from files, so a lost executor repeats no earlier
    stage, and Spark knows the size when it picks a join.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a table of :func:`written` that no later step reads."""
    remove(df.sparkSession, df.scratch)


def by_shuffle(df: DataFrame) -> DataFrame:
    """Mark a side whose rows grow with the corpus: it is joined by a shuffle at
    every size, never sent whole to all tasks where a small input would allow it."""
    return df.hint("shuffle_merge")


def row_key(doc_id: Column, sha: Column) -> Column:
    """128 bits that tell a row by its id, null or not, and its text's SHA-256."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), sha)))


def without(docs: DataFrame, gone: DataFrame, again: DataFrame) -> DataFrame:
    """The rows whose key is not in ``gone``; of rows with one key in ``again`` one stays.

    Keys are those of :func:`row_key`, one column ``key`` without repeats.
    They fall on at most ``PLACES`` places, a bounded table that goes to all tasks,
    so most rows that nothing is said about stay where they are.  Rows travel
    as one packed column, so no name of theirs can clash.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(PLACES))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(whole, row_key(F.col("doc_id").cast("long"), F.sha2(whole_text(), 256)).alias("key"))
    said = gone.select("key").unionAll(again.select("key")).select(place("key").alias("place")).distinct()
    quiet = rows.join(F.broadcast(said), place("key") == F.col("place"), "left_anti")
    loud = rows.join(F.broadcast(said), place("key") == F.col("place"), "left_semi")
    # rows with one key are the same id and text, and belong to one group
    left = loud.dropDuplicates(["key"]).join(by_shuffle(gone), "key", "left_anti")
    return quiet.select("row.*").unionByName(left.select("row.*"))


def map_texts(docs: DataFrame, work: Callable[[list[str]], list[list]], schema: str) -> DataFrame:
    """One row per document: ``doc_id`` and the columns of ``schema``.

    ``work`` gets a few whole texts at a time, in Arrow batches inside the
    task that read them, and returns a list per column.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    full = f"doc_id long, {schema}"
    arrow = pa.schema(_arrow_fields(source.sparkSession, full))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                columns = work(part.column(1).to_pylist())
                arrays = [part.column(0)] + [pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:])]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return source.mapInArrow(run, full)


def slices(batch: pa.RecordBatch, text_column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``most`` bytes of text, one row at least."""
    import numpy as np
    import pyarrow.compute as pc

    if batch.num_rows == 0:
        return
    ends = np.cumsum(pc.binary_length(batch.column(text_column)).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, end - start)
        start = end


def _arrow_fields(spark: SparkSession, ddl: str) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return list(to_arrow_schema(StructType.fromDDL(ddl)))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span in order, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
