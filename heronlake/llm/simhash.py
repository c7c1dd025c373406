"""Near duplicates by SimHash, candidates by tables of distances to reference fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from heronlake.llm.common import row_key, slices, whole_text, without, written
from heronlake.plans.graph import component_roots
from heronlake.plans.skew import attach

# Seed of the shingle hash; numbers of references and blocks;
# fingerprints of a key that are still paired.
SEED, REFERENCES, BLOCKS = 42, 16, 5
DENSE = 1000


def fingerprint(text: str, shingle: int = 3) -> int:
    """64 bits: a bit is set if it is set in over half of the shingles' hashes.

    A-Z are lower-cased, words are parted by ASCII white space; shingles are
    ``shingle`` words apart by one space, repeats included; fewer words are
    one shingle, no words give zero.
    """
    import xxhash

    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    last = ends[shingle - 1:] or ends[-1:]
    ones, count = np.zeros(64, dtype=np.int64), len(last)
    for at in range(0, count, 1 << 15):
        hashes = [digest(line[a:b - 1], SEED) for a, b in zip(starts[at:at + (1 << 15)], last[at:at + (1 << 15)])]
        raw = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One row per document: doc_id, ``key`` (hash of id and text) and ``fp``, the fingerprint as a signed long."""
    doc_id = F.col("doc_id").cast("long")
    source = docs.select(doc_id.alias("doc_id"), row_key(doc_id, F.sha2(whole_text(), 256)).alias("key"), whole_text().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                found = np.array([fingerprint(t, shingle) for t in part.column(2).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found.view(np.int64))], ["doc_id", "key", "fp"])

    return source.mapInArrow(run, "doc_id long, key binary, fp long")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def references() -> list[int]:
    """The reference fingerprints, from the shingle hash of their numbers."""
    import xxhash

    return [signed(xxhash.xxh64_intdigest(str(i).encode(), SEED)) for i in range(REFERENCES)]


def block_masks() -> list[int]:
    """Masks over two of five blocks of bits: of two fingerprints that differ in
    three bits at most, two blocks at least are the same."""
    cuts = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [signed(a | b) for a, b in combinations(blocks, 2)]


def distance(a: Column, b: Column | int) -> Column:
    return F.bit_count(a.bitwiseXOR(b if isinstance(b, Column) else F.lit(b)))


def distance_table(prints: DataFrame, masks: list[int]) -> DataFrame:
    """(fp, d0, d1, keys): Hamming distances of each fingerprint to all references.

    The sixteen whole distances are packed eight to a long, a byte each.
    ``keys`` has one number per mask, a hash of the sixteen distances taken
    over the bits of the mask alone; fingerprints that agree in those bits
    have the same key.
    """
    fp, packed = F.col("fp"), []
    whole = [distance(fp, r).cast("long") for r in references()]
    for first in range(0, REFERENCES, 8):
        value = F.lit(0).cast("long")
        for place, d in enumerate(whole[first:first + 8]):
            value = value.bitwiseOR(F.shiftleft(d, 8 * place))
        packed.append(value.alias(f"d{first // 8}"))
    apart = F.transform(F.array(*[F.lit(r) for r in references()]), lambda r: fp.bitwiseXOR(r))
    keys = F.transform(
        F.array(*[F.lit(m) for m in masks]),
        lambda m, i: F.xxhash64(i, F.transform(F.col("_apart"), lambda x: F.bit_count(x.bitwiseAND(m)))),
    )
    return prints.select("fp", *packed, apart.alias("_apart")).select("fp", "d0", "d1", keys.alias("keys"))


def within(a: str, b: str, bits: int) -> Column:
    """No coordinate differs by more than ``bits``, and the fingerprints do not either."""
    gaps = []
    for half in ("d0", "d1"):
        for place in range(8):
            part = lambda c: F.shiftrightunsigned(F.col(f"{c}.{half}"), 8 * place).bitwiseAND(F.lit(255).cast("long"))  # noqa: B023,E731
            gaps.append(F.abs(part(a) - part(b)))
    return (F.greatest(*gaps) <= bits) & (distance(F.col(f"{a}.fp"), F.col(f"{b}.fp")) <= bits)


def fingerprint_links(prints: DataFrame, bits: int = 3, dense: int = DENSE) -> DataFrame:
    """Links (src, dst) that join all distinct fingerprints within ``bits`` (at most three) bits.

    Candidates agree in all reference distances over two blocks of bits.  They are
    discarded if any whole distance differs by more than ``bits``, and the
    rest is verified bit by bit, all inside the join condition, so only links
    leave it.  A key shared by more than ``dense`` fingerprints is not paired:
    see :func:`crowded_links`, which is exact as well.
    """
    table = written(distance_table(prints, block_masks()), "simhash-distances")
    entries = table.select("fp", "d0", "d1", F.explode("keys").alias("key"))
    crowded = written(entries.groupBy("key").agg(F.count("*").alias("_n")).where(F.col("_n") > dense).select("key"), "simhash-crowded")
    sparse = entries.join(crowded, "key", "left_anti")
    a, b = sparse.alias("a"), sparse.alias("b")
    near = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")) & within("a", "b", bits))
    links = near.select(F.col("a.fp").alias("src"), F.col("b.fp").alias("dst")).distinct()
    if crowded.isEmpty():
        return links
    hot = entries.join(crowded, "key", "left_semi").select("fp").distinct()
    return links.unionAll(crowded_links(hot, bits)).distinct()


def crowded_links(prints: DataFrame, bits: int = 3) -> DataFrame:
    """Links that give the same components, their number growing with the rows, not with pairs.

    Two fingerprints differ in at most three bits exactly if some point lies
    within one bit of one and two of the other.  Each fingerprint marks the
    points within two bits; where one of them is within the closer distance,
    all that marked the point hang together, so each gets one link to the
    smallest.
    """
    near, far = bits // 2, bits - bits // 2
    flips = prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("i"))
    flips = flips.select("fp", "i", F.explode(F.sequence(F.col("i"), F.lit(64))).alias("j"))
    bit = lambda c: F.when(F.col(c) < 64, F.expr(f"shiftleft(1L, {c})")).otherwise(F.lit(0).cast("long"))
    size = F.when(F.col("i") == 64, 0).when((F.col("j") == 64), 1).otherwise(2)
    marks = flips.where("i < j or i = 64").select(
        "fp", F.col("fp").bitwiseXOR(bit("i")).bitwiseXOR(F.when(F.col("i") < F.col("j"), bit("j")).otherwise(F.lit(0).cast("long"))).alias("point"),
        size.alias("size"),
    ).where(F.col("size") <= far)
    points = marks.groupBy("point").agg(
        F.min(F.when(F.col("size") <= near, F.col("fp"))).alias("close"), F.min("fp").alias("low"), F.count("*").alias("_n")
    ).where("close is not null and _n > 1").select("point", "low")
    return marks.join(points, "point").where("fp <> low").select(F.col("low").alias("src"), F.col("fp").alias("dst")).distinct()


def rooted(docs: DataFrame, shingle: int, bits: int, dense: int) -> DataFrame:
    """Rows of :func:`fingerprints` with ``root``, a fingerprint that names their group."""
    marks = written(fingerprints(docs, shingle), "simhash-prints")
    nodes = written(marks.groupBy("fp").agg(F.count("*").alias("_n")), "simhash-nodes")
    roots = component_roots(fingerprint_links(nodes.select("fp"), bits, dense)).withColumnRenamed("id", "fp")
    named = written(nodes.join(roots, "fp", "left").select("fp", F.coalesce("component", "fp").alias("root"), "_n"), "simhash-roots")
    return attach(marks, named, ["fp"])


def near_groups(docs: DataFrame, shingle: int = 3, bits: int = 3, dense: int = DENSE) -> DataFrame:
    """One row per input row: doc_id, fp and component_id.

    Documents whose fingerprints differ in at most ``bits`` bits are linked;
    ``component_id`` is the smallest id that links lead to.  Equal
    fingerprints are one node, so copies are never paired.

    Null and empty texts have fingerprint zero and link like any other.  Null
    ids belong to a group and never name it, unless all are null.  Repeated
    rows carry the same answer.  An empty table gives no rows; further
    columns are not looked at.
    """
    rows = rooted(docs, shingle, bits, dense)
    names = written(rows.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("_n")), "simhash-names")
    return attach(rows, names, ["root"]).select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = 3, bits: int = 3, dense: int = DENSE) -> DataFrame:
    """The documents without near copies, all their columns as they were.

    Of each group of :func:`near_groups` one row stays: that with the smallest
    id, and of several texts with this id the one whose hash is smallest.  A
    row is told by id and text, so other texts under the same or a null id
    are groups of their own.  A null id stays only where the group has no
    other.  Of rows that repeat both id and text one stays.  Null and empty
    texts are one group.  An empty table gives no rows; columns of any name
    are kept.
    """
    rows = written(rooted(docs, shingle, bits, dense).select("doc_id", "key", "root"), "simhash-rows")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "key"))
    groups = rows.groupBy("root").agg(best.alias("_best"), F.count("*").alias("_n")).where("_n > 1")
    groups = written(groups.select("root", F.col("_best.key").alias("_keep"), "_n"), "simhash-groups")
    told = attach(rows, groups, ["root"])
    gone = written(told.where("key <> _keep").select("key").distinct(), "simhash-gone")
    again = written(told.where("key = _keep").groupBy("key").count().where("count > 1").select("key"), "simhash-again")
    return without(docs, gone, again)
