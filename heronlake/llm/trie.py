"""The prefix trie of conversations by ROLLUP over columns of turn ids."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from heronlake.llm.common import written
from heronlake.plans.ordered import order_buckets, row_numbers, scan
from heronlake.plans.skew import attach

# Positions in a block of columns; conversations that share one
# piece of a list of ids; groups of conversations that share a start, and most turns they share.
WIDTH, IDS = 8, 4096
FAMILY, SHARED = 5, 9

SLOTS = [f"t{i}" for i in range(1, WIDTH + 1)]
NODE = ["depth", "ha", "hb"]
NUMBER = "decimal(38,0)"


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, tid, bytes): turns counted from one, by turn, role and text.

    ``tid`` is a 128-bit hash of role and text.  Places are counted over ranges
    of rows, so a conversation may be of any length.
    """
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = ["turn", "role", "text"]
    placed = row_numbers(order_buckets(rows, order, ["conv_id"]), ["conv_id"], order, "pos")
    tid = F.unhex(F.md5(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text")))
    return placed.select("conv_id", "pos", tid.alias("tid"), F.octet_length("text").cast("long").alias("bytes"))


def shared_starts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their family: turns (conv_id, pos, tid, bytes) and (conv_id, length).

    Conversation c takes the first h turns of conversation ``c - c % 5`` and
    goes on with its own turns after the first h; h is a checksum of c.
    """
    c = F.col("conv_id")
    sizes = rows.groupBy("conv_id").agg(F.max("pos").alias("n"))
    plan = sizes.select(
        "conv_id", "n", (c - c % FAMILY).alias("base"), (F.crc32(c.cast("string").cast("binary")) % SHARED).cast("long").alias("h")
    )
    plan = plan.join(sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left")
    plan = written(plan.withColumn("start", F.least("h", F.coalesce("base_n", F.lit(0).cast("long")))), "trie-plan")
    own = rows.join(plan.select("conv_id", "h", "start"), "conv_id").where("pos > h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("start")).alias("pos"), "tid", "bytes")
    # a start has fewer than SHARED turns, so no long conversation moves here
    first = rows.where(F.col("pos") < SHARED).withColumnRenamed("conv_id", "base")
    taken = plan.select("conv_id", "base", "h").join(first, "base").where("pos <= h").select("conv_id", "pos", "tid", "bytes")
    lengths = plan.select("conv_id", (F.col("start") + F.greatest(F.lit(0).cast("long"), F.col("n") - F.col("h"))).alias("length"))
    return own.unionByName(taken), lengths


def place_hash(seed: int, pos: Column, tid: Column) -> Column:
    return F.xxhash64(F.lit(seed), pos, tid).cast("decimal(20,0)")


def blocks_of(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, length, block, pa, pb, t1.., b1..): each conversation cut into rows of ``WIDTH`` turns.

    ``pa`` and ``pb`` name the node that the block before ends in: sums of two
    64-bit hashes of place and turn over all turns before.  Every conversation
    has a first block, even one without turns.
    """
    at, slot = F.col("pos") - 1, (F.col("pos") - 1) % WIDTH + 1
    cells = rows.select("conv_id", F.floor(at / WIDTH).cast("long").alias("block"), slot.alias("slot"), "pos", "tid", "bytes")
    pick = lambda value, i: F.max(F.when(F.col("slot") == i, F.col(value)))
    cut = cells.groupBy("conv_id", "block").agg(
        *[pick("tid", i).alias(f"t{i}") for i in range(1, WIDTH + 1)], *[pick("bytes", i).alias(f"b{i}") for i in range(1, WIDTH + 1)],
        F.sum(place_hash(1, F.col("pos"), F.col("tid"))).cast(NUMBER).alias("sa"), F.sum(place_hash(2, F.col("pos"), F.col("tid"))).cast(NUMBER).alias("sb"),
    )
    bare = lengths.where("length = 0").withColumn("block", F.lit(0).cast("long"))
    cut = written(cut.join(lengths, "conv_id").unionByName(bare, allowMissingColumns=True), "trie-cut")
    short, long_ = cut.where(F.col("length") <= WIDTH), cut.where(F.col("length") > WIDTH)
    before = scan(order_buckets(long_, "block", ["conv_id"]), ["conv_id"], ["block"], {"pa": ("sum", F.col("sa"), False), "pb": ("sum", F.col("sb"), False)})
    zero = F.lit(0).cast(NUMBER)
    keep = ["conv_id", "length", "block", *SLOTS, *[f"b{i}" for i in range(1, WIDTH + 1)]]
    return short.select(*keep, zero.alias("pa"), zero.alias("pb")).unionByName(
        before.select(*keep, F.col("pa").cast(NUMBER).alias("pa"), F.col("pb").cast(NUMBER).alias("pb"))
    )


def rolled(blocks: DataFrame, aggregates: list[str]) -> DataFrame:
    """All prefixes at once: ROLLUP over the columns of a block within the node before it.

    One row per node with its depth, its hashes and those of its parent
    (``qa``, ``qb``), its place ``level`` in the block and the aggregates.  A
    group whose last column holds no turn is no node, and level 0 of a later
    block is the last level of the block before.
    """
    names = ", ".join(SLOTS)
    sums = blocks.sparkSession.sql(
        f"select block, pa, pb, {names}, grouping_id() as g, {', '.join(aggregates)} "
        f"from {{blocks}} group by block, pa, pb, rollup({names})", blocks=blocks,
    )
    level = F.lit(WIDTH) - F.bit_count("g")
    here = F.coalesce(*[F.when(F.col("level") == i, F.col(f"t{i}")) for i in range(1, WIDTH + 1)])
    nodes = sums.withColumn("level", level).where(((F.col("level") == 0) & (F.col("block") == 0)) | here.isNotNull())
    whole, parent = {}, {}
    for seed, side in ((1, "a"), (2, "b")):
        parts = [place_hash(seed, F.col("block") * WIDTH + i, F.col(f"t{i}")) for i in range(1, WIDTH + 1)]
        upto = lambda last: sum((F.when(F.col("level") >= i + last, p).otherwise(0) for i, p in enumerate(parts, 1)), F.col(f"p{side}")).cast(NUMBER)  # noqa: B023,E731
        whole[f"h{side}"], parent[f"q{side}"] = upto(0), upto(1)
    return nodes.withColumns({"depth": F.col("block") * WIDTH + F.col("level"), **whole, **parent}).drop(*SLOTS, "g", "pa", "pb", "block")


def at_level(prefix: str) -> Column:
    return F.coalesce(*[F.when(F.col("level") == i, F.col(f"{prefix}{i}")) for i in range(1, WIDTH + 1)])


def trie_nodes(blocks: DataFrame) -> DataFrame:
    """(depth, ha, hb, qa, qb, level, conv_id, n_convs, longest, bytes) of every node."""
    sizes = [f"min(b{i}) as b{i}" for i in range(1, WIDTH + 1)]
    nodes = rolled(blocks, ["count(*) as n_convs", "min(conv_id) as conv_id", "max(length) as longest", *sizes])
    return nodes.select(
        *NODE, "qa", "qb", "level", "conv_id", "n_convs", "longest", F.coalesce(at_level("b"), F.lit(0).cast("long")).alias("bytes")
    )


def subtree_sums(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """(depth, ha, hb, n_leaves, saved_tokens) of every node.

    A node belongs to its smallest conversation, and a conversation owns the
    nodes of its path from some depth on.  So the sum over a subtree is the
    sum, over the members, of what they own from that depth on: suffix sums
    along each conversation, added up by a second ROLLUP.
    """
    block = F.greatest(F.lit(0), F.floor((F.col("depth") - 1) / WIDTH)).cast("long")
    own = nodes.select(
        "conv_id", block.alias("block"), (F.col("depth") - block * WIDTH).alias("slot"),
        (F.col("longest") == F.col("depth")).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    # slot 0, the root, is in the first block alone
    pick = lambda value, i: F.sum(F.when(F.col("slot") >= i, F.col(value)).otherwise(0))
    ranks = range(WIDTH + 1)
    later = own.groupBy("conv_id", "block").agg(
        *[pick("leaf", i).alias(f"l{i}") for i in ranks], *[pick("saved", i).alias(f"s{i}") for i in ranks]
    )
    both = blocks.select("conv_id", "length", "block", "pa", "pb", *SLOTS).join(later, ["conv_id", "block"], "left")
    zero = F.lit(0).cast("long")
    both = written(both.fillna(0, [f"{c}{i}" for c in "ls" for i in ranks]), "trie-owned")
    short, long_ = both.where(F.col("length") <= WIDTH), both.where(F.col("length") > WIDTH)
    after = scan(order_buckets(long_, "block", ["conv_id"]), ["conv_id"], ["block"],
                 {"la": ("sum", F.col("l0"), False), "sa": ("sum", F.col("s0"), False)}, reverse=True)
    full = short.withColumns({"la": zero, "sa": zero}).unionByName(after.withColumns({"la": F.col("la").cast("long"), "sa": F.col("sa").cast("long")}).drop("_bucket"))
    sums = rolled(full, [f"sum({c}{i} + {c}a) as {c}{i}" for c in "ls" for i in ranks])
    pick = lambda c: F.when(F.col("level") == 0, F.col(f"{c}0")).otherwise(at_level(c))
    return sums.select(*NODE, pick("l").alias("n_leaves"), pick("s").alias("saved_tokens"))


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, ha, hb, ends_sha256) from (depth, ha, hb, conv_id): SHA-256 of the ids in order, joined by commas.

    Ids are joined in pieces of bounded length first; the digest of a node
    reads its pieces in order, one at a time.
    """
    piece = F.floor(F.col("conv_id") / IDS).cast("long")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    pieces = ends.groupBy(*NODE, piece.alias("piece")).agg(ids.alias("ids"))
    keys = [F.col(c).cast("string").alias(c) for c in NODE]
    pieces = pieces.select(*keys, "piece", "ids").repartition(*NODE).sortWithinPartitions(*NODE, "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            out = []
            for *key, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if key != node:
                    if node is not None:
                        out.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if out:
                yield _digests(out)
        if node is not None:
            yield _digests([(*node, digest.hexdigest())])

    found = pieces.mapInArrow(run, "depth string, ha string, hb string, ends_sha256 string")
    return found.select(F.col("depth").cast("long").alias("depth"), F.col("ha").cast(NUMBER).alias("ha"), F.col("hb").cast(NUMBER).alias("hb"), "ends_sha256")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], [*NODE, "ends_sha256"])


def prefix_trie(turns: DataFrame, rebuild: bool = True) -> DataFrame:
    """One row per node of the trie over whole conversations, turn by turn.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256; the root has depth 0 and no
    parent.  With ``rebuild`` conversations first take the start of their
    family (see :func:`shared_starts`).

    Turns go by number (null first), then by role and text; null role or text
    is empty, so both are the same turn.  Empty and very long texts and
    repeated rows are turns like any other.  Rows without conv_id belong to no
    conversation.  An empty table has no conversation and gives no rows;
    further columns are not looked at.
    """
    rows = numbered_turns(turns)
    if rebuild:
        rows, lengths = shared_starts(written(rows, "trie-turns"))
    else:
        rows = written(rows, "trie-turns")
        lengths = rows.groupBy("conv_id").agg(F.max("pos").alias("length"))
    blocks = written(blocks_of(rows, lengths), "trie-blocks")
    nodes = written(trie_nodes(blocks), "trie-nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("qa").alias("ha"), F.col("qb").alias("hb")).agg(F.count("*").alias("n_children"))
    sums = subtree_sums(blocks, nodes)
    digests = end_digests(end_nodes(blocks))
    known = nodes.join(children, NODE, "left").join(sums, NODE).join(digests, NODE, "left")
    known = written(known, "trie-known")
    up = known.select((F.col("depth") + 1).alias("depth"), F.col("ha").alias("qa"), F.col("hb").alias("qb"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("_n"))
    below = attach(known.where("depth > 0"), up.where("_n > 0"), ["depth", "qa", "qb"])
    top = known.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return below.unionByName(top).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def end_nodes(blocks: DataFrame) -> DataFrame:
    """(depth, ha, hb, conv_id): the node in which each conversation ends."""
    last = blocks.where(F.col("block") == F.floor((F.greatest("length", F.lit(1)) - 1) / WIDTH))
    hashes = {}
    for seed, side in ((1, "a"), (2, "b")):
        parts = [F.coalesce(place_hash(seed, F.col("block") * WIDTH + i, F.col(f"t{i}")), F.lit(0)) for i in range(1, WIDTH + 1)]
        known = [F.when(F.col(f"t{i}").isNotNull(), p).otherwise(0) for i, p in enumerate(parts, 1)]
        hashes[f"h{side}"] = sum(known, F.col(f"p{side}")).cast(NUMBER)
    return last.select(F.col("length").alias("depth"), *[v.alias(k) for k, v in hashes.items()], "conv_id")
