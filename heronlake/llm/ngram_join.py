"""Similarity join on n-gram sets by a blocked sparse product of documents by n-grams."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from heronlake.llm.common import by_shuffle, forget, slices, whole_text, written
from heronlake.plans.graph import component_roots
from heronlake.plans.skew import attach

# N-grams are counted in so many slots, in blocks; bits of a
# sketch; rounds in which each n-gram has one leading set; rows of a block of the
# product; sets of an n-gram that meet in one task; sets remembered in a task.
SLOTS, BLOCK, BITS = 1 << 21, 1 << 17, 512
ROUNDS, ROWS, CROWD, KNOWN = 1, 512, 1024, 1 << 17
LONGS = BITS // 64
# The powers of this odd number, from the golden ratio's bits, are the factors of places in an n-gram.
FACTOR = 0x9E3779B97F4A7C15


class WordHashes(dict):
    """Word to its 64-bit hash; filled as words are met, emptied when it gets large."""

    def __init__(self, most: int = 1 << 19):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.most:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each 64-bit number; no two numbers fall together."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def ngrams(texts: list[str], words: int, hashes: WordHashes) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of all runs of ``words`` words; fewer words are one run, none give none.

    A run's hash adds up the hashes of its words, each times a factor of its
    place; the runs of all texts are worked out together and then cut.
    """
    parts = [t.encode("utf-8", "replace").lower().split() for t in texts]
    sizes = [len(p) for p in parts]
    own = np.fromiter((h for p in parts for h in map(hashes.__getitem__, p)), dtype=np.uint64, count=sum(sizes))
    factors = [np.uint64(FACTOR ** (k + 1) % 2**64) for k in range(words)]
    runs = np.zeros(max(0, len(own) - words + 1), dtype=np.uint64)
    for k, factor in enumerate(factors):
        runs += own[k:k + len(runs)] * factor
    runs, out, at = mixed(runs), [], 0
    for size in sizes:
        if size >= words:
            out.append(np.unique(runs[at:at + size - words + 1]))
        elif size:
            # the number of words is part of the hash, as a shorter run is no beginning of a longer one
            total = size + sum(int(h) * int(f) for h, f in zip(own[at:at + size], factors))
            out.append(mixed(np.array([total % 2**64], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        at += size
    return out


def set_name(grams: np.ndarray) -> tuple[int, int]:
    """128 bits of a set as two signed longs."""
    import xxhash

    return tuple(np.frombuffer(xxhash.xxh3_128_digest(grams.tobytes()), dtype="<i8").tolist())


def sketch(grams: np.ndarray) -> np.ndarray:
    """A bit is set if an odd number of n-grams falls on it, so two sketches
    differ in at most as many bits as there are n-grams in one set alone."""
    odd = np.bincount((grams & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def needed(size, percent: int):
    """Least overlap that a set of ``size`` n-grams has with any set as similar as ``percent``."""
    return (percent * size + 99) // 100


def set_marks(docs: DataFrame, words: int) -> DataFrame:
    """Per row doc_id, ``mark`` (hash of the text), ``h1`` and ``h2`` (hash of
    its set), ``size`` and the sketch ``s0``..; besides, rows with a ``block`` number and
    ``counts``: how often n-grams fell on each slot in the rows of one task."""
    longs = ["doc_id", "mark", "h1", "h2", "size", *[f"s{i}" for i in range(LONGS)]]
    arrow = pa.schema([*[(n, pa.int64()) for n in longs], ("block", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = WordHashes(), np.zeros(SLOTS, dtype=np.int32)
        for batch in batches:
            for part in slices(batch, 2):
                sets = ngrams(part.column(2).to_pylist(), words, hashes)
                if sets:
                    np.add.at(counts, (np.concatenate(sets) >> np.uint64(40)).astype(np.int64) % SLOTS, 1)
                names = np.array([set_name(s) for s in sets], dtype=np.int64).reshape(-1, 2)
                marks = np.array([sketch(s) for s in sets], dtype=np.int64).reshape(-1, LONGS)
                none = pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array([len(s) for s in sets], pa.int64()),
                    *[pa.array(marks[:, i].copy()) for i in range(LONGS)], *none,
                ], schema=arrow)
        for block in range(SLOTS // BLOCK):
            own = counts[block * BLOCK:(block + 1) * BLOCK]
            if own.any():
                nulls = [pa.nulls(1, pa.int64())] * len(longs)
                packed = pa.array([zlib.compress(own.tobytes(), 1)], pa.binary())
                yield pa.RecordBatch.from_arrays([*nulls, pa.array([block], pa.int32()), packed], schema=arrow)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole_text()).alias("mark"), whole_text().alias("text"))
    return texts.mapInArrow(run, ", ".join(f"{n} long" for n in longs) + ", block int, counts binary")


def slot_counts(marks: DataFrame) -> np.ndarray:
    """The counts of all tasks added up: a table of ``SLOTS`` numbers, however large the input is.

    They are added up in about the square root of the number of tasks first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[block] = sums.get(block, 0) + np.frombuffer(zlib.decompress(packed), dtype=np.int32).astype(np.int64)
        for block, own in sums.items():
            packed = zlib.compress(np.minimum(own, 2**31 - 1).astype(np.int32).tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([packed], pa.binary())], ["block", "counts"])

    found, kind = marks.where("block is not null").select("block", "counts"), "block int, counts binary"
    parts = max(1, math.isqrt(found.count() * BLOCK // SLOTS))
    some = found.repartition("block", F.pmod(F.xxhash64("counts"), F.lit(parts))).mapInArrow(run, kind)
    out = np.zeros(SLOTS, dtype=np.int32)
    for row in some.repartition("block").mapInArrow(run, kind).collect():
        out[row["block"] * BLOCK:(row["block"] + 1) * BLOCK] = np.frombuffer(zlib.decompress(row["counts"]), dtype=np.int32)
    return out


def node_of(h1, h2, clashes: set[int]):
    """One long for a set: the first half of its hash, or the second where sets clash in the first."""
    return h2 if h1 in clashes else h1


def prefix_entries(docs: DataFrame, words: int, percent: int, counts: np.ndarray, clashes: set[int], crowd: int) -> DataFrame:
    """(key, node, info, salt): the first n-grams of each set, frequent ones last.

    Of two sets as similar as ``percent``, each holds at least this part of
    the other, so both have one of their first ``size - needed + 1`` n-grams
    in common.  The order goes by the counts of slots and then by hash; any
    order gives the same links, this one keeps crowded n-grams out.  ``info``
    packs how frequent the set's n-grams are (12 bits), its size and the
    number of its n-grams from the key on (26 bits each).  An n-gram that may
    have more than ``crowd`` sets is dealt over several ``salt``; else it is -1.
    """
    shared = docs.sparkSession.sparkContext.broadcast((counts, clashes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known, (often, same) = WordHashes(), set(), shared.value
        for batch in batches:
            for part in slices(batch, 0):
                keys, nodes, infos, salts = [], [], [], []
                for grams in ngrams(part.column(0).to_pylist(), words, hashes):
                    node = node_of(*set_name(grams), same)
                    if not len(grams) or node in known:
                        continue
                    if len(known) >= KNOWN:
                        known.clear()
                    known.add(node)
                    size, times = len(grams), often[(grams >> np.uint64(40)).astype(np.int64) % SLOTS]
                    first = size - needed(size, percent) + 1
                    order = np.lexsort((grams, times))[:first]
                    own = times[order]
                    keys.append(grams[order].view(np.int64))
                    nodes.append(np.full(first, node, dtype=np.int64))
                    rank = min(2047, int(64 * np.log2(times + 1.0).mean()))
                    infos.append((rank << 52 | size << 26) + np.arange(size, size - first, -1, dtype=np.int64))
                    parts = own // crowd + 1
                    salts.append(np.where(parts > 1, np.int64(node & 0xFFFFFFFF) % parts, -1).astype(np.int32))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, nodes, infos, salts)], ["key", "node", "info", "salt"])

    return docs.select(whole_text().alias("text")).mapInArrow(run, "key long, node long, info long, salt int")


def shared_entries(entries: DataFrame) -> DataFrame:
    """(key, node, info) of n-grams that several sets have, one row per n-gram and set.

    Parts of a crowded n-gram are kept as they are; nothing is gathered by n-gram.
    """
    from pyspark.sql import Window

    per = Window.partitionBy("key", "salt")
    both = entries.withColumns({"_low": F.min("node").over(per), "_high": F.max("node").over(per)})
    return both.where("_low <> _high or salt >= 0").select("key", "node", "info").distinct()


def size_of(info: Column) -> Column:
    return F.shiftright(info, 26).bitwiseAND(F.lit((1 << 26) - 1).cast("long"))


def rest_of(info: Column) -> Column:
    return info.bitwiseAND(F.lit((1 << 26) - 1).cast("long"))


def may_meet(a: Column, b: Column, percent: int) -> Column:
    """Whether sizes and places allow the similarity: the smaller set is large enough, and at the
    first n-gram two sets have in common, all they have in common lies from there on."""
    sizes = size_of(a), size_of(b)
    enough = (100 + percent) * F.least(rest_of(a), rest_of(b)) >= percent * (sizes[0] + sizes[1])
    return (100 * F.least(*sizes) >= percent * F.greatest(*sizes)) & enough


def sketches_allow(a: str, b: str, percent: int) -> Column:
    """Whether the sketches differ in no more bits than the sizes leave n-grams apart."""
    apart = sum((F.bit_count(F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))) for i in range(LONGS)), F.lit(0))
    return (100 + percent) * apart <= (100 - percent) * (F.col(f"{a}.size") + F.col(f"{b}.size"))


def possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs (src, dst) that sketches do not rule out."""
    small = by_shuffle(nodes.select("node", "size", *[f"s{i}" for i in range(LONGS)]))
    a, b = small.alias("a"), small.alias("b")
    near = pairs.distinct().join(a, F.col("src") == F.col("a.node"))
    return near.join(b, (F.col("dst") == F.col("b.node")) & sketches_allow("a", "b", percent)).select("src", "dst")


def ngram_sets(docs: DataFrame, marks: DataFrame, words: int, clashes: set[int]) -> DataFrame:
    """(node, grams) of the texts that ``marks`` names, one mark for each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch, 1):
                sets = ngrams(part.column(1).to_pylist(), words, hashes)
                nodes = [node_of(*set_name(s), clashes) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "grams"]
                )

    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS))
    asked = marks.select(slot(F.col("mark")).alias("_asked")).distinct()
    texts = docs.select(F.struct(F.xxhash64(whole_text()).alias("mark"), whole_text().alias("text")).alias("row"))
    # at most SLOTS places go to all tasks, so most texts that nobody asks for stay where they are
    texts = texts.join(F.broadcast(asked), slot(F.col("row.mark")) == F.col("_asked"), "left_semi").select("row.*")
    # copies are dropped before they move
    texts = texts.dropDuplicates(["mark", "text"]).join(by_shuffle(marks), "mark", "left_semi").select("mark", "text")
    return texts.mapInArrow(run, "node long, grams array<long>")


def block_overlaps(head: np.ndarray, grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Overlap counts of one set with the rows of a block: a row of the sparse product.

    ``grams`` holds the rows one behind the other, row i from ``starts[i]`` on;
    none of them is empty.
    """
    at = np.minimum(np.searchsorted(head, grams), len(head) - 1)
    return np.add.reduceat((head[at] == grams).astype(np.int64), starts)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (src, dst) that are as similar as ``percent``.

    The pairs of one ``src`` are cut into blocks of about ``ROWS`` rows.  A block's first
    row brings the set of ``src``; the overlap counts of all others with it are
    added up, and rows with less than the sizes ask for are discarded.
    """
    blocks = pairs.groupBy("src").agg(F.ceil(F.count("*") / ROWS).cast("int").alias("blocks"))
    dealt = pairs.join(blocks, "src").select("src", "dst", F.pmod(F.xxhash64("dst"), F.col("blocks")).cast("int").alias("part"))
    named = by_shuffle(sets.select(F.col("node").alias("_node"), "grams"))
    rows = dealt.join(named, F.col("dst") == F.col("_node")).select("src", "part", "dst", "grams")
    heads = blocks.select("src", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"))
    heads = heads.join(named, F.col("src") == F.col("_node")).select("src", "part", F.lit(None).cast("long").alias("dst"), "grams")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None
        for batch in batches:
            lists = batch.column(3)
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            grams = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            src, dst = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            first = np.flatnonzero(dst.is_null().to_numpy(zero_copy_only=False))
            target = dst.fill_null(0).to_numpy(zero_copy_only=False)
            cuts, keep = [*first.tolist(), batch.num_rows], np.zeros(batch.num_rows, dtype=bool)
            if head is not None:
                cuts = [-1, *cuts]
            for low, high in zip(cuts, cuts[1:]):
                if low >= 0:
                    head = grams[ends[low]:ends[low + 1]].copy()
                if low + 1 < high:
                    a, b = ends[low + 1], ends[high]
                    both = block_overlaps(head, grams[a:b], ends[low + 1:high] - a)
                    sizes = np.diff(ends[low + 1:high + 1])
                    keep[low + 1:high] = 100 * both >= percent * (len(head) + sizes - both)
            yield pa.RecordBatch.from_arrays([pa.array(src[keep]), pa.array(target[keep])], ["src", "dst"])

    every = rows.unionByName(heads).repartition("src", "part").sortWithinPartitions("src", "part", F.col("dst").asc_nulls_first())
    return every.mapInArrow(run, "src long, dst long")


def leading_pairs(members: DataFrame, loose: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Each n-gram's leading set among ``loose`` meets all sets of the n-gram outside its component.

    The lead is the set whose n-grams are the most frequent ones, so of many
    edited copies the text they come from rather than a copy.  Returns pairs
    (src, dst) and the leads' components (key, lead).
    """
    order = F.shiftright("info", 52) * F.lit(1 << 51) + F.col("node").bitwiseAND(F.lit((1 << 51) - 1).cast("long"))
    best = [F.max_by("node", order).alias("lead"), F.max_by("info", order).alias("lead_info"), F.max_by("comp", order).alias("lead_comp")]
    rows = F.count("*").alias("_n")
    if loose is members:
        leads = members.groupBy("key").agg(*best, rows)
    else:
        leads = loose.groupBy("key").agg(*best).join(members.groupBy("key").agg(rows), "key")
    leads = written(leads, "ngram-leads")
    met = attach(members, leads, ["key"]).where("comp <> lead_comp").where(may_meet(F.col("info"), F.col("lead_info"), percent))
    return met.select(F.col("lead").alias("src"), F.col("node").alias("dst")), leads.select("key", "lead")


def with_components(rows: DataFrame, roots: DataFrame) -> DataFrame:
    named = by_shuffle(roots.select(F.col("id").alias("_node"), F.col("component").alias("_comp")))
    out = rows.join(named, F.col("node") == F.col("_node"), "left").withColumn("comp", F.coalesce("_comp", "node"))
    return out.drop("_node", "_comp")


def open_members(members: DataFrame) -> DataFrame:
    """Rows of n-grams whose sets lie in several components."""
    spread = members.groupBy("key").agg(F.count("*").alias("_n"), F.min("comp").alias("_low"), F.max("comp").alias("_high"))
    spread = written(spread.where("_low <> _high").select("key", "_n"), "ngram-open")
    return attach(members, spread, ["key"])


def crossing_pairs(members: DataFrame, nodes: DataFrame, percent: int, crowd: int) -> DataFrame:
    """All pairs (src, dst) of an n-gram in different components that sizes, places and sketches allow.

    An n-gram with more than ``crowd`` sets is dealt over several tasks.  The
    tests stand in the join condition, so other pairs never leave it.
    """
    marks = by_shuffle(nodes.select(F.col("node").alias("_node"), "size", *[f"s{i}" for i in range(LONGS)]))
    sizes = written(members.groupBy("key").agg(F.count("*").alias("_n"), F.ceil(F.count("*") / crowd).cast("int").alias("blocks")), "ngram-crowds")
    full = attach(members, sizes, ["key"])
    full = written(full.join(marks, F.col("node") == F.col("_node")).drop("_node"), "ngram-marked")
    a = full.withColumn("part", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).alias("a")
    b = full.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).alias("b")
    meets = (F.col("a.key") == F.col("b.key")) & (F.col("a.part") == F.col("b.part")) & (F.col("a.node") < F.col("b.node"))
    meets = meets & (F.col("a.comp") != F.col("b.comp")) & may_meet(F.col("a.info"), F.col("b.info"), percent) & sketches_allow("a", "b", percent)
    return a.join(b, meets).select(F.col("a.node").alias("src"), F.col("b.node").alias("dst")).distinct()


def similar_links(docs: DataFrame, nodes: DataFrame, entries: DataFrame, words: int, percent: int, clashes: set[int], rounds: int, crowd: int) -> DataFrame:
    """Links (src, dst) that give the components of all sets as similar as ``percent``.

    In each round one leading set per n-gram meets the others; what is found tied is one
    component from then on.  Then all sets of an n-gram that still lie in
    different components meet.  Pairs inside a component are left out: they
    add nothing to it.
    """
    members = written(shared_entries(entries), "ngram-shared")
    loose = members = members.withColumn("comp", F.col("node"))
    links = None
    for turn in range(rounds + 1):
        if turn < rounds:
            pairs, leads = leading_pairs(members, loose, percent)
            pairs = written(possible(pairs, nodes, percent), "ngram-pairs")
        else:
            pairs = written(crossing_pairs(members, nodes, percent, crowd), "ngram-pairs")
            if pairs.isEmpty():
                break
        asked = pairs.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
        asked = written(nodes.select("node", "mark").join(by_shuffle(asked), "node", "left_semi").select("mark"), "ngram-asked")
        sets = written(ngram_sets(docs, asked, words, clashes), "ngram-sets")
        found = written(verified(pairs, sets, percent), "ngram-links")
        forget(sets)
        links = found if links is None else links.unionAll(found)
        if turn < rounds:
            members = written(open_members(with_components(members.drop("comp"), component_roots(links))), "ngram-members")
            if members.isEmpty():
                break
            # sets tied to the lead have met it; the next lead is one of the others
            own = members.select("key", "node", "comp")
            tied = leads.join(own, (leads["key"] == own["key"]) & (leads["lead"] == own["node"])).select(own["key"].alias("_key"), own["comp"].alias("_comp"))
            loose = members.join(tied, (F.col("key") == F.col("_key")) & (F.col("comp") == F.col("_comp")), "left_anti")
    return links


def jaccard_groups(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, rounds: int = ROUNDS, crowd: int = CROWD
) -> DataFrame:
    """One row per input row: doc_id, n_shingles and component_id.

    A text's set holds the distinct runs of ``words`` words (A-Z lower-cased,
    parted by ASCII white space); fewer words are one run.  Texts are linked
    when they share ``similarity`` of the union of their sets (whole
    per cent; compared in integers).  ``component_id`` is the smallest doc_id
    that links lead to.  Equal sets are one row of the product, so copies are
    never paired, and no link between different sets is lost: see
    :func:`prefix_entries` and :func:`similar_links`.

    Null and empty texts have no set and are linked with nothing, not even with each other.  Null
    ids belong to a group and never name it, unless all are null.  Repeated
    rows carry the same answer.  Very long texts are whole sets.  An empty
    table gives no rows; further columns are not looked at.
    """
    percent = round(100 * similarity)
    rows = written(set_marks(docs, words), "ngram-marks")
    counts = slot_counts(rows)
    longs = [f"s{i}" for i in range(LONGS)]
    marks = rows.where("block is null").select("doc_id", "mark", "h1", "h2", "size", *longs)
    nodes = written(marks.where("size > 0").groupBy("h1", "h2").agg(
        F.count("*").alias("_n"), F.min("doc_id").alias("low"), F.min("mark").alias("mark"), F.min("size").alias("size"), *[F.min(s).alias(s) for s in longs]
    ), "ngram-halves")
    # two sets with one first half are expected once in billions of sets
    clashes = {r["h1"] for r in nodes.groupBy("h1").count().where("count > 1").select("h1").collect()}
    node = F.when(F.col("h1").isin(*clashes), F.col("h2")).otherwise(F.col("h1")) if clashes else F.col("h1")
    nodes = nodes.withColumn("node", node)
    # a part of a crowded n-gram has a few thousand sets, besides what chance puts on each slot
    entries = prefix_entries(docs, words, percent, counts, clashes, 4 * crowd + 4 * int(counts.astype(np.int64).sum() // SLOTS))
    links = similar_links(docs, nodes, entries, words, percent, clashes, rounds, crowd)
    roots = component_roots(links)
    grouped = with_components(nodes.select("node", "h1", "h2", "low", "_n"), roots)
    names = written(grouped.groupBy("comp").agg(F.min("low").alias("component_id"), F.count("*").alias("_n")), "ngram-names")
    named = attach(grouped.drop("_n"), names, ["comp"]).select("h1", "h2", "component_id")
    sizes = nodes.select("h1", "h2", "_n")
    named = written(named.join(sizes, ["h1", "h2"]), "ngram-classes")
    some = attach(marks.where("size > 0").select("doc_id", "size", "h1", "h2"), named, ["h1", "h2"])
    none = marks.where("size = 0").select("doc_id", "size", F.col("doc_id").alias("component_id"))
    return some.select("doc_id", "size", "component_id").unionAll(none).withColumnRenamed("size", "n_shingles")
