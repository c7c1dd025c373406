"""Scoring texts by a recurrent language model with a softmax over classes and one over the words of a class."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from heronlake.llm import gru
from heronlake.llm.common import slices, whole_text, written

# Fixed values.  The most frequent words, at most TABLE, are known in every task
# (a bounded table); the first OWN of them are symbols of the network.  All
# other words go by the last four bits of their last byte into TAILS symbols, and the
# end of a text is the last symbol.
TABLE, OWN, TAILS = 1 << 17, 2048, 16
ADD = 0.1
# Longs from the lowest on, as many as a table may have words, are places in it.
LOWEST, ROOM = -(1 << 63), 1 << 20
# Bytes of text and of symbols that are worked on together.
PIECE, TOKENS = 4 << 20, 8 << 20


def word_keys(words: list[bytes]) -> np.ndarray:
    """Per word 60 bits of its hash and the class bits of its last byte."""
    from xxhash import xxh64_intdigest

    size = len(words)
    hashes = np.fromiter(map(xxh64_intdigest, words), dtype=np.uint64, count=size).view(np.int64)
    keys = (hashes & ~15) | np.fromiter((w[-1] for w in words), dtype=np.int64, count=size) & 15
    # the lowest longs stand for places in the table
    return np.where(keys < LOWEST + ROOM, keys ^ (1 << 62), keys)


def words_of(text: str) -> list[bytes]:
    """A-Z lower-cased, parted by ASCII white space."""
    return text.encode("utf-8", "replace").lower().split()


def held_out() -> Column:
    """Whether the CRC-32 of the id as text divides by ten; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).cast("binary")) % 10 == 0


class Words(dict):
    """Word to ``LOWEST`` and its place in the table, or to its key; filled as words are met."""

    def __init__(self, keys: np.ndarray, most: int = 400_000):
        super().__init__()
        self.order, self.most = np.argsort(keys), most
        self.sorted = keys[self.order]

    def learn(self, words: set[bytes]) -> None:
        """Look up all words that are not known yet together."""
        if len(self) > self.most:
            self.clear()
        new = list(words.difference(self))
        keys = word_keys(new)
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, keys), len(self.sorted) - 1)
            keys = np.where(self.sorted[at] == keys, LOWEST + self.order[at], keys)
        self.update(zip(new, keys.tolist()))


class Table:
    """The frequent words with their symbols and log shares, small enough for every task."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, tails: dict[int, tuple[int, int]], docs: int):
        self.keys, self.counts = keys, counts
        words, kinds = int(counts.sum()) + sum(n for n, _ in tails.values()), len(keys) + sum(v for _, v in tails.values())
        self.tokens, self.kinds, self.docs = words + docs, kinds + (docs > 0), docs
        self.own = min(OWN, len(keys))
        self.layout = gru.Layout(self.own, TAILS + 1)
        # symbols of the words of the table; one more entry, so that an empty table can be read
        tail_of = (keys & 15).astype(np.int64)
        symbols = np.where(np.arange(len(keys)) < self.own, np.arange(len(keys)), self.own + tail_of)
        self.symbol_of = np.append(symbols, 0).astype(np.int16)
        mass, size = np.zeros(TAILS), np.zeros(TAILS)
        np.add.at(mass, tail_of[self.own:], counts[self.own:])
        np.add.at(size, tail_of[self.own:], 1)
        for tail, (n, v) in tails.items():
            mass[tail] += n
            size[tail] += v
        self.below = np.log10(mass + ADD * (size + 1))
        self.start = np.concatenate([counts[:self.own], mass, [docs]])
        self.whole = math.log10(self.tokens + ADD * (self.kinds + 1))
        self.base = np.log10(counts + ADD) - self.whole
        # the network gives its own words whole; the others come with their share of the tail
        self.inside = np.where(np.arange(len(keys)) < self.own, 0.0, np.log10(counts + ADD) - self.below[tail_of])

    def cut(self, words: list[bytes], cache: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the words outside the table, places of the others, and the symbols of all tokens with the end."""
        codes = np.fromiter(map(cache.__getitem__, words), dtype=np.int64, count=len(words))
        inside = codes < LOWEST + ROOM
        places, others = codes[inside] & (ROOM - 1), codes[~inside]
        symbols = np.full(len(words) + 1, self.layout.symbols - 1, dtype=np.int16)
        symbols[:-1][inside] = self.symbol_of[places]
        symbols[:-1][~inside] = self.own + (others & 15)
        return others, places, symbols


def word_counts(docs: DataFrame) -> DataFrame:
    """(key, n) over all words of the documents; the null key counts the texts."""
    source = docs.select(whole_text().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, PIECE):
                seen: Counter = Counter()
                for text in part.column(0).to_pylist():
                    seen.update(words_of(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None, *word_keys(list(seen)).tolist()], pa.int64()), pa.array([part.num_rows, *seen.values()], pa.int64())], ["key", "n"]
                )

    # counted inside the tasks first, then by key
    return source.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int = TABLE) -> Table:
    """The most frequent words, at most ``most``, and what the others come to per tail.

    A histogram of counts, sixteen bins to each doubling, gives the lowest bin
    from which on there are few enough words; only those words reach the
    driver, and nothing is sorted.
    """
    words, step = counts.where("key is not null"), F.floor(F.log2("n") * 16).cast("int")
    bins = {r["bin"]: r["count"] for r in words.groupBy(step.alias("bin")).count().collect()}
    room, lowest = most, max(bins, default=0) + 1
    for bin_ in sorted(bins, reverse=True):
        room -= bins[bin_]
        if room < 0:
            break
        lowest = bin_
    top = words.where(step >= lowest).toPandas().sort_values(["n", "key"], ascending=[False, True])
    keys, n = top["key"].to_numpy(dtype=np.int64), top["n"].to_numpy(dtype=np.int64)
    sums = counts.groupBy(F.col("key").bitwiseAND(F.lit(15).cast("long")).alias("tail")).agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    totals = {r["tail"]: (r["n"], r["v"]) for r in sums.collect()}
    docs = totals.pop(None, (0, 0))[0]
    tails = {}
    for tail, (total, kinds) in totals.items():
        own = (keys & 15) == tail
        tails[tail] = (total - int(n[own].sum()), kinds - int(own.sum()))
    return Table(keys, n, tails, docs)


def cut_texts(docs: DataFrame, table: Table) -> DataFrame:
    """Per document what the frequent words give, its other words and its symbols.

    doc_id, text_key, n_tokens; ``known``, ``base`` and ``inside`` (log10
    shares within their tails) of the frequent words; ``rare`` (key, n);
    ``symbols``, two bytes per token with the end.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table)
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole_text()).alias("text_key"), whole_text().alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        cache = Words(own.keys)
        for batch in batches:
            for part in slices(batch, 2, PIECE):
                sizes, known, base, inside, symbols, keys, times, ends = [], [], [], [], [], [], [], [0]
                texts = [words_of(text) for text in part.column(2).to_pylist()]
                cache.learn(set().union(*texts))
                for words in texts:
                    others, top, kinds = own.cut(words, cache)
                    sizes.append(len(kinds))
                    known.append(len(top))
                    base.append(float(own.base[top].sum()))
                    inside.append(float(own.inside[top].sum()))
                    names, counts = np.unique(others, return_counts=True)
                    keys.append(names)
                    times.append(counts)
                    ends.append(ends[-1] + len(names))
                    symbols.append(kinds.tobytes())
                pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(times).astype(np.int64))], ["key", "n"])
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(known, pa.int64()),
                    pa.array(base, pa.float64()), pa.array(inside, pa.float64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs), pa.array(symbols, pa.binary()),
                ], ["doc_id", "text_key", "n_tokens", "known", "base", "inside", "rare", "symbols"])

    return source.mapInArrow(
        run,
        "doc_id long, text_key long, n_tokens long, known long, base double, inside double, "
        "rare array<struct<key: long, n: long>>, symbols binary",
    )


def train_model(texts: DataFrame, table: Table, rounds: int = 1) -> np.ndarray:
    """Parameters of the network, learnt from the ``symbols`` of all texts given.

    In a round every task runs over the whole documents of its partition, all
    windows, from the same parameters; what the tasks end with is averaged by
    tokens.  Averages are taken in about the square root of the number of
    tasks first and then in eight, so the driver gets few vectors however
    large the input is.
    """
    layout, source = table.layout, texts.select("symbols")
    flat = layout.start(table.start)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, tokens = None, 0
        for batch in batches:
            for v, n in zip(batch.column(0), batch.column(1)):
                own = np.frombuffer(v.as_buffer(), dtype=np.float64)
                total, tokens = own.copy() if total is None else total + own, tokens + n.as_py()
        if tokens:
            yield _vector(total, tokens)

    for _ in range(rounds):
        now = flat

        def run(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            after, moments, tokens = now, None, 0
            for batch in batches:
                for part in slices(batch, 0, TOKENS):
                    rows = [np.frombuffer(c, dtype=np.int16) for c in part.column(0).to_pylist()]
                    after, moments = gru.train(after, layout, rows, moments)
                    tokens += sum(map(len, rows))
            if tokens:
                yield _vector(after.astype(np.float64) * tokens, tokens)

        kind = "v binary, n long"
        ends = written(source.mapInArrow(run, kind), "lm-parameters")
        parts = max(1, math.isqrt(ends.count()))
        sums = ends.repartition(parts).mapInArrow(add, kind).repartition(min(parts, 8)).mapInArrow(add, kind).collect()
        if sums:
            total = reduce(np.add, [np.frombuffer(r["v"], dtype=np.float64) for r in sums]) / sum(r["n"] for r in sums)
            # rounded, so that the order of adding does not show
            flat = np.round(total, 5).astype(np.float32)
    return flat


def score_symbols(texts: DataFrame, table: Table, flat: np.ndarray) -> DataFrame:
    """doc_id, text_key, n_tokens, known, base and ``model``: log10 probability of the
    symbols of the whole text, and of the frequent words among the tails."""
    columns = ["doc_id", "text_key", "n_tokens", "known", "base"]
    shared = texts.sparkSession.sparkContext.broadcast((flat, table.layout))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, layout = shared.value
        for batch in batches:
            for part in slices(batch, 6, TOKENS):
                rows = [np.frombuffer(c, dtype=np.int16) for c in part.column(6).to_pylist()]
                model = gru.score(flat, layout, rows) + part.column(5).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(5)], pa.array(model, pa.float64())], [*columns, "model"])

    return texts.select(*columns, "inside", "symbols").mapInArrow(
        run, "doc_id long, text_key long, n_tokens long, known long, base double, model double"
    )


def _vector(v: np.ndarray, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()), pa.array([n], pa.int64())], ["v", "n"])


def score_texts(docs: DataFrame, rounds: int = 1, table_words: int = TABLE) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Texts are lower-cased (A-Z), cut at ASCII white space and closed by an end
    token.  The model learns from documents that are not held out.
    ``base_score`` adds up the smoothed log10 shares of the tokens.  ``score``
    is the model's log10 probability: a gated recurrent network, its state
    carried over the whole text, gives each token's class and, for the 2,048
    most frequent words, the word within its class by a second softmax on the
    state.  Other words, unseen ones included, are told within their tail
    class by corpus counts.  Both scores use the counts of every training word; the
    frequent ones are at hand in each task, the others are joined by key and
    added up per document.

    Words are told apart by 60 bits of their hash and four of their last byte.
    Null and empty texts are an end token.  A null id is held out.  Rows that
    repeat id and text come back as often, scored alike.  An empty table gives
    no rows; without training documents all counts are zero.  Further columns
    are not looked at.
    """
    learn = docs.where(~held_out())
    counts = written(word_counts(learn), "lm-counts")
    table = frequent_words(counts, table_words)
    texts = written(cut_texts(docs, table), "lm-texts")
    flat = train_model(texts.where(~held_out()), table, rounds)
    found = score_symbols(texts, table, flat)

    rare = texts.select("doc_id", "text_key", F.explode("rare").alias("r")).select("doc_id", "text_key", "r.key", F.col("r.n").alias("times"))
    joined = rare.join(counts.where("key is not null"), "key", "left")
    seen = F.coalesce("n", F.lit(0))
    size = F.log10(seen + F.lit(ADD))
    tail = F.col("key").bitwiseAND(F.lit(15).cast("long")).cast("int")
    below = F.element_at(F.array(*[F.lit(float(x)) for x in table.below]), tail + 1)
    sums = joined.select(
        "doc_id", "text_key", F.when(seen > 0, F.col("times")).otherwise(0).alias("known"),
        ((size - F.lit(table.whole)) * F.col("times")).alias("base"), ((size - below) * F.col("times")).alias("model"),
    ).groupBy("doc_id", "text_key").agg(F.sum("known").alias("_known"), F.sum("base").alias("_base"), F.sum("model").alias("_model"))
    # repeated rows were added up together: each takes its share
    end_known, end_base = int(table.docs > 0), math.log10(table.docs + ADD) - table.whole
    plain = found.groupBy("doc_id", "text_key").agg(
        F.count("*").alias("rows"), F.min("n_tokens").alias("n_tokens"), F.min("known").alias("known"), F.min("base").alias("base"),
        F.min("model").alias("model"),
    )
    named = sums.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"), "_known", "_base", "_model")
    both = plain.join(named, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_text")), "left")
    share = lambda c: F.coalesce(F.col(c), F.lit(0)) / F.col("rows")
    out = both.select(
        "doc_id", held_out().alias("held_out"), "n_tokens",
        (F.col("known") + share("_known") + end_known).cast("long").alias("n_known"),
        F.lit(table.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + share("_base") + end_base).alias("base_score"), (F.col("model") + share("_model")).alias("score"),
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("_copy"),
    )
    return out.drop("_copy")
