"""Byte-pair encoding against tiktoken, and language model scores."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from heronlake.llm import bpe, catalog, gru, lm
from heronlake.sources.views import Tables
from tests.llm.fixtures import empty_docs, odd_docs, odd_rows, plain_docs, prose

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(PATH, PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def odd_texts():
    rng = random.Random(1)
    texts = [
        "", " ", "a" * 5000, " " * 3000, "ab" * 2000, "日本語" * 500, "".join(rng.choice("ACGT") for _ in range(3000)), "1" * 900, "!?" * 900,
        "\x1c\x1d \x85x y", "\x00", "don't we'll I'M", "  x   \n\n y\t", "𝒳𝒴🎉", "<|endoftext|>", "é" * 777,
    ]
    kinds = [lambda: rng.randrange(0x20, 0x7F), lambda: rng.randrange(1, 0x300), lambda: rng.randrange(0x2000, 0x2070), lambda: rng.randrange(0x1F300, 0x1F700)]
    return texts + ["".join(chr(rng.choice(kinds)()) for _ in range(rng.randrange(1, 90))) for _ in range(150)]


def test_ids_equal_the_library(codec, library):
    texts = odd_texts()
    ids = codec.encode(texts)
    assert [x.tolist() for x in ids] == [library.encode_ordinary(t) for t in texts]
    assert [b.decode() for b in codec.decode(ids)] == texts


def test_decoding_in_bounded_pieces(codec, monkeypatch):
    """A statement gets a bounded number of ids, so a session's memory does not follow the texts of a batch."""
    sizes, store = [], codec._table
    monkeypatch.setattr(bpe, "IDS", 700, raising=False)
    monkeypatch.setattr(codec, "_table", lambda name, columns: (sizes.append((name, len(columns["id"]))) if name == "tokens" else None, store(name, columns)))
    texts = odd_texts()
    ids = codec.encode(texts)
    assert [b.decode() for b in codec.decode(ids)] == texts
    assert sum(n for _, n in sizes) == sum(map(len, ids)) > 2_100 and max(n for _, n in sizes) <= 700


@pytest.mark.parametrize("limit", [0, 10_000])
def test_both_statements_agree(codec, library, limit, monkeypatch):
    monkeypatch.setattr(bpe, "LONG", limit)
    monkeypatch.setattr(codec, "known", {})
    words = {"".join(random.Random(i).choice("aabcdeé") for _ in range(i % 37 + 1)) for i in range(300)}
    codec.learn(words)
    for w in words:
        assert np.frombuffer(codec.known[w], "<u4").tolist() == [i for part in codec.split(w) for i in library.encode_ordinary(part)] or len(codec.split(w)) > 1


def test_round_trip_of_odd_rows(spark, library):
    got = bpe.token_digest(bpe.round_trip(odd_docs(spark), PATH, PATTERN)).collect()
    want = []
    for i, t, *_ in odd_rows():
        ids = library.encode_ordinary(t or "")
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        want.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.round_trip(empty_docs(spark), PATH, PATTERN).collect() == []


def test_encoding_and_decoding_as_columns(spark, library):
    coded = bpe.encode_texts(odd_docs(spark), PATH, PATTERN)
    back = bpe.decode_ids(coded, PATH, PATTERN).collect()
    assert sorted(bytes(r["decoded"]).decode() for r in back) == sorted(r[1] or "" for r in odd_rows())
    assert {r["doc_id"]: r["ids"] for r in back}[7] == library.encode_ordinary("one TWO three.")
    odd = spark.createDataFrame([(1, None), (2, []), (3, [99_999])], "doc_id long, ids array<int>")
    assert [bytes(r["decoded"]) for r in bpe.decode_ids(odd, PATH, PATTERN).collect()] == [b"", b"", b""]


def test_words_are_looked_up_together():
    """Keys and places of many words at once are those of each word by itself; a full memory starts again."""
    words = {bytes([97 + i % 26]) * (1 + i // 26) for i in range(300)} | {"é".encode(), b"\xff"}
    plain = {w: (xxhash.xxh64_intdigest(w) & ~15) | (w[-1] & 15) for w in words}
    plain = {w: k - (1 << 64) if k >> 63 else k for w, k in plain.items()}
    keys = lm.word_keys(sorted(words))
    assert keys.tolist() == [plain[w] for w in sorted(words)]
    for table, most in ((keys[::3], 400_000), (keys[:0], 400_000), (keys[::-1], 10)):
        known, place = lm.Words(table, most), {int(k): lm.LOWEST + i for i, k in enumerate(table)}
        for part in (set(sorted(words)[:100]), words, set()):
            known.learn(part)
            assert all(known[w] == place.get(plain[w], plain[w]) for w in part)
        assert len(known) == (len(words) if most > 10 else 0)


def made_documents(count=400):
    """Two kinds of text, each with frequent words of its own: a network can tell them apart."""
    rng, rows = random.Random(6), []
    for i in range(count):
        words = [f"{'ab'[i % 2]}{rng.randrange(12)}" for _ in range(rng.randrange(0, 120))]
        rows.append((i, " ".join(words + [prose(rng, 1)]), "en", "s"))
    return rows


def plain_base(rows):
    seen, texts = Counter(), 0
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    cut = lambda t: (t or "").encode().lower().split() + [None]
    for i, t, *_ in rows:
        if not held(i):
            seen.update(cut(t))
            texts += 1
    total, kinds = sum(seen.values()), len(seen)
    return [
        (i, held(i), len(cut(t)), sum(seen[w] > 0 for w in cut(t)), total,
         sum(math.log10((seen[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in cut(t)))
        for i, t, *_ in rows
    ]


@pytest.mark.parametrize("table", [lm.TABLE, 8, 0])
def test_base_scores_equal_brute_force(spark, table):
    rows = odd_rows() + made_documents(60)
    docs = plain_docs(spark, [(r[0], r[1], "en", "s") for r in rows]).repartition(3)
    got = sorted((tuple(r)[:6] for r in lm.score_texts(docs, table_words=table).collect()), key=str)
    want = sorted(plain_base(rows), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) for g, w in zip(got, want))


def test_training_helps_on_texts_it_has_not_seen(spark):
    """The query's own parameters over several partitions, against single words and the untrained network."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(4)
    got = [r for r in lm.score_texts(docs).collect() if r["held_out"]]
    tokens = sum(r["n_tokens"] for r in got)
    base, model = (sum(r[c] for r in got) / tokens for c in ("base_score", "score"))
    untrained = [r for r in lm.score_texts(docs, rounds=0).collect() if r["held_out"]]
    before = sum(r["score"] for r in untrained) / tokens
    assert abs(before - base) < 0.01
    assert model > before + 0.05 and model > base + 0.05, (model, before, base)


def test_scores_are_probabilities(spark, monkeypatch):
    """Classes, words within classes and words within tails, unseen ones included, add up to one."""
    monkeypatch.setattr(lm, "OWN", 70)
    learn = plain_docs(spark, made_documents(40) + [(1000 + i, prose(random.Random(i), 80), "en", "s") for i in range(20)])
    table = lm.frequent_words(lm.word_counts(learn), 120)
    layout = table.layout
    assert layout.words == 70 and layout.groups == 2
    rng = np.random.default_rng(1)
    flat = layout.start(table.start) + rng.normal(0, 0.3, len(layout.start(table.start))).astype(np.float32)
    model = gru.Model(flat, layout)
    state = rng.normal(0, 0.5, (1, layout.symbols, gru.HIDDEN)).astype(np.float32)
    state[:] = state[:, :1]
    shares = np.exp(model.log_shares(state, np.arange(layout.symbols, dtype=np.int16)[None]))
    assert math.isclose(shares.sum(), 1, rel_tol=1e-5)
    tails = np.zeros(lm.TAILS)
    np.add.at(tails, (table.keys & 15)[table.own:], 10 ** table.inside[table.own:])
    rest = {r["tail"]: r["n"] for r in lm.word_counts(learn).where("key is not null").where(~F.col("key").isin(*table.keys.tolist())).select(
        F.expr("cast(key & 15 as int)").alias("tail"), F.expr("log10(n + 0.1D)").alias("n")).groupBy("tail").agg(F.sum(F.expr("pow(10D, n)")).alias("n")).collect()}
    for tail, n in rest.items():
        tails[tail] += n / 10 ** table.below[tail]
    assert np.allclose(tails + 0.1 / 10**table.below, 1)


def test_gradient_and_packing():
    rng = np.random.default_rng(0)
    layout = gru.Layout(70, 3)
    docs = [np.append(rng.integers(0, layout.symbols - 1, size=n), layout.symbols - 1).astype(np.int16) for n in (0, 3, 40, 77, 5)]
    flat = layout.start(rng.integers(1, 50, layout.symbols))
    flat[np.abs(flat) < 100] += rng.normal(0, 0.1, int((np.abs(flat) < 100).sum())).astype(np.float32)
    x, y, fresh, _, live = next(gru.windows(docs, layout.symbols - 1))
    zero = np.zeros((x.shape[1], gru.HIDDEN), dtype=np.float32)

    def loss(parameters):
        model = gru.Model(parameters, layout)
        states, _, _ = model.forward(zero, x, fresh)
        return -(model.log_shares(states, y) * live).sum() / live.sum()

    model = gru.Model(flat, layout)
    states, kept, _ = model.forward(zero, x, fresh)
    grad = model.gradient(x, y, fresh, live, states, kept)
    ends = np.cumsum([int(np.prod(shape)) for shape in layout.shapes.values()])
    for low, high in zip([0, *ends[:-1]], ends):
        # the largest entries of each part, and some at random
        top = low + np.argsort(-np.abs(grad[low:high]))[:4]
        for i in [*top, *rng.integers(low, high, 4)]:
            step = np.zeros_like(flat)
            step[i] = 1e-2
            assert abs((loss(flat + step) - loss(flat - step)) / 2e-2 - grad[i]) < 3e-4
    # documents side by side score as each by itself, over many windows
    packed = gru.score(flat, layout, docs)
    assert np.allclose(packed, [gru.score(flat, layout, [d])[0] for d in docs], atol=1e-3)


def test_query_returns_the_contract_columns(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    rows = [(r["doc_id"], r["text"]) for r in t.documents.collect()]
    found = catalog.QUERIES["op10_lm_score"](t)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got, want = sorted(map(tuple, found.collect())), sorted(plain_base(rows))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(math.isclose(g[5], w[5], rel_tol=1e-9) and g[6] < 0 for g, w in zip(got, want))


def test_empty_tables(spark):
    assert lm.score_texts(empty_docs(spark)).collect() == []
    lone = lm.score_texts(plain_docs(spark, [(None, "a b", "en", "s")])).collect()
    assert [(r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in lone] == [(True, 3, 0, 0, 0.0)]
