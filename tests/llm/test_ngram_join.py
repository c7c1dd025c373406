"""The n-gram join against comparing all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from heronlake.llm import catalog, ngram_join
from heronlake.sources.views import Tables
from tests.llm.fixtures import empty_docs, odd_docs, odd_rows, plain_docs, prose

SMALL = "/root/testdata/sf0.001"


def plain_set(text, k=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def plain_groups(rows):
    """(doc_id, size, component) by all pairs of distinct sets."""
    sets = [frozenset(plain_set(t)) for _, t in rows]
    kinds = {s: i for i, s in enumerate(dict.fromkeys(s for s in sets if s))}
    order, root = list(kinds), list(range(len(kinds)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(order):
        for j in range(i):
            both = len(a & order[j])
            if 100 * both >= 80 * (len(a) + len(order[j]) - both):
                root[top(i)] = top(j)
    names = {}
    for (doc, _), s in zip(rows, sets):
        if s and doc is not None:
            names[top(kinds[s])] = min(doc, names.get(top(kinds[s]), doc))
    return sorted(((doc, len(s), names.get(top(kinds[s])) if s else doc) for (doc, _), s in zip(rows, sets)), key=str)


def groups(docs, **more):
    return sorted((tuple(r) for r in ngram_join.jaccard_groups(docs, **more).collect()), key=str)


def edited(rng, words, edits, low=0):
    own = list(words)
    for at in rng.sample(range(low, len(own)), edits):
        own[at] = f"x{rng.randrange(10**9)}"
    return " ".join(own)


def fresh(rng, n):
    return [f"w{rng.randrange(10**9)}" for _ in range(n)]


def near_rows():
    rng, rows = random.Random(2), []
    for base in range(6):
        words = prose(rng, 200).split()
        for copy in range(10):
            own = edited(rng, words, rng.choice([0, 1, 2, 3, 4, 6, 9, 30]))
            rows.append((base * 100 + copy, own.upper() if copy % 4 == 0 else own))
    return rows + [(900 + i, prose(rng, rng.randrange(1, 60))) for i in range(40)]


@pytest.mark.parametrize("more", [{}, {"rounds": 0, "crowd": 2}, {"rounds": 2, "crowd": 3}])
def test_components_equal_all_pairs(spark, more):
    rows = near_rows() + [r[:2] for r in odd_rows()]
    docs = plain_docs(spark, [(*r, "en", "s") for r in rows])
    assert groups(docs, **more) == plain_groups(rows)


def test_edited_copies_hang_together_by_their_original(spark):
    """Copies are below 0.8 to each other; the original is the smallest of none of them."""
    rng = random.Random(5)
    original = fresh(rng, 300)
    texts = [edited(rng, original, 5, 5) for _ in range(150)]
    texts.insert(70, " ".join(original))
    rows = list(enumerate(texts))
    want = plain_groups(rows)
    assert {r[2] for r in want} == {0}
    assert groups(plain_docs(spark, [(*r, "en", "s") for r in rows])) == want


def test_one_line_in_all_texts_and_crowded_groups(spark):
    rng, texts = random.Random(6), []
    for _ in range(25):
        base = fresh(rng, 60)
        texts += [" ".join(["one line that all the texts have", edited(rng, base, 1, 5)]) for _ in range(4)]
    texts += [f"a a a a {i % 7} b c d e f" for i in range(40)]
    rows = list(enumerate(texts))
    for crowd in (3, 1024):
        assert groups(plain_docs(spark, [(*r, "en", "s") for r in rows]), crowd=crowd) == plain_groups(rows)


def test_pairs_at_the_bound(spark):
    """Exactly 80 of 100 shingles in common are linked, one less is not."""
    rng, rows = random.Random(9), []
    for i, gone in enumerate([20, 21, 19] * 3):
        a = fresh(rng, 94)
        # both have 90 shingles less ``gone / 2`` of their own
        b = a[gone // 2:] + fresh(rng, gone - gone // 2)
        rows += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(b))]
    assert groups(plain_docs(spark, [(*r, "en", "s") for r in rows])) == plain_groups(rows)


def test_clashing_halves_of_hashes_are_told_apart(spark, monkeypatch):
    """Where the first halves of set hashes clash, the second halves name the sets."""
    rows = near_rows()[:40]
    clash = {3}
    assert ngram_join.node_of(3, 4, clash) == 4 and ngram_join.node_of(5, 4, clash) == 5
    docs = plain_docs(spark, [(*r, "en", "s") for r in rows])
    nodes = ngram_join.set_marks(docs, 5).where("block is null").select("h1").distinct().limit(20)
    known = {r["h1"] for r in nodes.collect()}
    plain = ngram_join.node_of
    monkeypatch.setattr(ngram_join, "node_of", lambda h1, h2, clashes: plain(h1, h2, known))
    entries = ngram_join.prefix_entries(docs, 5, 80, np.zeros(ngram_join.SLOTS, dtype=np.int32), known, 1024)
    assert not {r["node"] for r in entries.select("node").distinct().collect()} & known


def test_odd_and_empty_tables(spark):
    docs = odd_docs(spark)
    assert groups(docs) == plain_groups([r[:2] for r in odd_rows()])
    clashing = docs.withColumns({c: F.lit(1) for c in ("node", "key", "h1", "mark", "_node", "_n", "component_id", "row")})
    assert groups(clashing) == groups(docs)
    assert groups(empty_docs(spark)) == []


def test_block_product_counts_overlaps():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, size).astype(np.uint64)) for size in (1, 5, 30, 60, 80)]
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    for head in sets:
        assert ngram_join.block_overlaps(head, np.concatenate(sets), starts).tolist() == [len(np.intersect1d(head, s)) for s in sets]


def test_query_equals_brute_force(spark):
    t = Tables(spark, SMALL)
    rows = [(r["doc_id"], r["text"]) for r in t.documents.collect()]
    found = catalog.QUERIES["op11_ngram_join"](t)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, found.collect()), key=str) == plain_groups(rows)
