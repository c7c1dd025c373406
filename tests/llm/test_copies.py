"""Exact and near copies against brute force."""

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from heronlake.llm import catalog, exact_dedup, simhash
from heronlake.sources.views import Tables
from tests.llm.fixtures import empty_docs, odd_docs, odd_rows, plain_docs, prose


def plain_groups(rows, keep):
    out = []
    for i, t, *_ in rows:
        ids = [r[0] for r in rows if (r[1] or "") == (t or "")]
        known = [x for x in ids if x is not None]
        best = (max if keep == "max" else min)(known) if known else None
        out.append((i, best, len(ids), i == best, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("keep", ["min", "max"])
def test_groups_of_odd_rows(spark, keep):
    got = exact_dedup.exact_groups(odd_docs(spark), keep).collect()
    assert sorted(map(tuple, got), key=str) == plain_groups(odd_rows(), keep)


def test_colliding_hashes_are_split_by_bytes(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("abcdefgh") * rng.randrange(1, 3), "en", "s") for i in range(200)]
    weak = lambda text: F.substring(F.md5(text), 1, 1).cast("binary")
    got = exact_dedup.exact_groups(plain_docs(spark, rows), "max", weak).collect()
    assert sorted(map(tuple, got), key=str) == plain_groups(rows, "max")


def test_dropping_copies_keeps_columns(spark):
    docs = odd_docs(spark)
    got = exact_dedup.drop_exact_copies(docs)
    assert got.schema == docs.schema
    texts = [r["text"] or "" for r in got.collect()]
    assert sorted(texts) == sorted({r[1] or "" for r in odd_rows()})
    assert {r["doc_id"] for r in got.collect()} >= {1, 4, 5, 7}
    assert exact_dedup.drop_exact_copies(empty_docs(spark)).collect() == []


def plain_print(text, k=3):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, linked):
    root = list(range(len(ids)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    names = {}
    for i, doc in enumerate(ids):
        if doc is not None:
            names[top(i)] = min(doc, names.get(top(i), doc))
    return [names.get(top(i)) for i in range(len(ids))]


def near_rows():
    rng = random.Random(2)
    rows = []
    for base in range(6):
        words = prose(rng, 300).split()
        for copy in range(12):
            own = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6, 20, 60])):
                own[rng.randrange(len(own))] = prose(rng, 1)
            rows.append((base * 100 + copy, " ".join(own).upper() if copy % 4 == 0 else "  ".join(own), "en", "s"))
    rows += [(900 + i, prose(rng, rng.randrange(1, 200)), "en", "s") for i in range(60)]
    return rows


@pytest.mark.parametrize("dense", [1000, 1])
def test_links_of_three_bits_equal_all_pairs(spark, dense):
    rows = near_rows() + [r[:2] for r in odd_rows()]
    prints = [plain_print(r[1]) for r in rows]
    want = components([r[0] for r in rows], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    docs = plain_docs(spark, [(r[0], r[1], "en", "s") for r in rows])
    got = simhash.near_groups(docs, dense=dense).collect()
    assert sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got), key=str) == sorted(
        zip([r[0] for r in rows], prints, want), key=str
    )


def kept_rows(rows):
    """Of every group of fingerprints the row with the smallest id, then text hash."""
    prints = [plain_print(r[1]) for r in rows]
    group = components(list(range(len(rows))), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    kept = {}
    for r, g in zip(rows, group):
        sha = hashlib.sha256((r[1] or "").encode()).hexdigest()
        key = hashlib.md5(f"{'null' if r[0] is None else r[0]}:{sha}".encode()).digest()
        kept.setdefault(g, []).append((r[0] is None, r[0] or 0, key, r))
    return sorted(((r[0], r[1] or "") for *_, r in (min(k, key=lambda x: x[:3]) for k in kept.values())), key=str)


def left_rows(frame):
    return sorted(((r["doc_id"], r["text"] or "") for r in frame.collect()), key=str)


def test_dropping_near_copies(spark):
    rows = near_rows() + [r[:2] for r in odd_rows()]
    docs = plain_docs(spark, [(r[0], r[1], "en", "s") for r in rows]).withColumn("fp", F.lit(1))
    got = simhash.drop_near_copies(docs)
    assert got.columns == docs.columns
    assert left_rows(got) == kept_rows(rows)
    assert simhash.drop_near_copies(empty_docs(spark)).collect() == []
    assert simhash.near_groups(empty_docs(spark)).collect() == []


def test_null_and_repeated_ids_do_not_take_other_texts_along(spark):
    rng = random.Random(11)
    a, b, c = (prose(rng, 400) for _ in range(3))
    more = a + " " + a.split()[0]
    assert (plain_print(a) ^ plain_print(more)).bit_count() <= 3
    rows = [(5, a), (None, more), (None, b), (7, more), (7, c), (7, c), (5, a)]
    docs = plain_docs(spark, [(r[0], r[1], "en", "s") for r in rows])
    assert left_rows(simhash.drop_near_copies(docs)) == sorted([(5, a), (None, b), (7, c)], key=str)


@pytest.mark.parametrize("drop", [exact_dedup.drop_exact_copies, simhash.drop_near_copies])
def test_columns_of_any_name_are_kept(spark, drop):
    names = ("_id", "_sha", "_slot", "_row", "row", "key", "place", "_keep", "root", "_n", "_best", "h")
    docs = odd_docs(spark).withColumns({n: F.lit(n) for n in names})
    got = drop(docs)
    assert got.columns == docs.columns
    assert left_rows(got) == left_rows(drop(odd_docs(spark)))
    assert all(r[n] == n for r in got.collect() for n in names)


def test_many_fingerprints_around_one_point_stay_linked(spark):
    """A crowd of fingerprints in one place: links grow with the rows, components are exact."""
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    prints = {centre}
    while len(prints) < 300:
        p = centre
        for _ in range(rng.randrange(1, 5)):
            p ^= 1 << rng.randrange(64)
        prints.add(p)
    frame = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp long")
    links = simhash.fingerprint_links(frame, dense=10)
    from heronlake.plans.graph import component_roots

    roots = {r["id"] % 2**64: r["component"] for r in component_roots(links).collect()}
    order = sorted(prints)
    want = components(order, lambda i, j: (order[i] ^ order[j]).bit_count() <= 3)
    groups = lambda names: sorted(sorted(p for p in order if names[p] == n) for n in {names[p] for p in order})
    assert groups({p: roots.get(p, p) for p in order}) == groups(dict(zip(order, want)))


def test_queries_equal_brute_force(spark):
    """The registered queries over the smallest tables, digits and all."""
    t = Tables(spark, "/root/testdata/sf0.001")
    rows = [(r["doc_id"], r["text"]) for r in t.documents.collect()]
    prints = [plain_print(r[1]) for r in rows]
    groups = components([r[0] for r in rows], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    got = sorted(map(tuple, catalog.QUERIES["op2_simhash_groups"](t).collect()))
    assert got == sorted((r[0], f"{p:016x}", g) for r, p, g in zip(rows, prints, groups))
