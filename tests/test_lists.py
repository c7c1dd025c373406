"""Friends' pages by packed lists against brute force; what is shuffled stays small."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from heronlake.operators import graph
from heronlake.plans import lists
from heronlake.sources.views import consecutive_pairs


def wanted(friendship, likes):
    near = {(a, b) for a, b in friendship} | {(b, a) for a, b in friendship}
    liked = set(likes)
    counts = Counter((u, p) for u, f in near for x, p in liked if f is not None and x == f)
    return sorted(((u, p, n) for (u, p), n in counts.items() if u is None or p is None or (u, p) not in liked), key=str)


def odd(seed, pages):
    """A crowded person, repeated and turned pairs, friends of oneself, nulls; one who likes nearly everything."""
    rng = random.Random(seed)
    friendship = [(0, i) for i in range(1, 40)] + [(rng.randrange(-9, 40), rng.randrange(-9, 40)) for _ in range(120)]
    friendship += [(b, a) for a, b in friendship[30:60]] + friendship[:9] + [(None, 3), (3, None), (None, 5), (None, None), (7, 7)]
    likes = [(rng.randrange(-9, 45), rng.choice(pages)) for _ in range(400)] + [(3, p) for p in pages[1:]]
    return friendship, likes + likes[:50] + [(3, None), (5, None), (5, None), (8, None), (44, None), (None, pages[0]), (None, None)]


SPREAD = [(-1) ** i * (7 ** i % (1 << 62)) for i in range(70)] + [(1 << 63) - 1, -(1 << 63), 0]


@pytest.mark.parametrize("pages", [list(range(60)), SPREAD], ids=["near", "spread"])
@pytest.mark.parametrize("most", [None, 3, 40])
def test_recommendations_equal_brute_force(spark, monkeypatch, pages, most):
    """Whatever is packed, listed and counted at once; ids of any size."""
    if most:
        for name in ("CHUNK", "LONGEST", "ROWS", "BYTES", "BATCH"):
            monkeypatch.setattr(lists, name, most)
    friendship, likes = odd(len(pages), pages)
    got = graph.page_recommendations(
        spark.createDataFrame(friendship, "user1_id long, user2_id long"),
        spark.createDataFrame(likes, "user_id long, page_id long").selectExpr("page_id", "user_id", "1 as more"),
    )
    assert got.dtypes == [("user_id", "bigint"), ("page_id", "bigint"), ("friends_likes", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == wanted(friendship, likes)


@pytest.mark.parametrize("kind", ["int", "string"])
def test_recommendations_of_other_ids(spark, kind):
    friendship, likes = odd(3, list(range(20)))
    as_kind = (lambda v: v) if kind == "int" else (lambda v: None if v is None else str(v))
    friendship, likes = ([tuple(map(as_kind, r)) for r in rows] for rows in (friendship, likes))
    got = graph.page_recommendations(
        spark.createDataFrame(friendship, f"user1_id {kind}, user2_id {kind}"),
        spark.createDataFrame(likes, f"user_id {kind}, page_id {kind}"),
    )
    assert got.dtypes == [("user_id", kind), ("page_id", kind), ("friends_likes", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == wanted(friendship, likes)


def test_recommendations_of_nothing(spark):
    none = spark.createDataFrame([], "user1_id long, user2_id long")
    some = spark.createDataFrame([(1, 2)], "user1_id long, user2_id long")
    for friends, likes in ((none, some), (some, none), (none, none)):
        assert graph.page_recommendations(friends, likes.toDF("user_id", "page_id")).collect() == []


def test_no_row_per_friend_and_page_is_shuffled(spark):
    """Lists meet their users without a join, and no exchange deals out pages."""
    friends = spark.range(40).selectExpr("id as user1_id", "id * 7 % 40 as user2_id")
    likes = spark.range(400).selectExpr("id % 40 as user_id", "id % 90 as page_id")
    plan = graph.page_recommendations(friends, likes)._jdf.queryExecution().executedPlan().toString().split("\n")
    assert not any("Join" in x or "Exchange" in x and "page_id" in x for x in plan)


def test_a_list_takes_few_bytes():
    """2,000 people with 30 friends and 30 pages of 1,000 each: 1.8 million entries."""
    rng = np.random.default_rng(2)
    batch = lambda a, b: [pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["id", "other"])]
    ids = np.repeat(np.arange(2000), 30)
    likes, links = batch(ids, rng.integers(0, 1000, len(ids))), batch(ids, rng.integers(0, 2000, len(ids)))
    pairs = pa.Table.from_batches([*lists.pack_pairs(lists.ITEM, 4, 1 << 20)(likes), *lists.pack_pairs(lists.GROUP, 4, 1 << 20)(links)])
    uses = pa.Table.from_batches(lists.pack_uses(400, 4096, 1 << 20, 32 << 20)(pairs.sort_by("slot").to_batches()))
    assert pairs["body"].nbytes < 6 * len(ids) * 2 and uses["body"].nbytes < 1.3 * 30 * len(ids)


def test_packed_numbers():
    rng = random.Random(1)
    values = np.array([0, 1, 127, 128, (1 << 64) - 1, 1 << 63] + [rng.getrandbits(rng.randrange(1, 65)) for _ in range(500)], np.uint64)
    data, ends = lists.packed(values)
    back, also = lists.unpacked(data)
    assert (back == values).all() and (ends == also).all()
    signed = values.view(np.int64)
    assert (lists.unzigzag(lists.zigzag(signed)) == signed).all()


def neighbours(rows):
    lines = {r for r in rows if None not in r}
    return {tuple(sorted((a, b))) for o, n, a in lines for p, m, b in lines if o == p and m == n + 1 and a != b}


@pytest.mark.parametrize("most", [None, 3])
@pytest.mark.parametrize("kind", ["int", "string"])
def test_neighbouring_lines(spark, monkeypatch, kind, most):
    """Long orders, several parts on a line, repeated rows, nulls; line numbers of any sign."""
    if most:
        for name in ("ROWS", "BATCH", "STRETCH"):
            monkeypatch.setattr(lists, name, most)
    rng = random.Random(6)
    rows = [(1, n, rng.randrange(300)) for n in range(-140, 200)] + [(2, rng.randrange(1, 8), rng.randrange(40)) for _ in range(90)]
    rows += rows[:60] + [(o, n, a) for o in (3, None) for n in (1, 2, None) for a in (4, 5, None)] + [(4, 32, 1), (4, 33, 2), (4, 34, 3), (5, 2147483647, 1), (5, -2147483647, 2)]
    rows = [(o, n, a if a is None or kind == "int" else str(a)) for o, n, a in rows]
    table = spark.createDataFrame(rows, f"l_orderkey long, l_linenumber int, part {kind}")
    found = consecutive_pairs(table, "part")
    assert found.dtypes == [("user1_id", kind), ("user2_id", kind)]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == neighbours(rows)


def test_lines_move_once(spark):
    table = spark.createDataFrame([(1, 1, 2)], "l_orderkey long, l_linenumber int, part long")
    plan = consecutive_pairs(table, "part")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "Join" not in plan
