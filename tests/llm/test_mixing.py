"""Targets, copies and draws of the source mix against brute force."""

import hashlib
import math
import random
from collections import Counter

from heronlake.llm import mixing
from tests.llm.fixtures import empty_docs, odd_docs, odd_rows, plain_docs, prose


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Share by weight, fix what is above its cap, share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, fixed = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in fixed]
        total = sum(weight[s] for s in open_)
        rest = left - sum(fixed.values())
        above = [s for s in open_ if rest * weight[s] / total > most * sizes[s]]
        if not above:
            return fixed | {s: rest * weight[s] / total for s in open_}
        fixed |= {s: most * sizes[s] for s in above}


def made_rows(seed, count):
    rng = random.Random(seed)
    names = ["hot", "b", "ä", "Z", "aa", None, "\U0001f600", "c"]
    return [
        (i, prose(rng, rng.randrange(0, 40)) or None, "en", rng.choice(names) if rng.random() > 0.33 else "hot") for i in range(count)
    ]


def test_targets_equal_repeated_sharing(spark):
    for seed in range(4):
        rows = made_rows(seed, 60)
        sizes = Counter()
        for _, t, _, s in rows:
            sizes[s] += len((t or "").split())
        want = plain_targets(sizes)
        got = {r["source_size"]: r["target"] for r in mixing.mix_sizes(plain_docs(spark, rows)).collect()}
        for s, n in sizes.items():
            assert math.isclose(got[n], want[s], rel_tol=1e-9), (seed, s)


def test_copies_follow_rate_and_draw(spark):
    rows = made_rows(9, 3000)
    got = mixing.mix_sizes(plain_docs(spark, rows)).collect()
    taken, target = Counter(), {}
    for r in got:
        rate = r["target"] / r["source_size"]
        u = int(hashlib.md5(f"mix:{r['doc_id']}".encode()).hexdigest()[:12], 16) / 16**12
        assert r["copies"] == math.floor(rate) + (u < rate - math.floor(rate))
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r["source_size"]] += r["taken"]
        target[r["source_size"]] = r["target"]
    assert all(abs(taken[s] - t) < 0.1 * t for s, t in target.items())
    again = mixing.mix_sizes(plain_docs(spark, rows).repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_mixed_documents_repeat_rows(spark):
    docs = odd_docs(spark)
    sizes = mixing.mix_sizes(docs).collect()
    mixed = mixing.mix_documents(docs)
    assert mixed.schema.simpleString() == docs.schema.simpleString()
    assert mixed.count() == sum(r["copies"] for r in sizes)
    assert len(sizes) == len(odd_rows())
    by_id = Counter(r["doc_id"] for r in mixed.collect())
    want = Counter()
    for r in sizes:
        want[r["doc_id"]] += r["copies"]
    assert by_id == +want
    assert mixing.mix_sizes(empty_docs(spark)).collect() == []
    assert mixing.mix_documents(empty_docs(spark)).collect() == []
