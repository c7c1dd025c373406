"""Forests, ancestors, brackets, windows, palindromes, cuts and grids against brute force."""

import random

import pytest

from heronlake.operators import sequences, trees
from heronlake.plans.graph import STRETCH, is_acyclic, reach
from heronlake.plans.shared import Rounds
from heronlake.streaming import jobs


def plain_forest(edges):
    root, kept = {}, []

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for pos, a, b in sorted(edges):
        if top(a) != top(b):
            root[top(a)] = top(b)
            kept.append(pos)
    return kept


@pytest.mark.parametrize("seed", [1, 2])
def test_the_first_edge_that_closes_a_cycle(spark, seed):
    rng = random.Random(seed)
    edges = [(i, rng.randrange(60), rng.randrange(60)) for i in rng.sample(range(1000), 90)]
    frame = spark.createDataFrame(edges, "pos long, src long, dst long")
    kept = plain_forest(edges)
    assert sorted(r["pos"] for r in trees.spanning_forest(frame).collect()) == sorted(kept)
    first = min(e for e in edges if e[0] not in kept)
    got = trees.first_cycle_edge(frame).collect()
    assert [(r["pos"], r["src"], r["dst"], r["forest_edges"], r["closing_edges"]) for r in got] == [(*first, len(kept), len(edges) - len(kept))]


def test_a_forest_has_no_closing_edge(spark):
    chain = spark.range(300).selectExpr("id as pos", "id as src", "id + 1 as dst")
    assert trees.first_cycle_edge(chain).collect() == []
    assert trees.spanning_forest(chain).count() == 300
    assert trees.first_cycle_edge(chain.limit(0)).collect() == []


def test_common_ancestors_of_many_pairs(spark):
    rng = random.Random(3)
    parent = {0: None, 1: 1}
    for i in range(2, 200):
        parent[i] = rng.choice(list(parent)) if i % 3 else i - 1
    parent |= {500: 501, 501: 500, 502: 500}
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(300)] + [(7, 7), (0, 1), (500, 501), (3, 999), (None, 2), (502, 502)]

    def line(x):
        out = []
        while x is not None and x not in out:
            out.append(x)
            x = None if parent.get(x) == x else parent.get(x)
        return out

    def known(x):
        return x in parent and x < 500

    want = {(a, b): next((x for x in line(a) if x in line(b)), None) if known(a or 0) and known(b or 0) and a is not None else None for a, b in pairs}
    tree = spark.createDataFrame(list(parent.items()), "id long, parent long")
    got = trees.common_ancestors(tree, spark.createDataFrame(pairs, "a long, b long")).collect()
    assert len(got) == len(want)
    assert {(r["a"], r["b"]): r["ancestor"] for r in got} == want


def test_search_trees(spark):
    rng, rows, want = random.Random(4), [], {}
    for t in range(12):
        values = sorted(rng.sample(range(1000), 40))
        nodes = []

        def build(low, high, parent, left):
            if low < high:
                at = rng.randrange(low, high)
                own = (t * 100 + len(nodes), parent, left, float(values[at]))
                nodes.append(list(own))
                build(low, at, own[0], True)
                build(at + 1, high, own[0], False)

        build(0, len(values), None, None)
        if t % 3 == 1:
            nodes[rng.randrange(1, 40)][3] = values[-1] + 5.0 if t % 2 else -5.0
        if t == 5:
            nodes[10][3] = None
        rows += map(tuple, nodes)

        def fits(node, low, high):
            if node[3] is None or not low < node[3] < high:
                return False
            children = [n for n in nodes if n[1] == node[0]]
            return all(fits(c, low if c[2] else node[3], node[3] if c[2] else high) for c in children)

        want[t * 100] = (40, fits(nodes[0], float("-inf"), float("inf")))
    assert {True, False} <= {ok for _, ok in want.values()}
    rows += [(9000, 9001, True, 1.0), (9001, 9000, False, 2.0)]
    got = trees.search_tree_check(spark.createDataFrame(rows, "id long, parent long, is_left boolean, value double")).collect()
    assert {r["root"]: (r["nodes"], r["is_search_tree"]) for r in got} == want


def test_brackets(spark):
    rng = random.Random(5)
    texts = ["", None, "no", "()[]{}", "(]", "{[]}", ")(", "((", "a(b[c]d)e", "([)]", "<<>>", "🎉(é)", "(" * 400 + ")" * 400, "(" * 400 + "]" * 400]
    texts += ["".join(rng.choice("()[]x") for _ in range(rng.randrange(12))) for _ in range(200)]

    def plain(text):
        stack, ok, deep, most, n = [], True, 0, 0, 0
        for c in text or "":
            if c in "([{<":
                stack.append(c)
                deep, n = deep + 1, n + 1
            elif c in ")]}>":
                ok = bool(stack) and stack.pop() == "([{<"[")]}>".index(c)] and ok
                deep, n = deep - 1, n + 1
            most = max(most, deep)
        return n, most, ok and not stack

    frame = spark.createDataFrame(list(enumerate(texts)), "k long, s string")
    got = {r["k"]: (r["brackets"], r["deepest"], r["is_balanced"]) for r in sequences.bracket_report(frame, "k", "s").collect()}
    assert {k: v[::2] for k, v in got.items()} == {k: plain(t)[::2] for k, t in enumerate(texts)}
    assert all(got[k][1] == plain(t)[1] for k, t in enumerate(texts) if plain(t)[2])


def series(seed, keys=12, most=40, values="abcd"):
    rng, rows = random.Random(seed), []
    for k in [*range(keys), None]:
        for pos in range(rng.randrange(1, most)):
            rows.append((k, pos, rng.choice([*values, None])))
    return rows + [(99, i, "abcde"[i % 5]) for i in range(3000)]


def by_key(rows):
    out = {}
    for k, _, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        out.setdefault(k, []).append(v)
    return out


def test_longest_distinct_run(spark):
    rows = series(6, values="abcdefgh")

    def plain(values):
        return max(n for i in range(len(values)) for n in range(1, min(12, len(values) - i) + 1) if len(set(values[i:i + n])) == n)

    got = sequences.longest_distinct_run(spark.createDataFrame(rows, "k long, pos long, v string"), ["k"], ["pos"], "v").collect()
    assert {r["k"]: r["longest"] for r in got} == {k: plain(v) for k, v in by_key(rows).items()}


@pytest.mark.parametrize("wanted", [{"a": 2, "b": 1}, {"c": 1}, {"a": 3, "b": 2, "d": 1}])
def test_covering_window(spark, wanted):
    rows = series(7)

    def plain(values):
        found = [
            (n, i + 1) for i in range(len(values)) for n in range(1, min(40, len(values) - i) + 1)
            if all(values[i:i + n].count(w) >= k for w, k in wanted.items())
        ]
        n, i = min(found, default=(None, None))
        return i, n

    got = sequences.covering_window(spark.createDataFrame(rows, "k long, pos long, v string"), ["k"], ["pos"], "v", wanted).collect()
    assert {r["k"]: (r["first_row"], r["length"]) for r in got} == {k: plain(v) for k, v in by_key(rows).items()}


def plain_palindrome(text):
    best = (0, 0)
    for i in range(len(text)):
        for j in range(i + 1, len(text) + 1):
            if text[i:j] == text[i:j][::-1] and j - i > best[1]:
                best = (i, j - i)
    return best


def test_longest_palindrome(spark):
    rng = random.Random(8)
    texts = ["", None, "babad", "cbbd", "racecar", "é🎉é", "a" * 60, "ab" * 30] + ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 30))) for _ in range(150)]
    frame = spark.createDataFrame(list(enumerate(texts)), "k long, s string")
    got = {r["k"]: (r["start"], r["length"]) for r in sequences.longest_palindrome(frame, "k", "s").collect()}
    assert got == {k: plain_palindrome(t or "") for k, t in enumerate(texts)}
    assert sequences.palindrome_at_all_centres("x" * 100_001) == (0, 100_001)


def test_palindromes_survive_a_hash_that_tells_nothing(monkeypatch):
    import numpy as np

    monkeypatch.setattr(sequences, "_prefix_hashes", lambda codes, powers: np.zeros(len(codes) + 1, dtype=np.uint64))
    for text in ("abcde", "xabay", "aabbaac"):
        assert sequences.palindrome_at_all_centres(text) == plain_palindrome(text)


def test_word_cuts(spark):
    rng = random.Random(9)
    words = ["leet", "code", "apple", "pen", "a", "ab", "abc", "é", "cats", "dog", "sand", ""]
    texts = ["leetcode", "applepenapple", "catsandog", "", None, "aaaab", "éab", "xyz"]
    texts += ["".join(rng.choice(["a", "ab", "abc", "b", "pen"]) for _ in range(rng.randrange(1, 8))) for _ in range(100)]

    def plain(text):
        good = [True] + [False] * len(text)
        found = [(i, j) for i in range(len(text)) for j in range(i + 1, len(text) + 1) if text[i:j] in words]
        for i, j in sorted(found, key=lambda s: s[1]):
            good[j] |= good[i]
        return len(found), good[-1]

    frame = spark.createDataFrame(list(enumerate(texts)), "k long, s string")
    vocabulary = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r["k"]: (r["words_found"], r["can_cut"]) for r in sequences.word_cuts(frame, vocabulary, "k", "s").collect()}
    assert got == {k: plain(t or "") for k, t in enumerate(texts)}


def test_words_on_a_grid(spark):
    rng = random.Random(10)
    cells = {(r, c): rng.choice("abcd") for r in range(6) for c in range(7) if rng.random() < 0.9}
    words = {"".join(rng.choice("abcd") for _ in range(rng.randrange(1, 7))) for _ in range(80)} | {"zz", ""}

    def paths(word):
        def go(at, rest, used):
            if cells.get(at) != rest[0] or at in used:
                return 0
            if len(rest) == 1:
                return 1
            r, c = at
            return sum(go(n, rest[1:], used | {at}) for n in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)))

        return sum(go(at, word, frozenset()) for at in cells) if word else 0

    grid = spark.createDataFrame([(r, c, x) for (r, c), x in cells.items()], "r int, c int, letter string")
    got = sequences.words_on_grid(grid, spark.createDataFrame([(w,) for w in words], "word string")).collect()
    assert {r["word"]: r["paths"] for r in got} == {w: paths(w) for w in words if paths(w)}


@pytest.mark.parametrize("parts", [1, 6])
def test_batches_hold_real_rows(spark, tmp_path, parts):
    """Every row is in one batch; batches are full but for the last, over files and micro-batches."""
    path = str(tmp_path / "rows.parquet")
    spark.range(1234).selectExpr("id", "id % 7 as number", "'x' as row").repartition(parts).write.parquet(path)
    stream = jobs.file_stream(spark, path, spark.read.parquet(path).schema, files=1)
    rows = jobs.stream_batches(stream, 100)
    assert rows.columns == ["id", "number", "row", "batch"]
    got = rows.collect()
    assert sorted(r["id"] for r in got) == list(range(1234))
    sizes = {}
    for r in got:
        sizes[r["batch"]] = sizes.get(r["batch"], 0) + 1
    assert sizes == {**{b: 100 for b in range(12)}, 12: 34}


@pytest.mark.parametrize("seed", [1, 2])
def test_fewest_steps_over_directed_edges(spark, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(30)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    want, line = {0: 0, 7: 0}, [0, 7]
    for x in line:
        for a, b in edges:
            if a == x and b not in want:
                want[b] = want[x] + 1
                line.append(b)
    got = reach(spark.createDataFrame(edges, "src long, dst long"), spark.createDataFrame([(0,), (7,)], "id long")).collect()
    assert {r["id"]: r["steps"] for r in got} == want and len(got) == len(want)


def test_a_step_reads_no_more_parts_than_a_stretch(spark):
    """What a step compares with does not grow with the steps taken."""
    n, read, reader = 30, [], type(spark.read)
    pairs = spark.range(n).selectExpr("id as src", "id + 1 as dst")
    parquet = reader.parquet
    reader.parquet = lambda self, *paths, **more: (read.append(paths), parquet(self, *paths, **more))[1]
    try:
        got = {r["id"]: r["steps"] for r in reach(pairs.unionAll(pairs.selectExpr("dst", "src")), spark.range(1)).collect()}
    finally:
        reader.parquet = parquet
    assert got == {i: i for i in range(n + 1)}
    assert max(sum("steps=" in p for p in paths) for paths in read) <= STRETCH + 1


def has_cycle(edges):
    out, state = {}, {}
    for a, b in edges:
        out.setdefault(a, []).append(b)

    def visit(x):
        state[x] = 1
        found = any(state.get(y) == 1 or (y not in state and visit(y)) for y in out.get(x, []))
        state[x] = 2
        return found

    return any(x not in state and visit(x) for x in list(out))


@pytest.mark.parametrize("seed", range(6))
def test_cycles_in_branched_graphs(spark, seed):
    rng = random.Random(seed)
    edges = {tuple(sorted(rng.sample(range(80), 2))) for _ in range(110)}
    if seed % 2:
        a, b = rng.choice(sorted(edges))
        edges |= {(b, a + 1000), (a + 1000, a)}
    frame = spark.createDataFrame(sorted(edges), "src long, dst long")
    assert is_acyclic(frame) == (not has_cycle(edges)) == (seed % 2 == 0)


def test_deep_trees_take_few_rounds(spark, monkeypatch):
    """A comb of depth 200 branches at every node; layer by layer it would take 200 rounds."""
    saved = []
    save = Rounds.save
    monkeypatch.setattr(Rounds, "save", lambda self, df: (saved.append(1), save(self, df))[1])
    comb = spark.range(200).selectExpr("id as src", "id + 1 as dst").unionAll(spark.range(200).selectExpr("id as src", "id + 1000 as dst"))
    assert is_acyclic(comb.unionAll(spark.range(200).selectExpr("id + 2000 as src", "id as dst")))
    assert len(saved) < 60
    assert not is_acyclic(spark.createDataFrame([(5, 5)], "src long, dst long"))
    assert not is_acyclic(spark.createDataFrame([(1, 2), (2, 1)], "src long, dst long"))
