"""Crowded keys, ties, nulls and empty inputs against brute force."""

import math
import random
import statistics

import pytest
from pyspark.sql import Window, functions as F

from heronlake.operators import cleaning, islands, series, windows
from heronlake.plans.ordered import order_buckets, quantiles, scan, with_halo
from heronlake.plans.skew import attach
from heronlake.streaming import jobs


def skewed(spark, n=600, seed=7):
    """Half of the rows on key 1, some on a null key, many equal positions."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 1 if i % 2 else rng.choice([2, 3, 4, None])
        pos = 50 if rng.random() < 0.3 else rng.randrange(200)
        rows.append((key, pos, i, rng.randrange(-20, 40)))
    return spark.createDataFrame(rows, "k long, pos long, id long, v long")


@pytest.mark.parametrize("reverse", [False, True])
def test_scan_equals_a_plain_window(spark, reverse):
    df = skewed(spark)
    specs = {
        "s": ("sum", F.col("v"), True), "lo": ("min", F.col("v"), False), "hi": ("max", F.col("v"), True),
        "prev": ("last", F.col("v"), False), "all": ("total", F.col("v"), True),
    }
    got = scan(order_buckets(df, ["pos", "id"], ["k"]), ["k"], ["pos", "id"], specs, reverse=reverse)
    order = [F.desc("pos"), F.desc("id")] if reverse else ["pos", "id"]
    upto = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    want = df.select(
        "*", F.sum("v").over(upto).alias("s"), F.min("v").over(before).alias("lo"), F.max("v").over(upto).alias("hi"),
        F.last("v").over(before).alias("prev"), F.sum("v").over(Window.partitionBy("k")).alias("all"),
    )
    assert got.drop("_bucket").exceptAll(want).isEmpty() and got.count() == want.count()


def test_ranges_split_a_crowded_position(spark):
    df = spark.createDataFrame([(5, i) for i in range(800)], "pos long, id long")
    sizes = [r["count"] for r in order_buckets(df, ["pos", "id"]).groupBy("_bucket").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 400


def test_ranges_split_a_crowded_key(spark):
    df = spark.range(8000).select(F.lit(1).alias("k"), "id")
    sizes = [r["count"] for r in order_buckets(df, "id", ["k"]).groupBy("k", "_bucket").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1500


def test_halo_repeats_only_the_edge(spark):
    df = spark.range(1, 1001).select(F.lit(1).alias("k"), F.col("id").alias("rn"))
    blocks = with_halo(df, ["k"], "rn", 2, block=100)
    assert blocks.where("_own").count() == 1000
    assert blocks.where("not _own").count() == 20


def test_attach_equals_a_plain_join(spark):
    df = skewed(spark)
    stats = df.groupBy("k").agg(F.sum("v").alias("t"), F.count("*").alias("_n"))
    got = attach(df, stats, ["k"])
    want = df.withColumn("t", F.sum("v").over(Window.partitionBy("k")))
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()


def test_quantiles_interpolate(spark):
    values = [random.Random(3).randrange(1000) / 7 for _ in range(501)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = quantiles(df, "v", {"a": 0.25, "b": 0.5, "c": 0.99}).first()
    known = df.select(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.99)))).first()[0]
    assert list(row) == pytest.approx(known)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    assert quantiles(df, "v", {"a": 0.5}).first()["a"] is None


def by_key(spark, rows):
    out = {}
    for k, pos, i, v in rows:
        out.setdefault(k, []).append((pos, i, v))
    return {k: [v for *_, v in sorted(r)] for k, r in out.items()}


@pytest.fixture(scope="module")
def series_rows(spark):
    df = skewed(spark, 240, 11).where("k is not null")
    return df, by_key(spark, [tuple(r) for r in df.collect()])


@pytest.mark.parametrize("shape", ["random", "rising", "falling", "nulls"])
def test_gaps_across_ranges(spark, shape):
    rng = random.Random(2)
    rows = []
    for key, size in ((1, 160), (2, 30), (None, 20)):
        for i in range(size):
            v = {"rising": i, "falling": -i}.get(shape, rng.randrange(15))
            rows.append((key, i, None if shape == "nulls" and rng.random() < 0.34 else v))
    got = series.next_greater_gap(spark.createDataFrame(rows, "k long, pos long, v long"), ["k"], ["pos"], "v").collect()
    want = []
    for key in (1, 2, None):
        vs = [v for k, _, v in rows if k == key]
        for i, v in enumerate(vs):
            later = (j - i for j in range(i + 1, len(vs)) if v is not None and vs[j] is not None and vs[j] > v)
            want.append((key, i + 1, next(later, 0)))
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("shape", ["random", "rising", "falling", "nulls"])
def test_running_median_across_blocks(spark, shape):
    rng = random.Random(5)
    rows = []
    for key, size in (("a", 150), ("b", 20), (None, 30)):
        for i in range(size):
            v = {"rising": float(i), "falling": float(-i)}.get(shape, float(rng.randrange(30)))
            rows.append((key, i, None if shape == "nulls" and rng.random() < 0.34 else v))
    df = spark.createDataFrame(rows, "k string, pos long, v double")
    got = sorted((tuple(r) for r in series.running_median(df, ["k"], ["pos"], "v", block=8).collect()), key=str)
    want = []
    for key in ("a", "b", None):
        seen = []
        for k, pos, v in rows:
            if k == key:
                seen += [] if v is None else [v]
                want.append((key, pos, statistics.median(seen) if seen else None))
    assert got == sorted(want, key=str)


def test_ranks_of_a_growing_set():
    import numpy as np

    rng = random.Random(3)
    for _ in range(50):
        known = np.array([float(rng.randrange(9)) for _ in range(rng.randrange(0, 20))])
        own = np.array([float(rng.randrange(9)) for _ in range(rng.randrange(1, 20))])
        ranks = np.array([rng.randrange(1, len(known) + i + 2) for i in range(len(own))])
        want = [sorted([*known, *own[:i + 1]])[r - 1] for i, r in enumerate(ranks)]
        assert series.ranks_along(known, own, ranks).tolist() == want


def crowded(seed, n=300):
    """Four order columns: half of the rows share the first, a third the first two."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a = 5 if rng.random() < 0.5 else rng.randrange(10)
        b = 3 if rng.random() < 0.6 else rng.randrange(8)
        rows.append((rng.choice([1, 1, 2]), a, b, rng.randrange(4), n - i, rng.randrange(1, 9)))
    return rows


@pytest.mark.parametrize("columns", [["a", "b", "id"], ["a", "b", "c", "id"]])
def test_crowded_values_are_cut_column_by_column(spark, columns):
    rows = crowded(len(columns))
    names = ["k", "a", "b", "c", "id", "v"]
    df = spark.createDataFrame(rows, "k long, a long, b long, c long, id long, v long")
    ordered = {}
    for r in sorted(rows, key=lambda r: [r[names.index(c)] for c in columns]):
        ordered.setdefault(r[0], []).append(r[5])
    first = lambda out: {r["k"]: r[1] for r in out.collect()}

    def by_row(out, column):
        got = {}
        for r in sorted(out.collect(), key=lambda r: [r[c] for c in columns]):
            got.setdefault(r["k"], []).append(r[column])
        return got

    running = scan(order_buckets(df, columns, ["k"]), ["k"], columns, {"s": ("sum", F.col("v"), True)})
    assert by_row(running, "s") == {k: [sum(vs[:i + 1]) for i in range(len(vs))] for k, vs in ordered.items()}
    assert by_row(series.sliding_max(df, ["k"], columns, "v", 3), "window_max") == {
        k: [max(vs[i:i + 3]) for i in range(len(vs) - 2)] for k, vs in ordered.items()
    }
    assert first(series.max_multi_profit(df, ["k"], columns, "v")) == {
        k: sum(max(0, y - x) for x, y in zip(vs, vs[1:])) for k, vs in ordered.items()
    }
    assert first(series.count_runs_with_sum(df, ["k"], columns, "v", 20)) == {
        k: sum(sum(vs[i:j]) == 20 for i in range(len(vs)) for j in range(i + 1, min(len(vs), i + 25) + 1)) for k, vs in ordered.items()
    }
    assert first(series.shortest_run_at_least(df, ["k"], columns, "v", 40)) == {
        k: min((j - i for i in range(len(vs)) for j in range(i + 1, len(vs) + 1) if sum(vs[i:j]) >= 40), default=0)
        for k, vs in ordered.items()
    }
    few = df.where("k = 2").withColumn("v", F.when(F.col("id") % 40 == 0, 2).otherwise(1))
    small = sorted((r for r in few.collect()), key=lambda r: [r[c] for c in columns])
    products = {}
    for i, r in enumerate(small):
        products[r["id"]] = math.prod(x["v"] for j, x in enumerate(small) if j != i)
    assert {r["id"]: r["product"] for r in series.product_except_self(few, ["k"], columns, "v").collect()} == products


def test_ranges_of_many_small_keys(spark):
    rows = spark.range(6000).select(F.when(F.col("id") < 3000, F.lit(0)).otherwise(F.col("id") % 500 + 1).alias("k"), F.col("id").alias("pos"))
    cells = order_buckets(rows, "pos", ["k"]).groupBy("k", "_bucket").count()
    assert cells.count() <= 501 + 3 * 8
    assert cells.agg(F.max("count")).first()[0] <= 1500


def test_ranges_follow_text(spark):
    rng = random.Random(1)
    words = ["same long beginning " + rng.choice(["", "a", "é", "z" * 9, "\U0001f600"]) * rng.randrange(4) for _ in range(300)]
    words += [rng.choice("abcé") * rng.randrange(5) for _ in range(200)] + [None] * 100
    df = spark.createDataFrame(list(enumerate(words)), "id long, s string")
    got = scan(order_buckets(df, ["s", "id"]), [], ["s", "id"], {"rn": ("sum", F.lit(1).cast("long"), True)})
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("s", "id")).cast("long"))
    assert got.select("id", "rn").exceptAll(want.select("id", "rn")).isEmpty()
    assert got.groupBy("_bucket").count().agg(F.max("count")).first()[0] <= 250


def test_runs_with_sum(series_rows):
    df, lists = series_rows
    got = dict(series.count_runs_with_sum(df, ["k"], ["pos", "id"], "v", 10).collect())
    for k, vs in lists.items():
        assert got[k] == sum(sum(vs[i:j]) == 10 for i in range(len(vs)) for j in range(i + 1, len(vs) + 1))


def test_shortest_run(series_rows):
    df, lists = series_rows
    df = df.withColumn("v", F.abs("v") + 1)
    got = dict(series.shortest_run_at_least(df, ["k"], ["pos", "id"], "v", 90).collect())
    for k, vs in lists.items():
        vs = [abs(v) + 1 for v in vs]
        lengths = [j - i for i in range(len(vs)) for j in range(i + 1, len(vs) + 1) if sum(vs[i:j]) >= 90]
        assert got[k] == min(lengths, default=0)


def test_best_run_and_profit(series_rows):
    df, lists = series_rows
    df = df.withColumn("v", F.col("v").cast("double"))
    best = dict(series.max_run_sum(df, ["k"], ["pos", "id"], "v").collect())
    profit = dict(series.max_single_profit(df, ["k"], ["pos", "id"], "v").collect())
    rises = dict(series.max_multi_profit(df, ["k"], ["pos", "id"], "v").collect())
    top = {tuple(r)[:3]: r["window_max"] for r in series.sliding_max(df, ["k"], ["pos", "id"], "v", 4).collect()}
    assert len(top) == sum(max(0, len(vs) - 3) for vs in lists.values())
    for k, vs in lists.items():
        n = len(vs)
        assert best[k] == max(sum(vs[i:j]) for i in range(n) for j in range(i + 1, n + 1))
        assert profit[k] == max(vs[j] - vs[i] for i in range(n) for j in range(i, n))
        assert rises[k] == sum(max(0, b - a) for a, b in zip(vs, vs[1:]))


def greedy(rows):
    kept, last = 0, float("-inf")
    for b, a in sorted((b, a) for a, b in rows):
        if a >= last:
            kept, last = kept + 1, b
    return len(rows) - kept


@pytest.mark.parametrize("seed", [1, 2])
def test_erase_overlaps(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([1, 1, 1, 2, 3]), a, a + rng.randrange(0, 25)) for a in (rng.randrange(300) for _ in range(300))]
    df = spark.createDataFrame(rows, "k long, a long, b long")
    got = dict(islands.erase_overlaps(df, "k", "a", "b").collect())
    assert got == {k: greedy([(a, b) for kk, a, b in rows if kk == k]) for k in (1, 2, 3)}


def test_merged_intervals_are_disjoint_and_cover(spark):
    rng = random.Random(9)
    rows = [(a, a + rng.randrange(0, 12)) for a in (rng.randrange(900) for _ in range(200))]
    merged = sorted(tuple(r) for r in islands.merge_intervals(spark.createDataFrame(rows, "a long, b long"), "a", "b").collect())
    assert all(x[1] < y[0] for x, y in zip(merged, merged[1:]))
    assert all(any(a <= x and y <= b for a, b in merged) for x, y in rows)


def test_duplicates_split_the_rows(spark):
    df = skewed(spark).select("k", "pos")
    first = cleaning.dedup_keep(df.withColumn("i", F.monotonically_increasing_id()), ["k", "pos"], ["i"])
    extra = cleaning.count_key_duplicates(df, ["k", "pos"]).first()[0]
    assert first.count() + extra == df.count()
    single = df.groupBy("k", "pos").count().where("count = 1").count()
    assert cleaning.all_duplicates(df, ["k", "pos"]).count() + single == df.count()


def test_shares_sum_to_a_hundred(spark):
    df = skewed(spark).where("v > 0 and k is not null").withColumn("v", F.col("v").cast("double"))
    sums = windows.pct_of_group(df, "k", "v").groupBy("k").agg(F.sum("pct_of_group").alias("s")).collect()
    assert all(r["s"] == pytest.approx(100, abs=0.1) for r in sums)


def test_rank_filters_on_empty_input(spark):
    none = spark.createDataFrame([], "turn long, person_name string, weight long")
    assert windows.last_to_fit(none).count() == 0
    assert islands.merge_intervals(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


@pytest.mark.parametrize("parts", [1, 4])
def test_streams_read_the_whole_table(spark, tmp_path, parts):
    """A folder of part files and a single file give the same answers."""
    path = str(tmp_path / "trips.parquet")
    rows = spark.range(100).selectExpr("id", "cast(id - 10 as double) as fare_amount").repartition(parts)
    if parts == 1:
        rows.toPandas().to_parquet(path)
    else:
        rows.write.parquet(path)
    rows.write.parquet(str(tmp_path / "xtrips.parquet"))
    schema = rows.schema
    total = jobs.stream_fare_total(jobs.file_stream(spark, path, schema, files=1)).first()
    assert tuple(total) == (89, 4005.0)
    batches = jobs.stream_batch_counts(jobs.file_stream(spark, path, schema, files=1), 30).orderBy("batch").collect()
    assert [tuple(r) for r in batches] == [(0, 30), (1, 30), (2, 30), (3, 10)]


def test_streams_without_files(spark, tmp_path):
    path = tmp_path / "none.parquet"
    path.mkdir()
    schema = spark.range(1).selectExpr("id", "cast(id as double) as fare_amount").schema
    assert tuple(jobs.stream_fare_total(jobs.file_stream(spark, str(path), schema)).first()) == (0, None)
    assert jobs.stream_batch_counts(jobs.file_stream(spark, str(path), schema), 30).collect() == []


def test_plans(spark):
    import __spark_entry__ as entry

    plan = lambda name: entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    scan_plan = plan("scan_parquet")
    assert "GreaterThanOrEqual(l_shipdate" in scan_plan and "l_extendedprice" not in scan_plan
    for name in ("students_examinations", "adjacent_free_seats", "overlapping_sessions", "purchase_platform"):
        assert "CartesianProduct" not in plan(name) and "NestedLoop" not in plan(name)
    assert "TakeOrdered" in plan("kth_largest")
    dated = {
        "market_analysis": "o_orderdate", "sellers_no_sales": "o_orderdate", "positive_revenue": "l_shipdate",
        "latest_login": "o_orderdate", "rolling_3_month": "o_orderdate", "movie_rating": "ts",
        "monthly_active_and_rides": "o_orderdate", "working_driver_pct": "o_orderdate",
    }
    for name, column in dated.items():
        pushed = [x for x in plan(name).split("\n") if "PushedFilters" in x]
        assert any(f"GreaterThanOrEqual({column}" in x and f"LessThan({column}" in x for x in pushed), name
    assert "WindowGroupLimit" in plan("second_most_recent")


def test_graph_jobs_equal_brute_force_with_a_crowded_node(spark, monkeypatch):
    from heronlake.operators import graph

    rng = random.Random(4)
    star = [(0, i) for i in range(1, 60)] + [(rng.randrange(60, 90), rng.randrange(60, 90)) for _ in range(40)]
    edges = spark.createDataFrame(star, "src long, dst long")
    root = list(range(100))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in star:
        low, high = sorted((top(a), top(b)))
        root[high] = low
    assert sorted(map(tuple, graph.connected_components(spark.range(100), edges).collect())) == [(i, top(i)) for i in range(100)]

    monkeypatch.setattr(graph, "FAN", 3)
    friends = edges.where("src <> dst").selectExpr("src as user1_id", "dst as user2_id")
    links = {frozenset(e) for e in star if e[0] != e[1]}
    near = {n: {next(iter(e - {n})) for e in links if n in e} for n in range(100)}
    common = sorted((*sorted(e), len(set.intersection(*(near[n] for n in e)))) for e in links)
    got = sorted(map(tuple, graph.mutual_friends(friends, 1).select("user1_id", "user2_id", "common_friend").collect()))
    assert got == [x for x in common if x[2]]

    assert graph.has_no_cycle(edges.where("src = 0")).first()["can_finish"]


def test_depths_leave_out_cycles(spark):
    from heronlake.operators import graph

    parents = {0: None, 1: 0, 2: 1, 3: 2, 4: 3, 5: 4, 10: 11, 11: 10, 12: 10, 13: 13}
    tree = spark.createDataFrame(list(parents.items()), "id long, parent long")
    got = {r["id"]: r["depth"] for r in graph.node_depths(tree).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 13: 0}
