"""Operators on made-up rows, against plain Python worked out from the rule."""

import itertools
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from heronlake.operators import aggregates, cleaning, graph, islands, joins, quality, scalar, series, text, topk, windows
from heronlake.sources import tables


def made(seed, size, low, high):
    rng = random.Random(seed)
    return [rng.randrange(low, high) for _ in range(size)]


def seq(spark, values, kind="long"):
    rows = [("only", 10 * i, float(v) if kind == "double" else v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"k string, pos long, v {kind}")


def column(df, name, order="pos"):
    return [r[name] for r in df.orderBy(order).collect()]


def runs(vs):
    return [vs[i:j] for i in range(len(vs)) for j in range(i + 1, len(vs) + 1)]


@pytest.mark.parametrize("values", [made(1, 17, 0, 50), sorted(made(2, 9, 0, 50)), sorted(made(3, 9, 0, 50), reverse=True), [12]])
def test_profits_and_run_sums(spark, values):
    prices, signed = seq(spark, values, "double"), [v - 25 for v in values]
    first = lambda df: df.collect()[0][1]
    best = max([b - a for a, b in itertools.combinations(values, 2)] + [0])
    assert first(series.max_single_profit(prices, ["k"], ["pos"], "v")) == best
    assert first(series.max_multi_profit(prices, ["k"], ["pos"], "v")) == sum(max(0, b - a) for a, b in itertools.pairwise(values))
    assert first(series.max_run_sum(seq(spark, signed, "double"), ["k"], ["pos"], "v")) == max(map(sum, runs(signed)))
    assert first(series.count_runs_with_sum(seq(spark, signed), ["k"], ["pos"], "v", 3)) == sum(sum(r) == 3 for r in runs(signed))
    long_enough = [len(r) for r in runs(values) if sum(r) >= 60]
    positive = seq(spark, [v + 1 for v in values])
    long_enough = [len(r) for r in runs([v + 1 for v in values]) if sum(r) >= 60]
    assert first(series.shortest_run_at_least(positive, ["k"], ["pos"], "v", 60)) == min(long_enough, default=0)


@pytest.mark.parametrize("k", [1, 3, 6])
def test_near_repeats_and_windows(spark, k):
    vs = made(4, 14, 0, 9)
    near = any(vs[i] == vs[j] for i in range(len(vs)) for j in range(i + 1, min(len(vs), i + k + 1)))
    assert series.nearby_duplicate(seq(spark, vs), ["k"], ["pos"], "v", k).first()["has_nearby"] == near
    assert column(series.sliding_max(seq(spark, vs), ["k"], ["pos"], "v", k), "window_max") == [max(vs[i:i + k]) for i in range(len(vs) - k + 1)]


def test_products_without_one_row(spark):
    for vs in ([3, 5, 2, 7], [4, 0, 6], [0, 9, 0, 2]):
        want = []
        for i in range(len(vs)):
            p = 1
            for j, v in enumerate(vs):
                p *= v if j != i else 1
            want.append(p)
        assert column(series.product_except_self(seq(spark, vs), ["k"], ["pos"], "v"), "product") == want


def test_kth_and_schedule(spark):
    vs = made(5, 11, 0, 40)
    assert [topk.kth_largest(seq(spark, vs), "v", k).first()[0] for k in (1, 4, 11, 12)] == [*(sorted(vs)[-k] for k in (1, 4, 11)), None]
    jobs = "wwwwwxxxyz"
    counts = Counter(jobs)
    top = max(counts.values())
    want = max((top - 1) * (3 + 1) + sum(n == top for n in counts.values()), len(jobs))
    assert series.min_schedule_length(spark.createDataFrame([(c,) for c in jobs], "t string"), "t", 3).first()[0] == want


def test_balance_start(spark):
    def walk(gains):
        for start in range(len(gains)):
            turn = gains[start:] + gains[:start]
            if all(sum(turn[:i + 1]) >= 0 for i in range(len(turn))):
                return start
        return -1

    for seed in range(5):
        gas, cost = made(seed, 7, 0, 9), made(seed + 50, 7, 0, 8)
        stops = spark.createDataFrame([(i, g, c) for i, (g, c) in enumerate(zip(gas, cost))], "pos long, gas long, cost long")
        assert series.balance_start(stops).first()[0] == walk([g - c for g, c in zip(gas, cost)])


def test_longest_consecutive(spark):
    vs = made(6, 25, 0, 40)
    longest = max(next(n for n in itertools.count(1) if v + n not in vs) for v in vs)
    ids = spark.createDataFrame([(v,) for v in [*vs, None]], "n long")
    assert islands.longest_consecutive(ids, "n").first()[0] == longest
    assert islands.longest_consecutive(ids.where("n < 0"), "n").first()[0] == 0


def test_intervals(spark):
    rng = random.Random(7)
    spans = [(a, a + rng.randrange(1, 9)) for a in made(8, 14, 0, 90)]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    got = lambda df: sorted(tuple(r) for r in df.collect())

    def merged(rows):
        out = []
        for a, b in sorted(rows):
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(out[-1][1], b))
            else:
                out.append((a, b))
        return out

    apart = merged(spans)
    assert got(islands.merge_intervals(frame(spans), "a", "b")) == apart
    extra = (apart[1][1] - 1, apart[3][0] + 1)
    assert got(islands.insert_interval(frame(apart), frame([extra]), "a", "b")) == merged([*apart, extra])
    keep = max(len(c) for n in range(8) for c in itertools.combinations(spans[:8], n + 1) if all(p[1] <= q[0] or q[1] <= p[0] for p, q in itertools.combinations(c, 2)))
    keyed = frame(spans[:8]).withColumn("k", F.lit("one"))
    assert islands.erase_overlaps(keyed, "k", "a", "b").first()["removed"] == 8 - keep
    most = max(sum(a <= t < b for a, b in spans) for t in range(120))
    assert islands.max_concurrency(frame(spans), [], "a", "b").first()[0] == most


def test_ranges_and_pieces(spark):
    ids = sorted(set(made(9, 16, 0, 30)))
    want = []
    for _, part in itertools.groupby(enumerate(ids), lambda x: x[1] - x[0]):
        part = [v for _, v in part]
        want.append(str(part[0]) if len(part) == 1 else f"{part[0]}->{part[-1]}")
    frame = spark.createDataFrame([(v,) for v in ids], "log_id long")
    assert [r["range"] for r in islands.summary_ranges(frame).orderBy("start_id").collect()] == want
    letters = "qwqrrwtyttyuuiopppo"
    sizes, start, end = [], 0, 0
    for i, c in enumerate(letters):
        end = max(end, letters.rindex(c))
        if i == end:
            sizes.append(end - start + 1)
            start = i + 1
    frame = spark.createDataFrame([(1, i, c) for i, c in enumerate(letters)], "k long, pos long, c string")
    assert [r["length"] for r in islands.partition_by_key_span(frame, ["k"], ["pos"], "c").orderBy("first").collect()] == sizes


def grid(spark, rows):
    return spark.createDataFrame([(r, c, v) for r, row in enumerate(rows) for c, v in enumerate(row)], "r int, c int, v long")


def beside(cell, cells):
    r, c = cell
    return [x for x in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)) if x in cells]


def flood(starts, cells, allowed=lambda a, b: True):
    steps = dict.fromkeys(starts, 0)
    line = list(steps)
    for cell in line:
        for other in beside(cell, cells):
            if other not in steps and allowed(cell, other):
                steps[other] = steps[cell] + 1
                line.append(other)
    return steps


@pytest.mark.parametrize("seed", [1, 2])
def test_grids(spark, seed):
    rng = random.Random(seed)
    rows = [[rng.choice([0, 1, 1, 2]) for _ in range(6)] for _ in range(5)]
    cells = {(r, c): v for r, row in enumerate(rows) for c, v in enumerate(row)}
    land = {x for x, v in cells.items() if v >= 1}
    regions, left = 0, set(land)
    while left:
        regions += 1
        left -= set(flood([next(iter(left))], land))
    frame = grid(spark, rows)
    assert graph.grid_islands(frame, 1).first()[0] == regions
    steps = flood([x for x in land if cells[x] >= 2], land)
    assert graph.spread_minutes(frame, 1, 2).first()[0] == (max(steps.values()) if len(steps) == len(land) else -1)
    up = lambda a, b: cells[b] >= cells[a]
    one = flood([x for x in cells if x[0] == 0 or x[1] == 0], cells, up)
    two = flood([x for x in cells if x[0] == 4 or x[1] == 5], cells, up)
    assert {(r["r"], r["c"]) for r in graph.reach_both(frame).collect()} == set(one) & set(two)


def test_spread_that_reaches_all(spark):
    assert graph.spread_minutes(grid(spark, [[0, 9, 3, 3, 0], [0, 0, 0, 3, 3]]), 3, 9).first()[0] == 4


def test_trees_and_cycles(spark):
    edges = lambda rows: spark.createDataFrame(rows, "src long, dst long")
    star = [(3, i) for i in (0, 1, 2, 4, 5)]
    assert graph.is_tree(spark.range(6), edges(star)).first()["is_tree"]
    assert not graph.is_tree(spark.range(6), edges([*star[1:], (1, 2)])).first()["is_tree"]
    order = random.Random(10).sample(range(9), 9)
    forward = [(order[i], order[j]) for i, j in ((i, min(8, i + step)) for i in range(8) for step in (1, 3))]
    assert graph.has_no_cycle(edges(forward)).first()["can_finish"]
    assert not graph.has_no_cycle(edges([*forward, (order[7], order[2])])).first()["can_finish"]
    parents = {i: (None if i == 0 else (i - 1) // 3) for i in range(30)}
    depth = lambda i: 0 if parents[i] is None else 1 + depth(parents[i])
    tree = spark.createDataFrame(list(parents.items()), "id long, parent long")
    assert {r["depth"]: r["nodes"] for r in graph.hierarchy_levels(tree).collect()} == dict(Counter(map(depth, parents)))


def test_texts(spark):
    phrases = ["No lemon, no melon!", "stone by stone", "level  ", "12 21", "  tail end   "]
    df = spark.createDataFrame([(p,) for p in phrases], "s string")
    got = df.select("s", text.palindrome_flag("s").alias("p"), text.last_word_length("s").alias("n"), text.find_substring("s", "on").alias("at"))
    for r in got.collect():
        plain = [c for c in r["s"].lower() if c.isalnum()]
        assert r["p"] == (plain == plain[::-1])
        assert r["n"] == len(r["s"].split()[-1])
        assert r["at"] == r["s"].find("on")
    known = ["stale", "least", "steal", "cat", "act", "dog", "do"]
    groups = {}
    for w in known:
        groups.setdefault("".join(sorted(w)), []).append(w)
    vocabulary = spark.createDataFrame([(w,) for w in known], "word string")
    assert {r["letters"]: r["words"] for r in text.group_anagrams(vocabulary).collect()} == {k: " ".join(sorted(v)) for k, v in groups.items()}
    asked = ["do", "dog", "dogs", "s", "ste", "x"]
    found = text.prefix_lookup(vocabulary, spark.createDataFrame([(w,) for w in asked], "word string")).collect()
    assert {r["word"]: (r["is_word"], r["is_prefix"]) for r in found} == {w: (w in known, any(k.startswith(w) for k in known)) for w in asked}
    notes = {1: "hello", 2: "loop", 3: "aa"}
    papers = {1: "hole l", 2: "polo", 3: "a", 4: "unused"}
    made_of = text.can_construct(
        spark.createDataFrame(list(notes.items()), "k long, note string"), spark.createDataFrame(list(papers.items()), "k long, magazine string"), "k"
    )
    assert dict(map(tuple, made_of.collect())) == {k: not Counter(n) - Counter(papers[k]) for k, n in notes.items()}


def test_cleaned_strings(spark):
    rows = [
        ("  Corner Bakery", "+1 (303) 555 0142", "80202-9911", "Bake_Shop", "Owner@Corner.Example.Net"),
        ("ANNE'S", "303.555.0199", "near 80 203", "bake-shop", "no at sign"),
        ("24-hours", "555", "802", "  GROCERY ", " a.b@c.io"),
    ]
    df = spark.createDataFrame(rows, "store string, phone string, zip string, category string, mail string")
    got = df.select(
        cleaning.clean_store_name("store"), cleaning.clean_phone("phone"), cleaning.extract_zip("zip"),
        cleaning.normalize_category("category"), cleaning.valid_email("mail"),
    ).collect()
    assert [r[0] for r in got] == ["corner bakery", "annes", "24hours"]
    assert [r[1] for r in got][:2] == ["3035550142", "3035550199"]
    assert [r[2] for r in got] == ["80202", "80203", None]
    assert [r[3] for r in got] == ["bake shop", "bake shop", "grocery"]
    assert [r[4] for r in got] == [True, False, True]


def test_dates(spark):
    day = datetime(2031, 11, 5, 18, 4, 9)
    good, bad = str(day), [str(day).replace("-11-", "-17-"), "soon", ""]
    df = spark.createDataFrame([(s,) for s in [good, *bad]], "s string")
    assert [r[0] for r in df.select(cleaning.parse_timestamp_strict("s")).collect()] == [day, None, None, None]
    forms = [day.strftime(f) for f in ("%Y-%m-%d", "%m/%d/%Y", "%B %-d, %Y", "%Y%m%d")] + ["the fifth"]
    got = spark.createDataFrame([(s,) for s in forms], "s string").select(cleaning.parse_mixed_dates("s")).collect()
    assert [r[0] for r in got] == [day.date()] * 4 + [None]
    frame = spark.sql("select explode(array(timestamp_ntz'2031-02-03 05:00:00', timestamp_ntz'2031-08-03 05:00:00')) as ts")
    assert [str(r[0]) for r in frame.select(cleaning.to_utc("ts")).collect()] == ["2031-02-03 10:00:00", "2031-08-03 09:00:00"]


def test_buckets(spark):
    names, edges = ["low", "medium", "high", "premium"], [10, 30, 100]
    fares = [e + d for e in edges for d in (-0.01, 0.0, 0.01)] + [0.5, 340.0]
    df = spark.createDataFrame([(f,) for f in fares], "f double")
    got = df.select("f", scalar.bucket_case("f").alias("a"), scalar.bucket_cut("f").alias("b")).collect()
    assert all(r["a"] == r["b"] == names[sum(r["f"] >= e for e in edges)] for r in got)
    odd = spark.createDataFrame([(-0.5,), (None,)], "f double").select(scalar.bucket_case("f"), scalar.bucket_cut("f"))
    assert [tuple(r) for r in odd.collect()] == [("low", None), ("premium", None)]


TRIP = "trip_id long, fare_amount double, trip_distance double, passenger_count long, payment_type long, tip_amount double, pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz"


def made_trips(spark, seed, count=60):
    rng, start, rows = random.Random(seed), datetime(2031, 3, 7, 5), []
    for i in range(count):
        fare = rng.choice([None, -3.5, 0.0, 12.25, 18.0, 44.5, 71.0, 502.0])
        begin = start + timedelta(hours=5 * i)
        rows.append((
            i, fare, rng.choice([0.0, 1.6, 3.2, 12.8]), rng.choice([None, 0, 1, 4]), rng.choice([1, 2, 3]), rng.choice([None, -1.0, 0.0, 2.5]),
            begin, begin + timedelta(minutes=rng.randrange(3, 70)),
        ))
    return spark.createDataFrame(rows, TRIP), [dict(zip([c.split()[0] for c in TRIP.split(", ")], r)) for r in rows]


def test_trip_quality(spark):
    frame, rows = made_trips(spark, 11)
    count = lambda rule: sum(bool(rule(r)) for r in rows)
    fare = lambda r: r["fare_amount"]
    want = {
        "negative_fares": count(lambda r: fare(r) is not None and fare(r) < 0), "zero_distance": count(lambda r: r["trip_distance"] == 0),
        "null_fare": count(lambda r: fare(r) is None), "fare_over_max": count(lambda r: fare(r) is not None and fare(r) > 500),
        "zero_passenger": count(lambda r: r["passenger_count"] == 0),
    }
    got = {r["issue"]: r["issue_count"] for r in quality.quality_counts(frame).collect()}
    assert got == want | {"total_issues": sum(want.values())}
    clean = quality.clean_trips(frame).collect()
    assert all(0 < r["fare_amount"] <= 500 and r["trip_distance"] >= 0.1 and r["passenger_count"] > 0 for r in clean)
    sure = {r["trip_id"] for r in rows if r["fare_amount"] and 0 < fare(r) <= 500 and r["trip_distance"] >= 0.1 and r["passenger_count"] and r["tip_amount"] is not None}
    assert sure <= {r["trip_id"] for r in clean}
    assert quality.clean_counts(frame.limit(0)).first()["removal_pct"] is None
    with pytest.raises(quality.ValidationError, match="trip_distance") as error:
        quality.validate_schema(frame.drop("trip_distance"))
    assert error.value.missing == ["trip_distance"] and isinstance(error.value, tables.JobError)


def test_enriched_trips(spark):
    frame, rows = made_trips(spark, 12)
    by_id = {r["trip_id"]: r for r in rows}
    for r in quality.enrich_trips(quality.clean_trips(frame)).collect():
        raw = by_id[r["trip_id"]]
        assert r["revenue_per_mile"] == pytest.approx(r["fare_amount"] / raw["trip_distance"], abs=0.0051)
        assert r["total_amount_calc"] == pytest.approx(r["fare_amount"] + r["tip_amount"])
        assert r["day_of_week"] == raw["pickup_ts"].strftime("%A")
        assert r["is_weekend"] == (raw["pickup_ts"].weekday() >= 5)
        assert r["duration_min"] == (raw["dropoff_ts"] - raw["pickup_ts"]).total_seconds() / 60


def test_errors_name_the_input(spark, tmp_path):
    (tmp_path / "rows.csv").write_text("a\n1\n")
    for path in (str(tmp_path / "rows.json"), str(tmp_path / "rows.csv"), str(tmp_path / "missing.parquet")):
        with pytest.raises(tables.JobError) as error:
            tables.ingest_by_format(spark, path)
        assert error.value.path == path and error.value.reason
    assert tables.ingest_by_format(spark, str(tmp_path / "rows.csv"), "a int").first()["a"] == 1


def test_ranks_and_seats(spark):
    scores = [4.5, 7.0, 7.0, 1.0, 7.0, 4.5]
    df = spark.createDataFrame(list(enumerate(scores)), "k long, v double")
    want = {}
    for i, v in enumerate(scores):
        places = [p for p, x in enumerate(sorted(scores, reverse=True), 1) if x == v]
        want[i] = int(sum(places) / len(places))
    assert {r["k"]: r["rk"] for r in windows.average_rank(df, "v", "rk").collect()} == want
    people = ["ida", "jon", "kai", "lea", "mo", "nil", "ole"]
    seats = spark.createDataFrame(list(enumerate(people, 1)), "id long, student string")
    swapped = [p for a, b in itertools.zip_longest(people[::2], people[1::2]) for p in (b, a) if p]
    assert [r["student"] for r in scalar.exchange_seats(seats).orderBy("id").collect()] == swapped


def test_sessions_that_overlap(spark):
    rng, rows = random.Random(13), []
    for account in range(25):
        for _ in range(rng.randrange(1, 5)):
            begin = datetime(2031, 5, 1) + timedelta(minutes=rng.randrange(300))
            rows.append((account, rng.choice("pq"), begin, begin + timedelta(minutes=rng.randrange(1, 60))))
    clash = {a[0] for a in rows for b in rows if a[0] == b[0] and a[1] != b[1] and a[2] <= b[3] and b[2] <= a[3]}
    df = spark.createDataFrame(rows, "account_id long, ip_address string, login timestamp_ntz, logout timestamp_ntz")
    assert {r[0] for r in joins.overlapping_sessions(df).collect()} == clash


def test_results_come_in_order(spark):
    """Operators whose result is an order; sorting both sides would not show a wrong one."""
    rng = random.Random(14)
    values = [(i, float(rng.randrange(20))) for i in range(40)]
    df = spark.createDataFrame(values, "id long, v double").repartition(5)
    got = [tuple(r) for r in topk.sort_desc(df, "v", "id").collect()]
    assert got == sorted(values, key=lambda x: (-x[1], x[0]))
    rides = spark.createDataFrame([(i % 6, v) for i, v in values], "user_id long, distance double")
    users = spark.createDataFrame([(i, f"n{i}") for i in range(8)], "user_id long, name string")
    travelled = [(r["name"], r["travelled_distance"]) for r in joins.top_travellers(users, rides).collect()]
    assert travelled == sorted(travelled, key=lambda x: (-x[1], x[0])) and len(travelled) == 8


def test_rollup_counts_orders_once_per_level(spark):
    rng = random.Random(15)
    cities = {0: ("N", "a"), 1: ("N", "b"), 2: ("S", "a"), 3: (None, "c")}
    items = [(rng.randrange(12), rng.randrange(4), float(rng.randrange(1, 9))) for _ in range(60)]
    sold = spark.createDataFrame(items, "order_id long, seller_id long, price double")
    sellers = spark.createDataFrame([(k, *v) for k, v in cities.items()], "seller_id long, seller_state string, seller_city string")
    want = {}
    for order, seller, price in items:
        state, city = cities[seller]
        for level in ((state, city), (state, "ALL CITIES"), ("ALL STATES", "ALL CITIES")):
            orders, money = want.setdefault(level, (set(), []))
            orders.add(order)
            money.append(price)
    got = {(r["state"], r["city"]): (r["total_orders"], r["revenue"]) for r in aggregates.revenue_rollup(sold, sellers).collect()}
    assert got == {k: (len(o), sum(m)) for k, (o, m) in want.items()}
