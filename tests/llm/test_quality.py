"""Quality counts, the binomial bound and the cutoffs against brute force."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from heronlake.llm import quality
from tests.llm.fixtures import empty_docs, odd_docs, odd_rows, plain_docs, prose

WHITE = " \t\n\x0b\x0c\r"


def words_of(text):
    out, now = [], ""
    for c in text or "":
        if c in WHITE:
            if now:
                out.append(now)
            now = ""
        else:
            now += c
    return out + [now] if now else out


def plain_counts(text):
    text, words = text or "", words_of(text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)
    )


def empty_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def test_counts_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [r[:2] for r in odd_rows()]
    for i in range(60):
        line = lambda: " ".join(rng.choice(["a", "b", "c#", "|d", "é!"]) for _ in range(rng.randrange(0, 9)))
        rows.append((100 + i, rng.choice(["\n", "\n\n", "\x0b"]).join(line() for _ in range(rng.randrange(0, 12)))))
    got = quality.quality_report(plain_docs(spark, [(i, t, "en", "s") for i, t in rows]), empty_labels(spark)).collect()
    want = []
    for i, t in rows:
        n = plain_counts(t)
        failed = n[0] < 50 or 100 * n[4] > 50 * n[0]
        want.append((i, *n, failed, not failed))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert quality.quality_report(empty_docs(spark), empty_labels(spark)).collect() == []
    assert quality.quality_report(odd_docs(spark), empty_labels(spark)).count() == len(odd_rows())


def test_binomial_bound_equals_exact_sums(spark):
    cases = [(k, n, p) for p in (0.002, 0.01, 0.3) for n in (1, 5, 50, 400, 3000) for k in (0, 1, 2, 5, 20, 90) if k <= n]
    for p in (0.002, 0.01, 0.3):
        rows = [(k, n) for k, n, q in cases if q == p]
        frame = spark.createDataFrame(rows, "k long, n long")
        for r in frame.select("k", "n", quality.binomial_below(F.col("k"), F.col("n"), p).alias("v")).collect():
            exact = math.fsum(math.comb(r["n"], i) * p**i * (1 - p) ** (r["n"] - i) for i in range(r["k"] + 1))
            want = 1.0 if r["k"] >= r["n"] * p else exact
            assert math.isclose(r["v"], want, rel_tol=1e-6, abs_tol=1e-300), (r, want)


def test_the_rest_of_a_cut_series_is_bounded(spark, monkeypatch):
    frame = spark.createDataFrame([(200, 100_000)], "k long, n long")
    whole = frame.select(quality.binomial_below(F.col("k"), F.col("n"), 0.0024)).first()[0]
    monkeypatch.setattr(quality, "TERMS", 30)
    cut = frame.select(quality.binomial_below(F.col("k"), F.col("n"), 0.0024)).first()[0]
    assert whole <= cut <= 1.2 * whole


def labelled(spark, count=3000):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(count):
        junk = i % 5 == 0
        text = prose(rng, 60)
        if junk:
            text = " ".join(w + "##" for w in text.split())
        rows.append((i, text, "en" if i % 2 else None, "s"))
        if i % 3 or not junk:
            labels.append((i, 0 if junk else 1, 0))
    return plain_docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_cutoffs_catch_junk_and_keep_clean_documents(spark, monkeypatch):
    monkeypatch.setattr(quality, "FALSE_REJECTION", 0.05)
    docs, labels = labelled(spark)
    counts = quality.text_counts(docs)
    cuts = {r["_lang"]: r for r in quality.safe_cutoffs(counts, labels, 0.05).collect()}
    assert set(cuts) == {"en", None}
    assert all(r["c_symbols"] == 0.1 for r in cuts.values())
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_report(docs, labels).collect()}
    # without enough labels for the bound nothing but the base rules decides
    few = {r["doc_id"]: r["kept"] for r in quality.quality_report(docs, labels.limit(20)).collect()}
    assert all(few.values())
    strict = {r["_lang"]: r for r in quality.safe_cutoffs(counts, labels, 0.05).collect()}
    assert strict.keys() == cuts.keys()
    clean = [i for i in kept if i % 5]
    assert sum(kept[i] for i in clean) >= 0.99 * len(clean)


def test_cutoffs_equal_brute_force(spark):
    docs, labels = labelled(spark, 1500)
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1}
    rows = quality.text_counts(docs).withColumns(quality.signals()).withColumn("bad", quality.base_failed()).collect()
    got = {r["_lang"]: r.asDict() for r in quality.safe_cutoffs(quality.text_counts(docs), labels, 0.08, 0.1).collect()}
    strata = {r["lang"] for r in rows if r["doc_id"] in good and not r["bad"]}
    p, level = 0.08 / len(quality.CUTOFFS), 0.1 / len(quality.CUTOFFS) / len(strata)
    for lang in strata:
        own = [r for r in rows if r["lang"] == lang and r["doc_id"] in good and not r["bad"]]
        n = len(own)
        for name, cuts in quality.CUTOFFS.items():
            best = None
            for c in cuts:
                k = sum(r[name] > c for r in own)
                if k >= n * p or math.fsum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) > level:
                    break
                best = c
            assert got.get(lang, {}).get(f"c_{name}") == best, (lang, name)


def test_kept_documents_carry_all_columns(spark):
    docs = odd_docs(spark)
    got = quality.keep_good(docs, empty_labels(spark))
    assert got.schema.simpleString() == docs.schema.simpleString()
    assert got.count() == 0
    rows = [(i, prose(random.Random(i), 80), "en", "s") for i in range(5)]
    assert quality.keep_good(plain_docs(spark, rows), empty_labels(spark)).count() == 5
