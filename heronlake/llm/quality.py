"""Quality rules with cutoffs whose false rejections are bounded."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from heronlake.llm.common import WHITE, bind, whole_text, written

# The signals and their cutoffs, from lenient to strict.
CUTOFFS = {
    "symbols": (2.0, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1),
    "dup_lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "repeats": (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1),
    "capitals": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "shouts": (1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.1),
}
SYMBOLS, SPLIT = "#*$%&|<>", r"[\x20\x09-\x0D]+"
FALSE_REJECTION, RISK = 0.01, 0.05
TERMS = 10_000


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def occurrences(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(without(text, chars))).cast("long")


def repeated_words(words: Column) -> Column:
    """Words inside a window of three that stands twice or more in the text.

    Windows are sorted by their 64-bit hash with their place; equal
    neighbours are repeats, and their places, in order, cover at most three
    words each.  Work grows as n log n, whatever repeats.
    """

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, s: a + s)

    def repeats(grams: Column) -> Column:
        def twin(g, i):
            return F.coalesce(F.get(grams, i - 1)["h"] == g["h"], F.lit(False)) | F.coalesce(
                F.get(grams, i + 1)["h"] == g["h"], F.lit(False)
            )

        return bind(F.array_sort(F.transform(F.filter(grams, twin), lambda g: g["p"])), covered)

    def windows(w: Column) -> Column:
        gram = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")),
        )
        return F.when(F.size(w) > 3, bind(F.array_sort(gram), repeats)).otherwise(F.lit(0))

    return bind(words, windows).cast("long")


def text_counts(docs: DataFrame, *carried: Column) -> DataFrame:
    """doc_id, lang and the counts of every whole text; null text has none."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        whole_text().alias("text"), F.struct(F.lit(0).alias("col1"), *[c.alias(f"col{i + 2}") for i, c in enumerate(carried)]).alias("_carried"),
    )
    text = F.col("text")
    words = F.filter(F.split(text, SPLIT), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(without(x, WHITE)) > 0)
    of_words = bind(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r")))
    of_lines = bind(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
    counted = rows.select(
        "doc_id", "lang", of_words.alias("w"), of_lines.alias("l"),
        F.length(without(text, WHITE)).cast("long").alias("word_chars"),
        occurrences(text, SYMBOLS).alias("n_symbols"),
        occurrences(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_capitals"),
        occurrences(text, "!").alias("n_shouts"), "_carried",
    )
    return counted.select(
        "doc_id", "lang", F.col("w.n").alias("n_words"), "word_chars", "n_symbols",
        (F.col("l.n") - F.col("l.d")).cast("long").alias("n_dup_lines"), F.col("w.r").alias("n_repeat_words"),
        F.col("l.n").cast("long").alias("n_lines"), "n_capitals", "n_shouts",
        *[F.col("_carried")[f"col{i + 2}"].alias(f"_carried{i}") for i in range(len(carried))],
    )


def signals() -> dict[str, Column]:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return {
        "symbols": F.col("n_symbols") / words,
        "dup_lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeats": F.col("n_repeat_words") / words,
        "capitals": F.col("n_capitals") / chars,
        "shouts": F.col("n_shouts") / words,
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def log_factorial(n: Column) -> Column:
    x = n.cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x)
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def binomial_below(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p), one for k of n p or more.

    Terms are added from k downwards, each by its ratio to the one before.
    Past ``TERMS`` terms the rest is bounded by a geometric series and added,
    so the value is never too small.
    """
    odds = (1 - p) / p
    top = log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p)

    def step(acc, j):
        ratio = (k - j + 1) * odds / (n - k + j)
        return F.struct((acc["term"] * ratio).alias("term"), (acc["sum"] + acc["term"] * ratio).alias("sum"), ratio.alias("ratio"))

    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"), F.lit(0.0).alias("ratio"))
    steps = F.filter(F.sequence(F.lit(0).cast("long"), F.least(k, F.lit(TERMS))), lambda j: j > 0)
    total = bind(
        F.aggregate(steps, start, step),
        lambda a: a["sum"] + F.when(k > TERMS, a["term"] * a["ratio"] / (1 - a["ratio"])).otherwise(0.0),
    )
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(top) * total))


def safe_cutoffs(counts: DataFrame, labels: DataFrame, false_rejection: float = FALSE_REJECTION, risk: float = RISK) -> DataFrame:
    """The strictest safe cutoff of each signal, one row per stratum (lang).

    The labelled documents of good quality that pass the base rules are the
    holdout.  A signal may reject ``false_rejection`` / signals of a stratum's
    good documents; it takes the strictest cutoff for which the exact binomial
    test rules out a higher rate at ``risk`` / (strata x signals).  Cutoffs
    were fixed beforehand and are tried from lenient to strict until the
    first fails, which needs no further correction.  So with probability
    1 - ``risk`` no stratum loses more than ``false_rejection`` of its good
    documents.  Without enough labels a signal rejects nothing.
    """
    good = labels.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("quality").alias("_q")).where("_q = 1")
    holdout = counts.where(~base_failed()).join(good, F.col("doc_id") == F.col("_id"))
    found = signals()
    holdout = holdout.select("lang", *[v.alias(f"s_{n}") for n, v in found.items()])
    above = [F.sum((F.col(f"s_{n}") > c).cast("long")).alias(f"k_{n}_{i}") for n, cs in CUTOFFS.items() for i, c in enumerate(cs)]
    per = written(holdout.groupBy("lang").agg(F.count("*").alias("n"), *above), "quality-holdout")
    tried = F.array(*[
        F.struct(F.lit(n).alias("signal"), F.lit(c).alias("cutoff"), F.col(f"k_{n}_{i}").alias("k"))
        for n, cs in CUTOFFS.items() for i, c in enumerate(cs)
    ])
    tests = per.select("lang", "n", F.inline(tried))
    strata = per.agg(F.greatest(F.count("*"), F.lit(1))).scalar()
    p_value = binomial_below(F.col("k"), F.col("n"), false_rejection / len(CUTOFFS))
    tests = tests.where(p_value <= F.lit(risk / len(CUTOFFS)) / strata)
    return tests.groupBy(F.col("lang").alias("_lang")).agg(
        *[F.min(F.when(F.col("signal") == n, F.col("cutoff"))).alias(f"c_{n}") for n in CUTOFFS]
    )


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed and kept.

    A document goes if it fails the base rules or lies above a safe cutoff of
    its language (see :func:`safe_cutoffs`).  Null text has no words and fails;
    a null language is a stratum; a null id has no label.  A document labelled
    more than once counts as good if one label says so; null labels say
    nothing.  Repeated rows are judged alike.  Empty documents give no rows;
    empty labels leave the base rules alone.  Further columns are not looked
    at.
    """
    judged = _judged(written(text_counts(docs), "quality-counts"), labels)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, all their columns as they were.

    Rows are written out once with their counts, so the texts are read and
    counted once and do not move.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    counts = written(text_counts(docs, row), "quality-documents")
    return _judged(counts, labels).where("kept").select("_carried0.*")


def _judged(counts: DataFrame, labels: DataFrame) -> DataFrame:
    cutoffs = written(safe_cutoffs(counts, labels), "quality-cutoffs")
    judged = counts.join(cutoffs, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    rejected = F.lit(False)
    for name, value in signals().items():
        rejected = rejected | F.coalesce(value > F.col(f"c_{name}"), F.lit(False))
    failed = base_failed()
    return judged.withColumn("base_failed", failed).withColumn("kept", ~(failed | rejected))
