"""Small tables for the training-data operators: odd rows and made-up texts."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h string, size long, kept boolean, fp long, n long"


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long_text = "word and another " * 15_000
    rows = [
        (1, None, "en", "a", None), (2, "", "en", None, 0), (3, "  \n\t ", None, "a", 5), (4, long_text, "en", "b", None),
        (5, "One two three.", "de", "b", 14), (5, "One two three.", "de", "b", 14), (6, "One two three.", None, None, 14),
        (None, "One two three.", "de", "b", 14), (None, None, None, None, None), (7, "one TWO three.", "de", "ä", 14),
        (8, "x" * 30_000, "en", "b", None), (9, "a\x0bb\x0cc\rd e f \U0001f600", "fr", "\U0001f600", 3), (10, "a", "en", "a", 1),
    ]
    return [(*r, "h", 7, False, 3, 1) for r in rows]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def prose(rng: random.Random, words: int) -> str:
    parts = ["ka", "lo", "mi", "ren", "sta", "vor", "el", "tu", "pha", "ind"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(words))


def plain_docs(spark, rows: list[tuple]):
    """(doc_id, text, lang, source) rows as a documents table."""
    full = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
