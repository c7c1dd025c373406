"""License notices: exact phrases, and short notices with a few edits."""

from __future__ import annotations

from bisect import bisect_left
from functools import lru_cache

from pyspark.sql import DataFrame

from heronlake.llm.common import map_texts

# Phrases with their labels, notices with theirs, words apart by one space.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "licensed under the apache license version 2 0": "apache",
    "under the terms of the gnu general public license": "gpl",
    "under the terms of the gnu lesser general public license": "lgpl",
    "subject to the terms of the mozilla public license": "mpl",
    "licensed under a creative commons attribution": "cc-by",
    "permission to use copy modify and or distribute this software": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "spdx license identifier": "spdx",
}
EDITS = 3
# All bytes of ASCII but digits and letters part words; A-Z become a-z.
TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def seeds(notice: str, edits: int) -> list[tuple[str, int]]:
    """The notice cut into ``edits + 1`` pieces with their offsets: of any text
    within that many edits, one piece at least stands there unchanged."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(notice[a:b], a) for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=1)
def _tools():
    import ahocorasick
    import regex

    words: dict[str, list] = {}
    for phrase, label in PHRASES.items():
        words.setdefault(f" {phrase} ", []).append((None, 0, label))
    for notice in NOTICES:
        for piece, offset in seeds(notice, EDITS):
            words.setdefault(piece, []).append((notice, offset, NOTICES[notice]))
    automaton = ahocorasick.Automaton()
    for piece, uses in words.items():
        automaton.add_word(piece, (len(piece), uses))
    automaton.make_automaton()
    fuzzy = {n: regex.compile(rf"(?e)(?:{regex.escape(n)}){{e<={EDITS}}}") for n in NOTICES}
    return automaton, fuzzy


def find_licenses(text: str) -> tuple[int, list[tuple[str, int, int, int]], list[tuple[str, int, int, int]]]:
    """Word count, exact phrases and fuzzy notices as (label, first word, words, edits)."""
    words = text.encode("utf-8", "replace").translate(TABLE).split()
    plain = (b" " + b" ".join(words) + b" ").decode()
    automaton, fuzzy = _tools()
    hits = list(automaton.iter(plain))
    # the places of all blanks, once; words before a place are found by bisection
    blanks = [i for i, c in enumerate(plain) if c == " "] if hits else []
    exact, windows = [], {}
    for end, (size, uses) in hits:
        start = end - size + 1
        for notice, offset, label in uses:
            if notice is None:
                exact.append((label, bisect_left(blanks, start), plain.count(" ", start + 1, end) + 1, 0))
            else:
                low = max(0, start - offset - EDITS)
                windows.setdefault(notice, []).append((low, low + len(notice) + 2 * EDITS))
    near = []
    for notice, places in windows.items():
        for low, high in _joined(places):
            found, at = [], low
            while (m := fuzzy[notice].search(plain, at, high)) is not None:
                found.append(m)
                at = max(m.end(), m.start() + 1)
            for m in found:
                begin = m.start() + (plain[m.start()] == " ")
                near.append((NOTICES[notice], bisect_left(blanks, begin) - 1, len(m[0].split()), sum(m.fuzzy_counts)))
    return len(words), sorted(exact, key=lambda x: (x[1], x[0])), sorted(set(near), key=lambda x: (x[1], x[0], x[2]))


def _joined(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Windows merged where they overlap, so that no place is searched twice."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(places):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, ``phrases`` and ``notices``.

    Texts are lower-cased (A-Z) and cut into words.  ``phrases`` are exact
    runs of words.  ``notices`` are runs within three edits of a known short
    notice: a notice cut into four pieces has one piece unchanged, so only
    places around an exact piece are searched, by bounded-error matching.
    Each carries label, first word, number of words and edits.

    Null and empty texts have no words; repeated rows and null ids are scanned
    like any other; further columns are not looked at; an empty table gives
    no rows.
    """

    def work(texts: list[str]) -> list[list]:
        names = ("label", "first", "words", "edits")
        found = [find_licenses(t) for t in texts]
        return [
            [n for n, _, _ in found],
            [[dict(zip(names, x)) for x in exact] for _, exact, _ in found],
            [[dict(zip(names, x)) for x in near] for _, _, near in found],
        ]

    place = "array<struct<label: string, first: long, words: long, edits: long>>"
    return map_texts(docs, work, f"n_words long, phrases {place}, notices {place}")
