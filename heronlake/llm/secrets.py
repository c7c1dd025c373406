"""Secret scan: keyword automaton, anchored patterns at its hits, checksums."""

from __future__ import annotations

import re
import string
import zlib
from functools import lru_cache

from pyspark.sql import DataFrame

from heronlake.llm.common import map_texts

# Kinds in their listed order, keywords and patterns.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS_WORDS = ("akia",)
CHECKED_WORDS = {
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm",
}
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def checksum62(body: str) -> str:
    """CRC-32 of the token body as six base-62 digits, as token issuers embed it."""
    left, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        left, digit = divmod(left, 62)
        out = BASE62[digit] + out
    return out


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    words = ahocorasick.Automaton()
    for group, names in (("assign", ASSIGN_WORDS), ("access", ACCESS_WORDS), ("checked", CHECKED_WORDS)):
        for word in names:
            words.add_word(word, (group, len(word)))
    words.make_automaton()
    return words


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind.

    The automaton walks the whole text once; a pattern is tried only at a
    keyword, anchored there.  Matches of a kind do not overlap and the
    leftmost wins, so a match that is too short still covers its place.  Hex
    strings have no keyword; runs of 16 digits are the hits.
    """
    found: list[tuple[int, int, str, int]] = []
    done = {"assign": 0, "access": 0, "checked": 0}
    # translate() works character by character, so places in both strings agree
    hits = [(at - size + 1, group) for at, (group, size) in _automaton().iter(text.translate(LOWER))]
    for start, group in sorted(set(hits)):
        if start < done[group]:
            continue
        if group == "assign" and (m := ASSIGN.match(text, start)):
            done[group] = m.end()
            if len(m[2]) >= 12:
                found.append((start, 0, "assign", m.end()))
        elif group == "access" and (m := ACCESS.match(text, start)):
            done[group] = m.end()
            if m.end() - start >= 18:
                found.append((start, 1, "access", m.end()))
        elif group == "checked" and (m := CHECKED.match(text, start)) and checksum62(m[1]) == m[2]:
            done[group] = m.end()
            kind = CHECKED_WORDS[text[start:start + 4]]
            found.append((start, KINDS.index(kind), kind, m.end()))
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text)]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and ``spans`` (kind, start, end).

    Besides the base kinds, tokens of code hosts and package registries count
    where the checksum inside them is right.  Null and empty texts have no
    span.  Repeated rows and null ids are scanned like any other; further
    columns are not looked at; an empty table gives no rows.
    """

    def work(texts: list[str]) -> list[list]:
        return [[[{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(t)] for t in texts]]

    return map_texts(docs, work, "spans array<struct<kind: string, start: long, end: long>>")
