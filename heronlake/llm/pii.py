"""Personal data: patterns propose, checksums confirm, nearby words adjust the score."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from heronlake.llm.common import map_texts

# Kinds in their listed order, patterns, context words and weights.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
IBAN_GROUPS = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{2,4}){3,8}(?:\x20?[A-Z0-9])?")
IBAN_LENGTH = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 "
    "FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 "
    "LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 "
    "ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
).split()}
NATIONAL = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile"),
    "iban": ("iban", "account", "bank", "transfer"),
    "national": ("ssn", "social", "security", "national"),
}
START = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "national": 0.3}
LIFT, WINDOW, ACCEPT = 0.3, 40, 0.5
WORDS = {k: re.compile(r"(?<![a-z])(?:" + "|".join(v) + r")", re.I | re.A) for k, v in CONTEXT.items()}


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str):
    """Each match holds one '@' right after a run of local characters, so it is
    found from the '@' outwards; no run of letters is tried from every place."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _octet(digits: str) -> bool:
    return len(digits) < 4 and int(digits or "0") <= 255


def _accounts(text: str):
    """Upper-case words may follow a number, so it is cut to its country's length,
    or, for other codes, at the last end of a word where the check digits are right.
    The remainder is carried along, so all ends together take one pass."""
    at = 0
    while m := IBAN.search(text, at):
        at, length = m.start() + 1, IBAN_LENGTH.get(m[0][:2])
        places = [i for i in range(m.start(), m.end()) if text[i] != " "]
        head, left, right = "".join(str(int(text[i], 36)) for i in places[:4]), 0, []
        for size, i in enumerate(places[4:], 5):
            digit = int(text[i], 36)
            left = (left * (100 if digit > 9 else 10) + digit) % 97
            if size >= 15 and size == (length or size) and int(str(left) + head) % 97 == 1:
                right.append(i + 1)
        for end in reversed(right):
            after = text[end:end + 1]
            if not (after.isascii() and after.isalnum()) and IBAN_GROUPS.fullmatch(text, m.start(), end):
                yield m.start(), end
                at = end
                break


def find_personal(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in code points, by kind as listed and then start."""
    found: list[tuple[int, int, int]] = [(0, s, e) for s, e in _emails(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if all(_octet(p.lstrip("0")) for p in m.groups())]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    found += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    found += [(4, s, e) for s, e in _accounts(text)]
    found += [(5, *m.span()) for m in NATIONAL.finditer(text)]
    out = []
    for rank, start, end in sorted(found):
        kind = KINDS[rank]
        near = text[max(0, start - WINDOW):start] + " " + text[end:end + WINDOW]
        score = min(1.0, START[kind] + (LIFT if WORDS[kind].search(near) else 0.0))
        if rank < len(BASE_KINDS) or score >= ACCEPT:
            out.append((kind, start, end, round(score, 2)))
    return out


def scan_personal(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and ``spans`` (kind, start, end, score).

    Cards must pass Luhn and account numbers mod-97; a word such as "phone"
    within 40 characters lifts a span's score.  Spans of the base kinds are
    all reported with their score, further kinds from a score of 0.5 on.
    Null and empty texts have no span; repeated rows and null ids are scanned
    like any other; further columns are not looked at; an empty table gives
    no rows.
    """

    def work(texts: list[str]) -> list[list]:
        names = ("kind", "start", "end", "score")
        return [[[dict(zip(names, s)) for s in find_personal(t)] for t in texts]]

    return map_texts(docs, work, "spans array<struct<kind: string, start: long, end: long, score: double>>")
