"""Secrets, personal data and licence notices against plain searches."""

import random
import re
import zlib

from heronlake.llm import licenses, pii, secrets
from tests.llm.fixtures import empty_docs, odd_docs, odd_rows

PIECES = [
    "password=", "PassWord: '", "secret := ", "token=", "api_key=\"", "APIKEY: ", "passwd:", "abcdef0123456789", "AKIA", "AKIAAKIA",
    "ABCDEFGH12345678", "deadbeef" * 3, "xYz/+9", " ", "\n", "'", "é", "ſ", "K", "=", ":", "@", "ann.b+c", "mail.example.org", ".", "-",
    "10.0.0.1", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "+49 30 1234567", "0", "7", "5105105105105100",
    "DE89 3704 0044 0532 0130 00", "DE89370400440532013001", "phone", "call", "123-45-6789", "SSN", "GB82WEST12345698765432", "+",
]


def made_texts(seed: int, count: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 40))) for _ in range(count)]


def test_secrets_equal_a_plain_search():
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for text in made_texts(1, 1500):
        want = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 12]
        want += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        want += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
        want.sort(key=lambda s: (s[1], secrets.KINDS.index(s[0])))
        assert [s for s in secrets.find_secrets(text) if s[0] in secrets.BASE_KINDS] == want, text


def test_embedded_checksums_decide():
    body = "A" * 20 + "b1" * 5
    good = "ghp_" + body + secrets.checksum62(body)
    assert len(secrets.checksum62(body)) == 6
    assert sum(secrets.BASE62.index(c) * 62 ** (5 - i) for i, c in enumerate(secrets.checksum62(body))) == zlib.crc32(body.encode())
    bad = good[:-1] + ("x" if good[-1] != "x" else "y")
    assert secrets.find_secrets(f"see {good}.") == [("github", 4, 4 + len(good))]
    assert secrets.find_secrets(f"see {bad}.") == []
    npm = "npm_" + good[4:]
    assert ("npm", 0, 40) in secrets.find_secrets(npm)


def plain_personal(text: str) -> list[tuple]:
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def test_personal_data_equals_a_plain_search():
    for text in made_texts(2, 1500):
        got = [s[:3] for s in pii.find_personal(text) if s[0] in pii.BASE_KINDS]
        assert got == plain_personal(text), text


def test_checks_and_context_words():
    found = {s[0]: s for s in pii.find_personal("bank transfer to DE89 3704 0044 0532 0130 00 please")}
    assert found["iban"][3] == 1.0
    assert not [s for s in pii.find_personal("transfer to DE89 3704 0044 0532 0130 01") if s[0] == "iban"]
    assert [s[0] for s in pii.find_personal("the SSN 123-45-6789")] == ["national"]
    assert pii.find_personal("the part 123-45-6789") == []
    plain, near = pii.find_personal("+49 30 1234567")[0], pii.find_personal("phone: +49 30 1234567")[0]
    assert near[3] > plain[3]
    assert pii.find_personal("0." * 5000 + "0" * 5000 + ".1.1.1")  # long runs of digits are no trouble


def plain_phrases(text: str) -> tuple[int, list[tuple[str, int]]]:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    found = []
    for phrase, label in licenses.PHRASES.items():
        want = phrase.split()
        found += [(label, i) for i in range(len(words)) if words[i:i + len(want)] == want]
    return len(words), sorted(found, key=lambda x: (x[1], x[0]))


def test_phrases_equal_a_plain_search():
    rng = random.Random(3)
    parts = ["MIT", "License", "mit", "license", "cc", "BY", "cc-by", "GNU", "general", "public", "Apache", "é", "_", "\n", ". ", " ", " ", "x1", "\x00", "ÀB", "🎉"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) + rng.choice([" ", " ", "", "-"]) for _ in range(rng.randrange(0, 40)))
        count, exact, _ = licenses.find_licenses(text)
        assert (count, [(label, first) for label, first, _, _ in exact]) == plain_phrases(text), text


def test_notices_with_few_edits_are_found():
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy"
    _, _, near = licenses.find_licenses("one two " + notice + " of this")
    assert near == [("mit", 2, 13, 0)]
    _, _, near = licenses.find_licenses("one two " + notice.replace("granted", "grantd").replace("person", "persen") + " of this")
    assert near == [("mit", 2, 13, 2)]
    _, _, near = licenses.find_licenses(notice.replace("hereby granted", "not allowed at all"))
    assert near == []
    twice = licenses.find_licenses(notice + " x " * 60 + notice.replace("charge", "charges"))[2]
    assert [(n[0], n[3]) for n in twice] == [("mit", 0), ("mit", 1)]


def test_a_few_edits_equal_a_plain_search_for_the_best_place():
    """Every text within three edits of a notice is found, wherever the edits are."""
    rng = random.Random(5)
    for _ in range(200):
        notice, label = rng.choice(list(licenses.NOTICES.items()))
        chars = list(notice)
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(1, len(chars) - 1)
            if chars[at] != " ":
                chars[at] = rng.choice("qzx")
        _, _, near = licenses.find_licenses("qqq zzz " + "".join(chars) + " zzz qqq")
        assert label in {n[0] for n in near}, "".join(chars)


def test_odd_rows_and_empty_tables(spark):
    for scan, column in ((secrets.scan_secrets, "spans"), (pii.scan_personal, "spans"), (licenses.scan_licenses, "notices")):
        got = scan(odd_docs(spark)).collect()
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in odd_rows())
        assert all(r[column] == [] for r in got if r["doc_id"] in (1, 2, 3, 5))
        assert scan(empty_docs(spark)).collect() == []


def test_account_numbers_end_before_upper_case_words():
    cases = {
        "IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFF": "DE89 3704 0044 0532 0130 00",
        "DE89370400440532013000 EUR 500": "DE89370400440532013000",
        "GB29 NWBK 6016 1331 9268 19 AND": "GB29 NWBK 6016 1331 9268 19",
        "CH93 0076 2011 6238 5295 7": "CH93 0076 2011 6238 5295 7",
        "CH93 0076 2011 6238 5295 7 CHF 20": "CH93 0076 2011 6238 5295 7",
        "AB12 DE89 3704 0044 0532 0130 00": "DE89 3704 0044 0532 0130 00",
    }
    for text, number in cases.items():
        assert [text[s:e] for k, s, e, _ in pii.find_personal(text) if k == "iban"] == [number], text
    for text in ("DE89 3704 0044 0532 0130 01 BIC", "DE893704004405320130001", "xDE89370400440532013000", "DE89370400440532013000x"):
        assert not [s for s in pii.find_personal(text) if s[0] == "iban"], text
