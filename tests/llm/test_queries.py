"""The registered queries without a DuckDB statement, whole results against plain Python."""

import hashlib
import re

import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
from heronlake.llm import bpe, catalog, licenses, pii, secrets
from heronlake.sources.views import Tables
from tests.llm.test_spans import plain_personal, plain_phrases

SMALL = "/root/testdata/sf0.001"
# Each query without SQL and the test that runs it whole.
BRUTE_FORCE = {
    "op2_simhash_groups": "test_copies.test_queries_equal_brute_force",
    "op3_byte_bpe": "test_queries.test_op3", "op4_secret_scan": "test_queries.test_op4", "op7_personal_data": "test_queries.test_op7",
    "op8_license_scan": "test_queries.test_op8", "op10_lm_score": "test_tokens.test_query_returns_the_contract_columns",
    "op11_ngram_join": "test_ngram_join.test_query_equals_brute_force",
    "pipeline": "test_pipeline.test_pipeline_equals_brute_force",
}


@pytest.fixture(scope="module")
def rows(spark):
    return [(r["doc_id"], r["text"] or "") for r in Tables(spark, SMALL).documents.collect()]


def result(spark, name, *columns):
    found = catalog.QUERIES[name](Tables(spark, SMALL))
    assert found.columns[:len(columns)] == list(columns)
    return sorted((tuple(r)[:len(columns)] for r in found.collect()), key=str)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def told(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def test_every_query_without_sql_has_a_brute_force_test():
    import importlib

    assert set(BRUTE_FORCE) == {n for n in entry.queries() if n not in entry.oracle_sql()}
    for place in BRUTE_FORCE.values():
        module, name = place.split(".")
        assert callable(getattr(importlib.import_module(f"tests.llm.{module}"), name))


def test_op3(spark, rows):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), sha(t)))
    assert result(spark, "op3_byte_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=str)


def plain_secrets(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_op4(spark, rows):
    want = []
    for i, t in rows:
        base = plain_secrets(t)
        kinds = [k for k, *_ in base]
        want.append((i, *[kinds.count(k) for k in secrets.BASE_KINDS], sha(told(base)), told(secrets.find_secrets(t))))
    assert any(w[1] + w[2] + w[3] for w in want)
    assert result(spark, "op4_secret_scan", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans") == sorted(want, key=str)


def test_op7(spark, rows):
    want = []
    for i, t in rows:
        base = plain_personal(t)
        kinds = [k for k, *_ in base]
        spans = pii.find_personal(t)
        scores = ",".join(f"{s[3]:.2f}" for s in spans)
        want.append((i, *[kinds.count(k) for k in pii.BASE_KINDS], sha(told(base)), told(s[:3] for s in spans), scores))
    assert any(w[1] + w[2] + w[3] + w[4] for w in want)
    columns = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "scores")
    assert result(spark, "op7_personal_data", *columns) == sorted(want, key=str)


def test_op8(spark, rows):
    want = []
    for i, t in rows:
        n, base = plain_phrases(t)
        near = licenses.find_licenses(t)[2]
        starts, labels = [f for _, f in base], {x for x, _ in base}
        score = 1.0 if base else max((1 - e / (licenses.EDITS + 1) for *_, e in near), default=0.0)
        want.append((
            i, n, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)),
            ",".join(sorted(labels | {x[0] for x in near})), score, ",".join(f"{x}:{f}:{f + w}" for x, f, w, _ in near),
        ))
    assert any(w[2] for w in want)
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices")
    assert result(spark, "op8_license_scan", *columns) == sorted(want, key=str)


def test_many_phrases_in_one_text_take_linear_time():
    import time

    start = time.process_time()
    n, found, _ = licenses.find_licenses("cc by " * 80_000)
    assert (n, len(found), found[-1][1]) == (160_000, 80_000, 159_998)
    assert time.process_time() - start < 3
