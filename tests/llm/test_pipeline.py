"""The queries against DuckDB, and the pipeline against brute force."""

import hashlib
import re
from collections import Counter

import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from heronlake.llm import bpe, catalog, exact_dedup, mixing, simhash
from heronlake.sources.views import Tables
from tests.llm.fixtures import plain_docs
from tests.llm.test_copies import components, plain_print
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_oracle(spark, name):
    assert compare(catalog.QUERIES[name](Tables(spark, SMALL)), connect(SMALL), catalog.SQL[name]) is None


def test_entry_has_all_queries():
    names = entry.queries()
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
    assert "pipeline" in names and "month_over_month" in names


def test_stages_return_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "simhash_dedup", "source_mix", "byte_bpe"]


def test_pipeline_equals_brute_force(spark):
    """Stage by stage in plain Python; the labels are too few for cutoffs, so base rules decide."""
    import public_tokenizers

    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]

    def good(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        times = Counter(grams)
        covered = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
        return len(words) >= 50 and 100 * len(covered) <= 50 * len(words)

    rows = [r for r in rows if good(r[1])]
    first = {}
    for r in sorted(rows):
        first.setdefault(r[1], r)
    rows = sorted(first.values())
    prints = [plain_print(r[1]) for r in rows]
    group = components([r[0] for r in rows], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    rows = [r for r, g in zip(rows, group) if r[0] == g]
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sizes(plain_docs(spark, rows)).collect()}
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, text, *_ in rows:
        ids = library.encode_ordinary(text)
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        want += [(i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), packed)] * copies[i]
    got = [(*tuple(r)[:4], bytes(r["ids"])) for r in corpus_pipeline.run(spark, SMALL).collect()]
    assert sorted(got) == sorted(want)


def test_stages_take_what_the_one_before_kept(spark):
    rows = [(1, "same text", "en", "a"), (2, "same text", "en", "a"), (3, "other text", "en", "b")]
    docs = plain_docs(spark, rows)
    once = exact_dedup.drop_exact_copies(docs)
    assert sorted(r["doc_id"] for r in once.collect()) == [1, 3]
    assert simhash.near_groups(once).count() == 2
