"""Byte-level BPE: recursive DuckDB statements inside each task."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from heronlake.llm.common import slices, whole_text

# Rows of a word are its tokens by byte position.  Each round joins neighbours
# to the merge table and contracts each word's leftmost pair of lowest rank.
# Words without a pair leave the recursion.
ENCODE = """
with recursive step(word, pos, size, tok, live) as (
  select word, pos, 1, tok, true from start
  union all
  (with pair as (
     select a.word, a.pos, b.pos as right_pos, a.size + b.size as size, m.id, m.id::bigint << 32 | a.pos as turn
     from step a join step b on b.word = a.word and b.pos = a.pos + a.size
     join merges m on m.a = a.tok and m.b = b.tok where a.live),
   best as (
     select word, min(id) as id, arg_min(pos, turn) as pos, arg_min(right_pos, turn) as right_pos, arg_min(size, turn) as size
     from pair group by word)
   select s.word, s.pos, case when s.pos = p.pos then p.size else s.size end, case when s.pos = p.pos then p.id else s.tok end,
     p.word is not null
   from step s left join best p on p.word = s.word where s.live and (p.word is null or s.pos <> p.right_pos)))
select word, tok from step where not live order by word, pos
"""
# For words of many bytes.  Where no token made with the new one ranks below it
# ("safe"), the word's other pairs of the lowest rank would be next in turn and
# are contracted in the same round; in a row of overlapping pairs these are the
# first, the third and so on.
ENCODE_LONG = """
with recursive step(word, pos, size, tok, live) as (
  select word, pos, 1, tok, true from start
  union all
  (with pair as (
     select a.word, a.pos, b.pos as right_pos, a.size + b.size as size, m.id, m.safe
     from step a join step b on b.word = a.word and b.pos = a.pos + a.size
     join merges m on m.a = a.tok and m.b = b.tok where a.live),
   low as (select word, min(id) as id from pair group by word),
   turn as (
     select *, row_number() over (partition by word, run order by pos) as nth from (
       select *, sum(fresh) over (partition by word order by pos) as run from (
         select pair.*, (lag(right_pos) over (partition by pair.word order by pos) is distinct from pos)::int as fresh
         from pair join low on low.word = pair.word and low.id = pair.id))),
   picked as (select * from turn where case when safe then nth % 2 = 1 else run = 1 and nth = 1 end)
   select s.word, s.pos, coalesce(p.size, s.size), coalesce(p.id, s.tok), low.word is not null
   from step s left join low on low.word = s.word
   left join picked p on p.word = s.word and p.pos = s.pos
   left join picked gone on gone.word = s.word and gone.right_pos = s.pos
   where s.live and gone.word is null))
select word, tok from step where not live order by word, pos
"""
# Bytes of a word from which on it is long; bytes that are encoded and ids that
# are decoded by one statement.  Both bound what a session takes beside the words it keeps.
LONG, PIECE, IDS = 48, 150_000, 131_072
DECODE = """
select doc, string_agg(hex, '' order by pos) as hex from tokens join vocab on vocab.id = tokens.id group by doc order by doc
"""


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and numbers."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Codec:
    """One task's DuckDB session with the vocabulary and the merge table.

    Words met before are kept up to ``keep`` entries, so memory does not grow
    with the input; what is kept changes no result.
    """

    def __init__(self, path: str, pattern: str, keep: int = 600_000):
        import duckdb
        import regex

        self.ranks, self.pattern, self.keep = load_ranks(path), regex.compile(pattern), keep
        self.known: dict[str, bytes] = {}
        self.bytes_of = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        splits = array("i")
        for t, rank in self.ranks.items():
            for i in range(1, len(t)):
                left, right = self.ranks.get(t[:i]), self.ranks.get(t[i:])
                if left is not None and right is not None:
                    splits.extend((left, right, rank))
        a, b, made = np.array(splits, dtype=np.int32).reshape(-1, 3).T.copy()
        passed = np.union1d(a[made < a], b[made < b])
        # what a statement frees goes back to the system
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "500MB", "allocator_flush_threshold": "8MB"})
        self._table("merges", {"a": a, "b": b, "id": made, "safe": ~np.isin(made, passed)})
        tokens = sorted(self.ranks.items(), key=lambda x: x[1])
        self._table("vocab", {"id": np.array([r for _, r in tokens], dtype=np.int32), "hex": [t.hex() for t, _ in tokens]})

    def _table(self, name: str, columns: dict) -> None:
        self.db.register("incoming", pa.table(columns))
        self.db.execute(f"create or replace table {name} as select * from incoming")
        self.db.unregister("incoming")

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def _merge(self, words: list[bytes], statement: str) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers."""
        sizes = np.array([len(w) for w in words])
        starts = np.cumsum(sizes) - sizes
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        self._table("start", {
            "word": np.repeat(np.arange(len(words), dtype=np.int32), sizes),
            "pos": (np.arange(len(raw)) - np.repeat(starts, sizes)).astype(np.int32),
            "tok": self.bytes_of[raw],
        })
        found = self.db.execute(statement).fetchnumpy()
        ids = np.asarray(found["tok"]).astype("<u4")
        ends = np.cumsum(np.bincount(np.asarray(found["word"]), minlength=len(words))) * 4
        whole = ids.tobytes()
        return [whole[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words that are not known yet, a bounded number of bytes at a time."""
        if len(self.known) > self.keep:
            self.known.clear()
        todo: list[tuple[str, bytes]] = []
        for word in words:
            if word not in self.known:
                raw = word.encode("utf-8", "replace")
                rank = self.ranks.get(raw)
                if rank is None:
                    todo.append((word, raw))
                else:
                    self.known[word] = rank.to_bytes(4, "little")
        for statement, chosen in (
            (ENCODE, [x for x in todo if len(x[1]) <= LONG]), (ENCODE_LONG, [x for x in todo if len(x[1]) > LONG]),
        ):
            first, size = 0, 0
            for i, (_, raw) in enumerate(chosen):
                size += len(raw)
                if size >= PIECE or i + 1 == len(chosen):
                    part = chosen[first:i + 1]
                    self.known.update(zip((w for w, _ in part), self._merge([r for _, r in part], statement)))
                    first, size = i + 1, 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        # a word that occurs often is held once
        words: dict[str, str] = {}
        cut = [[words.setdefault(w, w) for w in self.split(t)] for t in texts]
        self.learn(words)
        known = self.known
        return [np.frombuffer(b"".join([known[w] for w in words]), dtype="<u4") for words in cut]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each list of ids, put together by ordered aggregation of a bounded number of ids at a time."""
        sizes = np.array([len(x) for x in ids], dtype=np.int64)
        ends = np.cumsum(sizes)
        out: list[list[bytes]] = [[] for _ in ids]
        flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)
        for start in range(0, len(flat), IDS):
            at = np.arange(start, min(start + IDS, len(flat)))
            docs = np.searchsorted(ends, at, side="right")
            self._table("tokens", {"doc": docs.astype(np.int32), "pos": (at - start).astype(np.int32), "id": flat[at].astype(np.int32)})
            for doc, text in self.db.execute(DECODE).fetchall():
                out[doc].append(bytes.fromhex(text))
        return [b"".join(parts) for parts in out]


_CODECS: dict[tuple, Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's session for these files, made once."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encode_texts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id and ``ids``, the token numbers of its whole text.

    Each match of ``pattern`` is encoded by itself and without special
    tokens; a match that is a token is that token.  Null text is empty and
    has no ids.  Repeated rows and null ids are encoded like any other; an
    empty table gives no rows; further columns are not looked at.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for part in slices(batch, 1):
                ids = own.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))], ["doc_id", "ids"]
                )

    return source.mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Adds ``decoded``, the bytes that ``ids`` stand for, to (doc_id, ids).

    Null and empty lists give empty bytes.  An id outside the vocabulary
    stands for no bytes.
    """
    source = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lists = part.column(1)
                offsets = lists.offsets.to_numpy()
                flat = lists.values.to_numpy(zero_copy_only=False)
                texts = own.decode([flat[a:b] for a, b in zip(offsets, offsets[1:])])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"]
                )

    return source.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, ``ids`` and ``decoded``, both binary.

    The whole text is encoded as in :func:`encode_texts` and decoded again
    from the ids in the same task.  ``ids`` are packed as little-endian
    unsigned 32-bit integers.  Null text is empty, and empty text has no ids
    and no bytes; repeated rows and null ids are encoded like any other; an
    empty table gives no rows; further columns are not looked at.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for part in slices(batch, 1):
                ids = own.encode(part.column(1).to_pylist())
                packed = pa.array([x.tobytes() for x in ids], pa.binary())
                texts = pa.array(own.decode(ids), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), packed, texts], ["doc_id", "ids", "decoded"])

    return source.mapInArrow(run, "doc_id long, ids binary, decoded binary")


def token_digest(coded: DataFrame, *also: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of a round trip, and chosen columns."""
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *also,
    )
