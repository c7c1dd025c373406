"""Repair of damaged conversations: the cheapest edits that give a legal order of roles."""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from heronlake.llm.common import WHITE

# Costs of edits, the initials of the two roles that may be put in,
# the states of s?(ua)+ (0 start, 1 after s, 2 after u, 3 after a) and the moves between them.
DELETE, REROLE, INSERT, UNFINISHED = 2, 1, 5, 5
ROLES = {"u": "user", "a": "assistant"}
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
# From each state one role alone may follow by an insertion or a new role.
NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}
OPS = "DIKR"
# Rows of a conversation that are held in memory; more go to a spill file.
PAGE = 4096
LEGAL = ("su", "ua", "au")


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that the row's checksum picks.

    Nulls in role and text are one space, and so are nulls of ids in the checksum.
    """
    c = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), c("role").alias("role"),
        c("text").alias("text"), (F.crc32(F.concat_ws(":", c("conv_id"), c("turn")).cast("binary")) % 20).alias("_hit"),
    ).where("_hit <> 0")
    text = F.when(F.col("_hit") == 1, F.lit("")).when(F.col("_hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_hit") == 4, F.lit("user")).otherwise(F.col("role"))
    twice = F.when(F.col("_hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(twice).alias("_copy")).drop("_copy")


def fault(role: Column, text: Column, seen: Column) -> Column:
    """The first fault of a row: blank, duplicate, truncated or none."""
    bare = F.rtrim(text, F.lit(WHITE))
    return (
        F.when(bare == "", "blank").when(seen, "duplicate")
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated").otherwise("none")
    )


class Spill:
    """Pages in the order they came, given back last page first; beyond 8 MB they lie in an unnamed file."""

    def __init__(self):
        self.file, self.ends = tempfile.SpooledTemporaryFile(max_size=8 << 20), [0]

    def add(self, page: bytes) -> None:
        self.file.seek(self.ends[-1])
        self.file.write(page)
        self.ends.append(self.ends[-1] + len(page))

    def backwards(self) -> Iterator[bytes]:
        for low, high in reversed(list(zip(self.ends, self.ends[1:]))):
            self.file.seek(low)
            yield self.file.read(high - low)
        self.file.close()


class Conversation:
    """The running state of one conversation, fed with its rows from the last to the first.

    ``go`` holds the least cost from each state to a legal end over the rows
    seen; the edit picked in each state is two bits of one byte a row.  Rows
    and bytes are paged out, so memory does not grow with the turns.
    """

    def __init__(self, conv_id: int | None):
        self.conv_id, self.go = conv_id, [0, 2 * INSERT, INSERT, 0]
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.later, self.low, self.high, self.distinct, self.turn = None, None, None, 0, None
        self.picks, self.rows, self.spill = bytearray(), [], Spill()

    def add(self, turn: int | None, role: str, text: str, kind: str) -> None:
        first = role[:1]
        if self.later is not None and first + self.later not in LEGAL:
            self.counts["illegal"] += 1
        self.later = first
        if kind != "none":
            self.counts[kind] += 1
        if turn is not None and turn != self.turn:
            self.distinct, self.turn, self.low = self.distinct + 1, turn, turn
            self.high = turn if self.high is None else self.high
        self.step(first, kind)
        self.rows.append((role, text))
        if len(self.rows) == PAGE:
            self.page()

    def step(self, first: str, kind: str) -> None:
        """Edits in the order of their initials; a later one wins only if it is cheaper."""
        go, more, best, pick = self.go, UNFINISHED if kind == "truncated" else 0, [], []
        for state in range(4):
            cost, op = DELETE + go[state], 0
            if kind not in ("blank", "duplicate"):
                to = MOVES.get((state, first))
                if to is not None and more + go[to] < cost:
                    cost, op = more + go[to], 2
                to = MOVES[state, NEXT[state]]
                if REROLE + more + go[to] < cost:
                    cost, op = REROLE + more + go[to], 3
            best.append(cost)
            pick.append(op)
        plain = list(best)
        for state in (2, 3, 0, 1):
            # an insertion leads to a state of the same row; its own insertion is settled before
            to = MOVES[state, NEXT[state]]
            cost = INSERT + (plain[to] if state > 1 else best[to])
            if cost < best[state] or cost == best[state] and pick[state] > 1:
                best[state], pick[state] = cost, 1
        self.go = best
        self.picks.append(pick[0] | pick[1] << 2 | pick[2] << 4 | pick[3] << 6)

    def page(self) -> None:
        import pickle

        if self.rows:
            self.spill.add(pickle.dumps((bytes(self.picks), self.rows)))
            self.picks, self.rows = bytearray(), []

    def done(self) -> dict:
        """Walk the picked edits from the first row on; the result row."""
        import pickle

        self.page()
        state, audit, digest, empty = 0, [], hashlib.sha256(), True

        def put(role: str, text: str) -> None:
            nonlocal empty
            digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode("utf-8", "replace"))
            empty = False

        for blob in self.spill.backwards():
            picks, rows = pickle.loads(blob)
            ops = []
            for pick, (role, text) in zip(reversed(picks), reversed(rows)):
                while (op := pick >> 2 * state & 3) == 1:
                    ops.append("I")
                    put(ROLES[NEXT[state]], "")
                    state = MOVES[state, NEXT[state]]
                ops.append(OPS[op])
                if op == 3:
                    role = ROLES[NEXT[state]]
                if op:
                    put(role, text)
                    state = MOVES[state, role[0]]
            audit.append("".join(ops))
        while state in (1, 2):
            audit.append("I")
            put(ROLES[NEXT[state]], "")
            state = MOVES[state, NEXT[state]]
        gaps = self.high - self.low + 1 - self.distinct if self.distinct else 0
        return {
            "conv_id": self.conv_id, "gaps": gaps, **self.counts, "cost": self.go[0], "audit": "".join(audit),
            "repaired_sha256": digest.hexdigest(),
        }


SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def repair_rows(marked: DataFrame) -> DataFrame:
    """The report per conversation from rows of (conv_id, turn, role, text, fault).

    Rows are dealt by conversation and sorted from the last turn to the first,
    so the edits that follow a row are settled when it comes; the state goes on
    over the borders of Arrow batches.  Each conversation brings a row without
    fault first, so one without turns is reported too.
    """
    arrow = pa.schema([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in
                       ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, size = None, [], 0
        for batch in batches:
            for conv_id, turn, role, text, kind in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                if kind is None:
                    if now is not None:
                        out.append(now.done())
                        size += len(out[-1]["audit"])
                    now = Conversation(conv_id)
                else:
                    now.add(turn, role, text, kind)
                if len(out) >= PAGE or size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out, size = [], 0
        if now is not None:
            out.append(now.done())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    order = ["conv_id", F.col("fault").isNotNull(), F.col("turn").desc_nulls_last(), F.col("role").desc(), F.col("text").desc(), (F.col("fault") == "duplicate").desc()]
    sorted_rows = marked.repartition("conv_id").sortWithinPartitions(*order)
    return sorted_rows.select("conv_id", "turn", "role", "text", "fault").mapInArrow(run, SCHEMA)


def repair_conversations(turns: DataFrame, damage: bool = True) -> DataFrame:
    """One row per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows (damaged first, unless ``damage`` is off) go by turn, nulls first,
    then by role and text.  A row's first fault counts: blank, duplicate (role
    and text came before in the conversation) or truncated (does not end with
    a full stop, exclamation or question mark).  ``audit`` has the initials of
    the cheapest Keep, Rerole, Delete and Insert edits that leave nothing or
    an optional system turn and pairs of user and assistant; of edits of one
    cost the first in ASCII order.

    Null roles and texts are one space, so a null text is blank; a role without
    a known initial cannot be kept.  A null turn comes first and counts for no
    gap; null conv_ids are one conversation.  Empty texts are blank, repeated
    rows duplicates, however often; texts of any length are only looked at
    from their end.  A conversation whose rows are all dropped has zeros, no
    audit and the hash of nothing.  An empty table gives no rows; further
    columns are not looked at.

    A conversation is one task's work, in bounded memory: earlier texts are
    known by a window, edits take a byte a row and are paged out with the
    texts.
    """
    c = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    rows = damaged(turns) if damage else turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), c("role").alias("role"),
        c("text").alias("text"),
    )
    same = Window.partitionBy("conv_id", "role", F.md5("text"), F.octet_length("text")).orderBy(F.col("turn").asc_nulls_first())
    marked = rows.withColumn("_seen", F.row_number().over(same) > 1)
    marked = marked.select("conv_id", "turn", "role", "text", fault(F.col("role"), F.col("text"), F.col("_seen")).alias("fault"))
    every = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("fault"),
    )
    return repair_rows(marked.unionByName(every))
