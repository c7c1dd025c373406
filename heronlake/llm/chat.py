"""Chat examples: one per assistant turn, all turns before it as context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from heronlake.llm.common import written
from heronlake.plans.ordered import order_buckets, scan

# The template.
BEGIN, END = "<|turn|>", "</s>"
# Every control string starts with one of these; "&" first, so that undoing in reverse gives the text back.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"))


def escape(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def chat_examples(turns: DataFrame) -> DataFrame:
    """One row per example: conv_id, turn_no, text, loss_start, loss_length, is_last.

    Every assistant turn becomes an example: the formatted turns before it,
    then the reply.  Only the reply is trainable: ``loss_start`` and
    ``loss_length`` are code points in ``text``.  A conversation that does not
    end with a reply gets one more example without a trainable part, so no
    turn is lost.  ``is_last`` marks the example that holds all turns.

    A turn is ``<|turn|>role``, a line feed, the text and ``</s>``.  ``&``,
    ``<`` and ``[`` are escaped in roles and texts, a line feed in roles too,
    so a text cannot open or close a turn; undoing it gives the text back.

    Null text or role is empty; a null turn comes first; null conv_ids are
    one conversation.  Turns with one number go by role and text.  Repeated
    rows are turns of their own.  An empty table gives no rows; further
    columns are not looked at.  Places and offsets are running values over
    ranges of turns, and only an example gathers the turns before it, so a long
    conversation is many tasks' work.  An example holds its whole context by
    definition and has to fit in a row; a conversation's examples together grow
    with the square of its turns.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    key, order = ["conv_id"], ["turn", "role", "text"]
    line_free = F.replace(escape(F.col("role")), F.lit("\n"), F.lit("&nl;"))
    body = escape(F.col("text"))
    part = F.concat(F.lit(BEGIN), line_free, F.lit("\n"), body, F.lit(END))
    size, one = F.length(part).cast("long"), F.lit(1).cast("long")
    placed = scan(order_buckets(rows, order, key), key, order, {
        "turn_no": ("sum", one, True), "end": ("sum", size, True), "turns": ("total", one, True),
    })
    # an id that is not null for the join: null ids are told apart by a mark
    plain = [F.coalesce("conv_id", F.lit(0).cast("long")).alias("c"), F.col("conv_id").isNull().alias("bare")]
    placed = written(placed.select(
        "conv_id", *plain, "turn_no", "end", (F.col("turn_no") == F.col("turns")).alias("is_last"), (F.col("role") == "assistant").alias("reply"),
        F.length(body).cast("long").alias("size"), part.alias("part"),
    ), "chat-turns")
    wanted = placed.where(F.col("reply") | F.col("is_last")).select("c", "bare", F.col("turn_no").alias("upto"))
    before = placed.select("c", "bare", F.struct("turn_no", "part").alias("piece"))
    pieces = wanted.join(before, ["c", "bare"]).where(F.col("piece.turn_no") <= F.col("upto"))
    texts = pieces.groupBy("c", "bare", "upto").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    texts = texts.select("c", "bare", F.col("upto").alias("turn_no"), F.array_join(F.transform("pieces", lambda x: x["part"]), "").alias("text"))
    facts = placed.where(F.col("reply") | F.col("is_last")).drop("part")
    return facts.join(texts, ["c", "bare", "turn_no"]).select(
        "conv_id", "turn_no", "text", F.when(F.col("reply"), F.col("end") - len(END) - F.col("size")).alias("loss_start"),
        F.when(F.col("reply"), F.col("size")).alias("loss_length"), "is_last",
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted example as an array of (role, text)."""
    parts = F.filter(F.split(text, END), lambda p: p != "")

    def turn(part: Column) -> Column:
        rest = F.substring(part, F.lit(len(BEGIN) + 1), F.length(part))
        role = F.substring_index(rest, "\n", 1)
        body = F.substring(rest, F.length(role) + 2, F.length(rest))
        return F.struct(
            unescape(F.replace(role, F.lit("&nl;"), F.lit("\n"))).alias("role"), unescape(body).alias("text")
        )

    return F.transform(parts, turn)


def read_loss(example: Column) -> Column:
    """The trainable text of an example, as it was before formatting."""
    return unescape(F.substring(example["text"], (example["loss_start"] + 1).cast("int"), example["loss_length"].cast("int")))


def digest_examples(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted examples alone."""
    loss = F.when(F.col("loss_start").isNotNull(), read_loss(F.struct("text", "loss_start", "loss_length")))
    per = examples.select(
        "conv_id", "turn_no", F.length("text").cast("long").alias("_chars"), loss.alias("_loss"),
        F.when(F.col("is_last"), F.col("text")).alias("_all"),
    ).groupBy("conv_id").agg(
        F.max("_all").alias("_all"), F.sum("_chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.when(F.col("_loss").isNotNull(), F.struct("turn_no", "_loss")))).alias("_replies"),
    )
    replies = F.array_join(F.transform("_replies", lambda r: r["_loss"]), "")
    told = F.transform(read_turns(F.col("_all")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    per = per.select("conv_id", "formatted_chars", replies.alias("_loss"), told.alias("_turns"))
    return per.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("_turns", ""), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"), "formatted_chars",
    )
