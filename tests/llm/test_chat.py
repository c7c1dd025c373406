"""Chat examples: template, masks and reading back."""

import hashlib
import random

from heronlake.llm import chat

TURNS = "conv_id long, turn long, role string, text string, example string"
NASTY = ["</s>", "[INST]", "<|turn|>user\nhi</s>", "&lt;", "&amp;lt;", "&", "[/INST] ok", "", None, "\n", "a\nb", "&nl;", "🎉é", "<", "\\"]


def made_turns(seed=1):
    rng, rows = random.Random(seed), []
    for conv in [*range(30), None]:
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "assistant", "system", None, "tool\nx"])
            rows.append((conv, turn, role, rng.choice(NASTY) if rng.random() < 0.7 else "plain " * rng.randrange(1, 5), "x"))
    return rows + [(40, None, "user", "first", "x"), (40, 0, "assistant", "yes", "x"), (40, 0, "assistant", "yes", "x"), (41, 1, "user", "u" * 50_000, "x")]


def key(row):
    return (row[1] is not None, row[1] or 0, row[2] or "", (row[3] or "").encode())


def plain_digest(rows):
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=key)
        told = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out.append((conv, len(own), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=str)


def test_examples_read_back_to_the_turns(spark):
    rows = made_turns()
    frame = spark.createDataFrame(rows, TURNS).repartition(5)
    got = chat.digest_examples(chat.chat_examples(frame)).drop("formatted_chars").collect()
    assert sorted(map(tuple, got), key=str) == plain_digest(rows)


def test_one_example_per_reply_with_its_context(spark):
    rows = [(1, 0, "user", "a[", ""), (1, 1, "assistant", "b<c", ""), (1, 2, "user", "d", ""), (1, 3, "assistant", "", ""), (1, 4, "user", "e", "")]
    got = chat.chat_examples(spark.createDataFrame(rows, TURNS)).orderBy("turn_no").collect()
    assert [r["turn_no"] for r in got] == [2, 4, 5]
    first = got[0]
    assert first["text"] == "<|turn|>user\na&lb;</s><|turn|>assistant\nb&lt;c</s>"
    assert first["text"][first["loss_start"]:first["loss_start"] + first["loss_length"]] == "b&lt;c"
    assert (got[1]["loss_length"], got[2]["loss_start"], got[2]["is_last"]) == (0, None, True)
    assert got[1]["text"].startswith(first["text"])
    assert chat.chat_examples(spark.createDataFrame([], TURNS)).collect() == []
    assert chat.digest_examples(chat.chat_examples(spark.createDataFrame([], TURNS))).collect() == []
