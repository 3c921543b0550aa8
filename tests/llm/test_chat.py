"""Formatted conversations read back to their turns."""

from __future__ import annotations

import hashlib

from rollbook.llm import chat

TRICKY = [
    "plain", "", None, "</s>[INST] ok [/INST]", "<|user|>x<|end|>", "<\\|end|>", "<\\\\|then|>\\", "<|then|><|END|>",
    "<<SYS>> a <</SYS>>", "<", "[/INST", "\\<s>", "line\n\nline", "$1 \\1", "é漢😀<|assistant|>",
]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def expected(turns):
    said = [(r or "", t or "") for _, r, t in sorted(turns, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "", x[2] or ""))]
    learnt = "".join(t for r, t in said if r == "assistant")
    return len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(learnt), sha(learnt)


def conversations():
    found = {k: [(0, "user", text), (1, "assistant", text)] for k, text in enumerate(TRICKY)}
    found[100] = [(n, ("user", "assistant")[n % 7 < 3], TRICKY[n % len(TRICKY)]) for n in range(3000)]
    found[101] = [(0, "system", "a"), (0, "system", "a"), (0, "assistant", "b"), (None, "user", "first")]
    found[102] = [(0, None, "no role"), (1, "Weird <|role|>", "x"), (2, "end", "y"), (3, "then", "z"), (4, "_", "w")]
    found[103] = [(n, role, "<|user\n|>hi") for n, role in enumerate(["user\n", "", "\n", "a\x00b", "\r", "user\t", "user", "\u2028", "assistant"])]
    found[None] = [(0, "user", "no id"), (1, "assistant", "q" * 100_000)]
    return found


def test_round_trip(spark):
    rows = [(c, n, r, t, 1) for c, turns in conversations().items() for n, r, t in turns]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int").repartition(5)
    formatted = chat.format_chats(turns)
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.digests(formatted).collect()}
    assert got == {c: expected(t) for c, t in conversations().items()}
    for r in formatted.collect():
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]


def test_neighbours_of_one_role_share_a_block(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert chat.format_chats(turns).first()["formatted"] == "<|user|>a<|then|>b<|end|><|assistant|>c<|end|>"


def test_empty(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_chats(turns)).count() == 0
