"""Tries of conversations against counting every prefix of every path."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from rollbook.llm import trie

TURNS = "conv long, turn long, role string, text string, depth int"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def brute(conversations: dict[int, list[tuple[str, str]]]):
    members: dict[tuple, list[int]] = {}
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    children: dict[tuple, int] = {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    saved, leaves = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, own in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(own) - 1) * words
            leaves[node[:d]] += node not in children
    return sorted(
        (
            min(own), len(node), min(members[node[:-1]]) if node else -1, len(own), children.get(node, 0), leaves[node], saved[node],
            sha(",".join(str(c) for c in sorted(own) if len(conversations[c]) == len(node))),
        )
        for node, own in members.items()
    )


def found(spark, conversations, shards=None):
    rows = [(c, k, r, t, 1) for c, turns in conversations.items() for k, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    keys = trie.turn_keys(spark.createDataFrame(rows, TURNS).repartition(5), "conv", "turn", "role", "text")
    every = spark.createDataFrame([(c,) for c in conversations], "conv long").join(keys, "conv", "left")
    path = trie.path_of(trie.F.coalesce("keys", trie.F.array().cast("array<string>")))
    got = trie.prefix_trie(every.select("conv", path.alias("path")), shards).collect()
    return sorted(tuple(-1 if x is None else x for x in r) for r in got)


def drawn(n: int, seed: int) -> dict[int, list[tuple[str, str]]]:
    r = random.Random(seed)
    texts = ["", "a b", "a", "b  c\td", "é漢 x", "long " * 300]
    made = {c: [(r.choice("ua"), r.choice(texts)) for _ in range(r.choice([0, 1, 2, 3, 3, 9]))] for c in range(-3, n)}
    for c in range(n, n + 60):  # one path that many share, and one that is a prefix of another
        made[c] = [("u", "common start"), ("a", "common answer")][: 1 + (c % 3 > 0)]
    return made


@pytest.mark.parametrize("shards", [1, 2, 7, 64])
def test_nodes_of_random_conversations(spark, shards):
    conversations = drawn(150, 3)
    assert found(spark, conversations, shards) == brute(conversations)


def test_deep_conversations_that_share_their_beginning(spark):
    start = [("u", f"turn {k}") for k in range(2 * trie.DEEPEST)]
    conversations = {c: [*start, ("a", f"own {c}")] for c in range(40)} | {99: start[:5], 5000: start}
    assert found(spark, conversations, 8) == brute(conversations)


def test_turnless_and_single(spark):
    assert found(spark, {7: [], 9: []}) == brute({7: [], 9: []})
    assert found(spark, {7: [("u", "x y")]}) == brute({7: [("u", "x y")]})


def test_empty(spark):
    keys = trie.turn_keys(spark.createDataFrame([], TURNS), "conv", "turn", "role", "text")
    assert trie.prefix_trie(keys.select("conv", trie.path_of(trie.F.col("keys")).alias("path"))).count() == 0


def test_turns_with_nulls_ties_and_repeats(spark):
    rows = [(1, None, None, "first", 0), (1, 2, "u", None, 0), (1, 1, "b", "x", 0), (1, 1, "a", "x", 0), (1, 1, "a", "x", 0), (None, 0, "u", "no", 0)]
    keys = trie.turn_keys(spark.createDataFrame(rows, TURNS), "conv", "turn", "role", "text").collect()
    want = [("", "first"), ("a", "x"), ("a", "x"), ("b", "x"), ("u", "")]
    digests = [hashlib.sha256(f"{len(r)}:{r}{t}".encode()).hexdigest()[:32].upper() for r, t in want]
    assert [r["conv"] for r in keys] == [1]
    assert [k[:32].upper() for k in keys[0]["keys"]] == digests
    assert [int(k[32:], 16) for k in keys[0]["keys"]] == [1, 1, 1, 1, 0]


def test_roles_do_not_run_into_texts(spark):
    assert found(spark, {0: [("ab", "c")], 1: [("a", "bc")]}) == brute({0: [("ab", "c")], 1: [("a", "bc")]})


def test_splitters_part_paths_evenly():
    paths = [bytes([k // 256, k % 256]) + bytes(trie.TURN - 2) for k in range(1000)]
    splits = trie.splitters(paths, 10)
    assert len(splits) == 9
    sizes = [sum(trie.bisect_right(splits, p) == k for p in paths) for k in range(10)]
    assert max(sizes) <= 101
    # a subtree off the skeleton is never cut
    skeleton = trie.Skeleton([b"a" * 40, b"a" * 20 + b"b" * 20, b"c" * 20])
    assert skeleton.rows() == [(0, -1, 0, 1, trie.words_in(b"a" * 20)), (1, 0, 1, 0, trie.words_in(b"a" * 20))]
