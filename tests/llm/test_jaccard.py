"""Components of similar shingle sets against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollbook.llm import graph, jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    own = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(own[a : a + size]) for a in range(max(1, len(own) - size + 1))) if own else frozenset()


def brute(docs, size=4, least=(85, 100)):
    sets = [(d, shingles(t, size)) for d, t in docs]
    label = list(range(len(sets)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and least[1] * len(a & b) >= least[0] * len(a | b):
                label[root(i)] = root(j)
    lowest = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            lowest[root(i)] = min(d, lowest.get(root(i), d))
    return sorted(((d, len(s), lowest.get(root(i))) for i, (d, s) in enumerate(sets)), key=str)


def corpus(near=120):
    """Copies, near copies that drift apart, a passage in a third of all texts, and the odd cases."""
    draw = random.Random(11)
    word = lambda: draw.choice("abcdefghij") + draw.choice("klmnop") + str(draw.randrange(60))
    passage = " ".join(word() for _ in range(30))
    texts = [None, None, "", " \t\n ", "one", "One", "one two three", "one two three four", "the the the the the the", "É é"]
    base = [word() for _ in range(90)]
    for _ in range(near):
        copy = base.copy()
        for _ in range(draw.randrange(4)):
            copy[draw.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
        if draw.random() < 0.1:
            base = copy  # a chain: its ends are far apart
    for _ in range(60):
        own = [word() for _ in range(draw.choice((3, 8, 40, 200)))]
        texts.append(" ".join(own) + " " + passage)
        if draw.random() < 0.5:
            texts.append("  ".join(own).upper() + "\n" + passage)
    texts += ["copied text of more than four words"] * 90
    texts.append(" ".join(word() for _ in range(20_000)))
    ids = list(range(len(texts)))
    draw.shuffle(ids)
    return list(zip(ids, texts, strict=True))


@pytest.fixture(scope="module")
def docs():
    return corpus()


def found(spark, docs, **options):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = jaccard.linked(frame, **options).select("doc_id", "n", "component").collect()
    return sorted(map(tuple, rows), key=str)


def test_against_all_pairs(spark, docs):
    assert found(spark, docs) == brute(docs)


def test_other_similarity(spark, docs):
    assert found(spark, docs, size=5, least=(80, 100)) == brute(docs, 5, (80, 100))


def test_many_tiles(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_WEIGHT", 1500)
    assert found(spark, docs) == brute(docs)


def test_sets_of_very_different_sizes(spark):
    """Below a half, bitmaps of very different lengths are compared."""
    words = [f"word{k}" for k in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:100])), (3, " ".join(words[:30])), (4, "nothing of the kind in here")]
    assert found(spark, rows, size=1, least=(24, 100)) == brute(rows, 1, (24, 100))
    assert {c for _, n, c in found(spark, rows, size=1, least=(24, 100)) if n > 30} == {1}


def test_null_and_repeated_ids(spark):
    text = "some text that is long enough to have shingles"
    rows = [(None, text), (5, text), (5, text), (None, "another text that nobody else has at all"), (7, None), (7, "")]
    assert found(spark, rows) == brute(rows)


def test_one_of_each_group_stays(spark, docs):
    more = [(d, t, "x", n, 0) for n, (d, t) in enumerate(docs)] + [(docs[40][0], docs[40][1], "x", 40, 0)]
    frame = spark.createDataFrame(more, "doc_id long, text string, node string, n int, component int")
    kept = jaccard.deduplicated(frame)
    assert kept.columns == frame.columns
    blank = sum(not (t or "").strip() for _, t in docs)
    groups = {c for d, n, c in brute(docs) if n}
    rows = [r["doc_id"] for r in kept.collect()]
    assert len(rows) == len(groups) + blank
    assert groups <= set(rows)


def test_empty(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string").limit(0)
    assert jaccard.linked(frame).count() == 0
    assert jaccard.deduplicated(frame).count() == 0


def test_hashes_follow_words_not_places():
    def hashes(*texts):
        raw = [t.encode() for t in texts]
        flat, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
        return jaccard.word_hashes(flat, offsets)

    got, at = hashes("Ab c", "xab", "c ab\tb", "", "b")
    assert at.tolist() == [0, 2, 3, 6, 6, 7]
    assert got[0] == got[4] and got[1] == got[3] and got[5] == got[6]
    assert len({int(x) for x in got}) == 4


@pytest.mark.parametrize("finish", [graph.FINISH, 7])
def test_components(spark, finish):
    draw = random.Random(2)
    edges = [(n, n + 1) for n in range(0, 60)] + [(100, n) for n in range(101, 400)] + [(7, 7), (500, 501), (501, 500)]
    edges += [(draw.randrange(1000, 1200), draw.randrange(1000, 1200)) for _ in range(80)]
    label = {}

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    got = graph.components(spark.createDataFrame(edges, "u long, v long").repartition(4), finish).collect()
    alone = {x for x in label if not any(x in e and e[0] != e[1] for e in edges)}
    assert {r["node"]: r["component"] for r in got} == {x: root(x) for x in label if x not in alone}
    assert len(got) == len({r["node"] for r in got})
    none = spark.createDataFrame([], "u long, v long")
    assert graph.components(none).count() == 0
    assert graph.components(none).agg(F.count("node")).first()[0] == 0


def test_runs_reach_over_batches():
    """However a sorted stream of tokens is cut into batches, the edges are the same."""

    class Stream:
        def __getattr__(self, name):
            return lambda *args: setattr(self, "work", args[0]) or self if name == "mapInArrow" else self

    stream = Stream()
    jaccard.group_edges(stream, (85, 100))
    draw = random.Random(1)
    for _ in range(60):
        rows = [(draw.randrange(8), n, n * 100 + draw.randrange(9)) for n in draw.choices((10, 11, 12, 30, 31, 100), k=40)]
        unique = sorted(set(rows))
        rows, expected, i = sorted(rows), set(), 0
        while i < len(unique):
            k = i + 1
            while k < len(unique) and unique[k][0] == unique[i][0] and 100 * unique[k - 1][1] >= 85 * unique[k][1]:
                k += 1
            expected |= {(x[2], unique[i][2], k - i == 2) for x in unique[i + 1 : k]}
            i = k
        cuts = [0, *sorted(draw.sample(range(len(rows) + 1), k=draw.randrange(9))), len(rows)]
        batches = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            columns = [[r[c] for r in rows[a:b]] for c in range(3)]
            kinds = (pa.int64(), pa.int32(), pa.int64())
            batches.append(pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["token", "n", "node"]))
        found = {(r["u"], r["v"], r["alone"]) for batch in stream.work(iter(batches)) for r in batch.to_pylist()}
        assert found == expected


@pytest.mark.parametrize("least", [(85, 100), (80, 100), (24, 100)])
def test_similar_sets_have_a_part_in_common(least):
    draw = np.random.default_rng(5)
    rare = np.ones(jaccard.CELLS, dtype=bool)
    similar = shared = 0
    for _ in range(1500):
        n = int(draw.choice((1, 2, 6, 7, 20, 100, 900)))
        pool = np.unique(draw.integers(0, 2**64, 3 * n + 3, dtype=np.uint64))
        draw.shuffle(pool)
        both = int(draw.integers(0, n + 1)) if draw.random() < 0.5 else n - int(n * draw.random() * (1 - least[0] / least[1]))
        more = n - both if draw.random() < 0.5 else int(draw.integers(0, n + 2))
        a, b = np.sort(pool[:n]), np.sort(np.concatenate([pool[:both], pool[n : n + more]]))
        rare[(pool[: n // 3] & np.uint64(jaccard.CELLS - 1)).astype(np.int64)] = False
        if len(b) and least[1] * both >= least[0] * (n + more):
            similar += 1
            assert set(jaccard.part_signatures(a, rare, least).tolist()) & set(jaccard.part_signatures(b, rare, least).tolist())
        elif len(b) and 10 * both <= 2 * (n + more) and n >= 100 and least[0] >= 80:
            shared += bool(set(jaccard.part_signatures(a, rare, least).tolist()) & set(jaccard.part_signatures(b, rare, least).tolist()))
        rare[:] = True
    assert similar > 300
    assert shared < 10


def chance_texts(vocabulary):
    """Texts that share each of their words with a few others, but never many with the same one, and near copies."""
    draw = random.Random(8)
    words = [f"w{k}" for k in range(vocabulary)]
    texts = [draw.sample(words, 100) for _ in range(300)]
    texts += [t[:97] + draw.sample(words, 3) for t in texts[:30]]
    return [(k, " ".join(t)) for k, t in enumerate(texts)]


def pairs_dealt(monkeypatch):
    """A list that gets the number of tile pairs of each step to come."""
    dealt, links = [], jaccard.links
    monkeypatch.setattr(jaccard, "TILE_WEIGHT", 2000)
    monkeypatch.setattr(jaccard, "links", lambda tiles, sets, pairs, least, exact: dealt.append(pairs.count()) or links(tiles, sets, pairs, least, exact))
    return dealt


def test_chance_leaves_no_large_groups(spark, monkeypatch):
    rows, dealt = chance_texts(3000), pairs_dealt(monkeypatch)
    assert found(spark, rows, size=1) == brute(rows, 1)
    assert max(dealt) < 100


def test_one_stays_where_chance_joins_texts(spark, monkeypatch):
    """As the pipeline joins near copies: 0.8 or more, one document of each group."""
    rows, dealt = chance_texts(9000), pairs_dealt(monkeypatch)
    kept = jaccard.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), size=1, least=(80, 100))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in brute(rows, 1, (80, 100))})
    assert max(dealt) < 100
