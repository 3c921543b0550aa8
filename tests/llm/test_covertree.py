"""Top products against all products."""

from __future__ import annotations

import math
import pickle

import numpy as np
import pytest

from rollbook.llm import covertree


def brute(rows, k, scale=1024, step=10):
    whole = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(scale * x) for x in v]
        whole[i] = min(whole.get(i, q), q)
    out = []
    for i, q in whole.items():
        if i % step == 0:
            scores = [(-sum(a * b for a, b in zip(q, w, strict=False)), j) for j, w in whole.items() if j != i]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def case(rows=900, width=12):
    draw = np.random.default_rng(8)
    centres = draw.normal(size=(6, width))
    data = [(n, (centres[n % 6] * 0.3 + draw.normal(size=width) * 0.2).tolist()) for n in range(rows)]
    same = data[5][1]
    data += [(n, same) for n in range(rows, rows + 400)]  # ties, and a third of all rows
    data += [(5000, None), (5010, [float("nan")] * width), (5020, [1.0, None] + [0.0] * (width - 2)), (5030, [float("inf")] * width)]
    data += [(5040, []), (5050, [1.5]), (5060, [0.0] * (width + 3)), (None, same), (20, data[20][1]), (30, same)]
    return data


@pytest.fixture(scope="module")
def rows():
    return case()


def found(spark, rows, k=10):
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int").repartition(3)
    vectors = covertree.vectors(frame, "vec_id", "embedding", 1024)
    got = covertree.top_k(vectors, vectors.filter("id % 10 = 0"), k)
    return sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect()))


def test_against_all_products(spark, rows):
    assert found(spark, rows) == brute(rows, 10)


def test_small_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(covertree, "BLOCK", 60)
    monkeypatch.setattr(covertree, "QUERY_BLOCK", 20)
    assert found(spark, rows, 3) == brute(rows, 3)


def test_fewer_rows_than_asked(spark):
    few = [(0, [0.5, -0.5]), (10, [0.25, 0.0]), (3, [-1.0, 1.0])]
    assert found(spark, few) == brute(few, 10)
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, []) == []


def test_large_numbers_stay_exact(spark):
    large = [(n, [2.0**19 + n, -(2.0**20) + n * 3]) for n in range(40)]
    assert found(spark, large) == brute(large, 10)


def test_tree_prunes_and_covers():
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(20, 6)) * 4000
    points = (centres[draw.integers(20, size=3000)] + draw.normal(size=(3000, 6)) * 20).astype(np.int64)
    tree = covertree.Tree(np.arange(3000), points)
    for a, b, centre, radius in zip(tree.first, tree.last, tree.centres, tree.radii, strict=True):
        assert covertree.distances(tree.points[a:b], centre).max() <= radius + 1e-6
    queries = covertree.Tree(np.arange(3000, 3040), points[:40], leaf=4)
    search = covertree.Search(queries, 5, np.full(40, covertree.NOTHING))
    search.against(tree)
    assert search.scored < 0.5 * 40 * 3000


def test_clusters_of_64_dimensions_are_pruned():
    """With kth scores from the nearest block, hardly a leaf of the other clusters is scored."""
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(40, 64)) * 1000
    member = draw.integers(40, size=4000)
    points = (centres[member] + draw.normal(size=(4000, 64)) * 60).astype(np.int64)
    tree = covertree.Tree(np.arange(4000), points)
    queries = covertree.Tree(np.arange(4000, 4100), points[:100], leaf=covertree.QUERY_LEAF)
    search = covertree.Search(queries, 10, np.full(100, covertree.NOTHING))
    search.against(tree)
    assert search.scored < 0.25 * 100 * 4000
    scores = points[queries.ids - 4000] @ points.T
    assert (np.sort(search.scores, axis=1) == np.sort(scores, axis=1)[:, -10:]).all()


def test_groups_are_divided_by_cover(spark, monkeypatch):
    """A table of many groups gets narrower blocks, and equal vectors are dealt by id."""
    monkeypatch.setattr(covertree, "BLOCK", 50)
    draw = np.random.default_rng(4)
    points = draw.integers(-1000, 1000, size=(3000, 4)).tolist() + [[7, 7, 7, 7]] * 400
    rows = spark.createDataFrame([(n, v) for n, v in enumerate(points)], "id long, v array<long>")
    data = covertree.trees(rows, covertree.centres_of(rows), covertree.BLOCK, 8).collect()
    held = [pickle.loads(r["tree"]) for r in data]
    assert sorted(i for t in held for i in t.ids.tolist()) == list(range(3400))
    assert max(len(t.ids) for t in held) <= 2 * covertree.BLOCK
    assert np.median([r["radius"] for r in data]) < 500
