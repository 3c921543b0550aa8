"""Rule ensemble: held-out ranking, compiled rules, odd cases."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollbook.llm import rules
from rollbook.llm.queries import NAMED

SF = "/root/testdata/sf0.01"


def area(score: np.ndarray, label: np.ndarray) -> float:
    rank = np.argsort(np.argsort(score))
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(label) - ones))


def test_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    scored = NAMED["op1_quality_rules"](spark, SF)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = scored.join(labels, "doc_id").filter("held_out").toPandas()
    assert area(rows["score"].to_numpy(), rows["quality"].to_numpy()) > 0.97
    assert (rows["predicted"] == rows["quality"]).mean() > 0.95
    assert scored.filter("score < 0 OR score > 1 OR score IS NULL").isEmpty()


def test_rules_are_found_and_sparse(spark):
    draw = np.random.default_rng(2)
    x = draw.random((3000, len(rules.STATISTICS)))
    y = ((x[:, 3] > 0.6) & (x[:, 5] <= 0.5)).astype(float)
    model = rules.fit(x, y)
    used = {name for bounds, _ in model.rules for name, _, _ in bounds}
    assert {rules.STATISTICS[3], rules.STATISTICS[5]} <= used
    frame = spark.createDataFrame([[float(v) for v in row] for row in x[:400]], list(rules.STATISTICS))
    got = np.array([r[0] for r in frame.select(model.score()).collect()])
    assert area(got, y[:400]) > 0.99


@pytest.mark.parametrize("labels", [[], [1.0] * 5, [0.0] * 5])
def test_little_to_learn(spark, labels):
    model = rules.fit(np.zeros((len(labels), len(rules.STATISTICS))), np.array(labels))
    score = spark.range(1).select(model.score()).first()[0]
    assert score == pytest.approx((sum(labels) + 1) / (len(labels) + 2))


def test_odd_texts(spark):
    rows = [(1, None, 5), (2, "", 5), (2, "", 5), (3, "\n\n", 5), (4, "word " * 60_000, 5), (5, "é漢😀", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, word_bytes int")
    stats = rules.with_statistics(frame)
    assert stats.columns == ["doc_id", *rules.STATISTICS]
    got = {r["doc_id"]: r for r in stats.collect()}
    assert stats.count() == 6
    assert all(got[1][c] == 0 for c in rules.STATISTICS) and all(got[2][c] == 0 for c in rules.STATISTICS)
    assert got[4]["share_different_words"] == pytest.approx(1 / 60_000)
    assert got[5]["share_other"] == 1.0
    assert stats.filter(F.isnan("word_bytes")).isEmpty()
    assert rules.with_statistics(frame.limit(0)).count() == 0


def plain_statistics(text):
    """The 18 statistics of a text in plain Python."""
    raw, words, lines = text.encode(), text.split(), text.split("\n") if text else []
    over = lambda a, b: a / b if b else 0.0
    own = {c: sum(x in members for x in raw) for c, members in rules.CLASSES.items()}
    return {
        "log_bytes": math.log1p(len(raw)), "log_words": math.log1p(len(words)), "log_lines": math.log1p(len(lines)),
        **{f"share_{c}": over(n, len(raw)) for c, n in own.items()},
        "share_other": over(sum(x >= 0x80 for x in raw), len(raw)),
        "word_bytes": over(len(raw) - own["spaces"], len(words)),
        "longest_word": float(max(map(len, words), default=0)),
        "share_different_words": over(len(set(words)), len(words)),
        "share_short_words": over(sum(len(w) <= 3 for w in words), len(words)),
        "share_different_lines": over(len(set(lines)), len(lines)),
        "line_bytes": over(len(raw), len(lines)),
        "words_a_stop": over(len(words), own["stops"]),
    }


def test_statistics_and_rules_against_plain_python(spark):
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["", "a", "\n", "é 漢 😀!", "tab\tand\nlines\n\nA B", "UPPER lower 123 #$%"]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, text string").repartition(3)
    draw = np.random.default_rng(5)
    want = [plain_statistics(t) for t in texts]
    names = list(rules.STATISTICS)
    assert set(want[0]) == set(names)
    made = []
    for _ in range(40):
        bounds = []
        for name in draw.choice(names, size=int(draw.integers(1, 4)), replace=False):
            # a bound that is no text's value: both sides have room for rounding
            values = sorted({w[name] for w in want})
            at = int(draw.integers(len(values)))
            bounds.append((str(name), str(draw.choice(["above", "upto"])), (values[at] + values[min(at + 1, len(values) - 1)]) / 2 + 1e-9))
        made.append((tuple(bounds), float(draw.normal())))
    model = rules.RuleEnsemble(0.25, tuple(made))
    got = rules.with_statistics(frame).withColumn("score", model.score()).collect()
    assert len(got) == len(texts)
    for r in got:
        w = want[r["n"]]
        assert [r[c] for c in names] == pytest.approx([w[c] for c in names], rel=1e-12)
        total = 0.25 + sum(weight for bounds, weight in made if all((w[c] > x) == (side == "above") for c, side, x in bounds))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)), rel=1e-9)


def test_the_same_rules_whatever_the_partitions(spark):
    draw = np.random.default_rng(7)
    rows = [(n, float(n % 2), *map(float, draw.random(len(rules.STATISTICS)))) for n in range(1200)]
    schema = "doc_id long, quality double, " + ", ".join(f"{c} double" for c in rules.STATISTICS)
    frame = spark.createDataFrame(rows, schema)
    assert rules.trained(frame.repartition(7), "quality", rows=300) == rules.trained(frame.coalesce(1), "quality", rows=300)
