"""Counts and votes against plain Python, and what the votes decide."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollbook.llm import votes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text: str | None) -> dict[str, int]:
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    places = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    count = lambda pattern: len(re.findall(pattern, text))
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": count(r"[#*$%&|<>]"),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(places), "n_lines": len(lines),
        "n_capitals": count("[A-Z]"), "n_letters": count("[A-Za-z]"), "n_marks": count("[!?]"), "n_different": len(set(words)),
    }


TEXTS = [
    None, "", " \n\t ", "one", "a b c d e", "a a a a a", "a a a a a a", "x\ny\nx\n\n \nx ", "b b b b b c d e f g b b b b b",
    "one two three four five six one two three four five", "é漢😀 ##** | <a> & 漢", "A!! B?? C!! D!!", "a\x0bb\x0cc\rd e f",
    "word " * 50_000, " ".join(f"w{k}" for k in range(30_000)), "l\n" * 2000, "tab\tsep\tline\nend\n",
]


def test_counts(spark):
    r = random.Random(2)
    texts = TEXTS + [" ".join(r.choice("abc") for _ in range(r.randrange(40))) + r.choice(["", "\n", "!#"]) for _ in range(300)]
    df = spark.createDataFrame([(k, t, "n") for k, t in enumerate(texts)], "id int, text string, n_words string").repartition(4)
    got = {r["id"]: r.asDict() for r in votes.counts(df).collect()}
    for k, t in enumerate(texts):
        assert {c: got[k][c] for c in votes.COUNTS} == counted(t), t


def python_em(patterns: dict[tuple, int], rules: int) -> dict[tuple, float]:
    share, good, bad = 0.85, [0.99] * rules, [0.3] * rules

    def posterior(v):
        a, b = share, 1 - share
        for x, g, c in zip(v, good, bad, strict=True):
            a *= {1: g, -1: 1 - g, 0: 1}[x]
            b *= {-1: c, 1: 1 - c, 0: 1}[x]
        return a / (a + b)

    for _ in range(votes.STEPS):
        p = {v: posterior(v) for v in patterns}
        all_good, all_rows = sum(n * p[v] for v, n in patterns.items()), sum(patterns.values())
        share = (all_good + 17) / (all_rows + 20)
        for k in range(rules):
            voted = [(v[k], n, p[v]) for v, n in patterns.items() if v[k]]
            good[k] = max(0.99, (sum(n * q for x, n, q in voted if x == 1) + 99) / (sum(n * q for _, n, q in voted) + 100))
            right = (sum(n * (1 - q) for x, n, q in voted if x == -1) + 3) / (sum(n * (1 - q) for _, n, q in voted) + 10)
            bad[k] = max(1 - good[k] + 0.05, right)
    return {v: posterior(v) for v in patterns}


def test_estimates_against_python(spark):
    r = random.Random(4)
    patterns = Counter(tuple(r.choice([1, 1, 1, 0, -1]) for _ in range(4)) for _ in range(500))
    rows = spark.createDataFrame([(list(v), n) for v, n in patterns.items()], "votes array<tinyint>, n long")
    found = votes.estimated(rows, 4)
    got = {tuple(x["votes"]): x["q"] for x in rows.select("votes", found.posterior(F.col("votes")).alias("q")).collect()}
    want = python_em(patterns, 4)
    assert got == pytest.approx(want, rel=1e-9)


def test_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    judged = votes.judged(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")).withColumnRenamed("quality", "p")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = judged.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("quality", failed.alias("failed"), "p").collect()
    clean = [r["p"] for r in rows if r["quality"] == 1 and not r["failed"]]
    junk = [r["p"] for r in rows if r["quality"] == 0]
    assert sum(p >= 0.5 for p in clean) >= 0.99 * len(clean)
    assert sum(p < 0.5 for p in junk) >= 0.9 * len(junk)


def test_one_bad_vote_is_weighed(spark):
    """A rule that also strikes at many good documents costs less than one that does not."""
    noisy, sure = (-1, 1, 1), (1, -1, 1)
    patterns = {(1, 1, 1): 9000, noisy: 60, sure: 300, (1, -1, -1): 700, (-1, -1, -1): 5}
    p = python_em(patterns, 3)
    assert p[noisy] > 0.5 > p[sure]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, votes string, quality string")
    found = votes.judged(df)
    assert found.count() == 0 and found.columns == ["doc_id", *votes.COUNTS, "votes", "quality"]
