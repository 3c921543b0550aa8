"""Windows of benchmark items in documents against plain search."""

from __future__ import annotations

import random
import re

import pytest

from rollbook.llm import decontaminate, storage

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(decontaminate.UPPER, decontaminate.UPPER.lower())


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        own = words(text)
        for a in range(max(1, len(own) - 12)) if own else ():
            windows.setdefault(tuple(own[a : a + 13]), set()).add(item)
    found = []
    for doc, text in docs:
        own, hit, seen = words(text), set(), set()
        for n in {len(w) for w in windows}:
            for a in range(len(own) - n + 1):
                if (w := tuple(own[a : a + n])) in windows:
                    hit.update(range(a, a + n))
                    seen |= windows[w]
        listed = sorted(str(i) for i in seen if i is not None)
        found.append((doc, len(own), len(hit), listed, len(hit) > 0 and 20 * len(hit) >= len(own)))
    return sorted(found, key=str)


def case(short: bool):
    draw = random.Random(4)
    vocabulary = ["the", "of", "Émile", "x1", "don", "t", *(f"w{n}" for n in range(40))]
    text = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    items = [(n, text(draw.choice((13, 14, 30, 60)))) for n in range(12)]
    items += [(3, items[3][1]), (50, None), (51, ""), (52, "!!"), (None, text(20))]
    if short:
        items += [(60, "w1"), (61, "w2 w3"), (62, "the of w4"), (63, text(7))]
    docs = [(100, None), (101, ""), (102, "..."), (103, text(5)), (104, text(30_000))]
    for n in range(60):
        passage = items[draw.randrange(12)][1].split()
        a = draw.randrange(len(passage))
        part = " ".join(passage[a : a + draw.choice((5, 13, 40))]).upper()
        docs.append((n % 50, f"{text(draw.randrange(80))}, {part}! {text(draw.randrange(80))}"))
    docs += [docs[-1]] * 40
    return docs, items


@pytest.mark.parametrize("short", [False, True])
def test_against_plain_search(spark, short):
    docs, items = case(short)
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, words string, runs int")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contamination(frame, benchmark).select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    assert sorted(map(tuple, rows), key=str) == brute(docs, items)
    bad = {text for (_, text), r in zip(docs, [brute([d], items)[0] for d in docs], strict=True) if r[4]}
    kept = decontaminate.decontaminated(frame, benchmark)
    assert kept.columns == frame.columns
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(
        map(str, frame.filter(~frame.text.isin(list(bad)) | frame.text.isNull()).select("doc_id", "text").collect())
    )


def test_empty_tables(spark):
    docs, items = case(False)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.contamination(frame.limit(0), benchmark).count() == 0
    rows = decontaminate.contamination(frame, benchmark.limit(0)).collect()
    assert len(rows) == len(docs) and not any(r["contaminated"] or r["n_hit"] for r in rows)


def test_no_more_files_than_needed(spark, monkeypatch):
    own, folders = spark.newSession(), {}
    own.conf.set("spark.sql.shuffle.partitions", "97")
    own.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def kept(df, name, files=None):
        found = storage.written(df, name, files)
        folders.setdefault(name, []).append(len(found.inputFiles()))
        return found

    monkeypatch.setattr(decontaminate, "written", kept)
    docs, items = case(False)
    frame = own.createDataFrame(docs, "doc_id long, text string").coalesce(4)
    benchmark = own.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(frame, benchmark)
    out = storage.written(found, "result")
    assert set(folders) == {"windows", "marked", "prefix"}
    assert max(folders["windows"] + folders["prefix"]) <= decontaminate.FILES
    assert len(out.inputFiles()) <= folders["marked"][0] <= 4
    rows = out.select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    assert sorted(map(tuple, rows), key=str) == brute(docs, items)
