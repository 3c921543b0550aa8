"""Language models: probabilities, held-out accuracy, odd texts."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollbook.llm import langid
from rollbook.llm.queries import NAMED

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return langid.trained(docs.filter(langid.remainder("doc_id", 4) != 2))


def test_held_out_accuracy(spark, docs):
    rows = NAMED["op4_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 200
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.99 * len(rows)
    assert sum(r["rejected"] for r in rows) <= 0.01 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def symbol_scores(model, packed, order):
    """Log-probabilities by gram and language, by way of the model's joins."""
    spark = model.grams[1].sparkSession
    mask = (1 << (langid.CLASS_BITS * order)) - 1
    keys = [g & mask if order < langid.ORDER else g for g in packed.tolist()]
    wanted = spark.createDataFrame([(g,) for g in dict.fromkeys(keys)], "gram long")
    found = {r["gram"]: r["scores"] for r in model.scored(wanted, order).collect()}
    return np.array([found[g] for g in keys])


def kneser_ney(words):
    """Probabilities of (context, symbol) by plain dictionaries; words end in a blank."""
    counts = {langid.ORDER: Counter()}
    for word in words:
        symbols = [*word, " "]
        for i, c in enumerate(symbols):
            counts[langid.ORDER][(*[""] * (3 - min(i, 3)), *symbols[max(0, i - 3) : i], c)] += 1
    for order in (3, 2, 1):
        counts[order] = Counter(g[1:] for g in counts[order + 1])

    def discount(order):
        ones, twos = (sum(n == k for n in counts[order].values()) for k in (1, 2))
        return min(max(ones / (ones + 2 * twos), 0.1), 0.9) if ones + twos else 0.5

    off = {order: discount(order) for order in counts}

    def p(gram):
        order = len(gram)
        if not order:
            return 2.0**-langid.CLASS_BITS
        after = {g: n for g, n in counts[order].items() if g[:-1] == gram[:-1]}
        if not after:
            return p(gram[1:])
        total = sum(after.values())
        return max(after.get(gram, 0) - off[order], 0) / total + off[order] * len(after) / total * p(gram[1:])

    return p


def test_against_plain_dictionaries(spark):
    said = {"aa": "the cat sat on the mat that the cat ate 한국어 한국말 漢字漢", "bb": "el gato come el pan y el perro \U00020000\U00020001"}
    model = langid.trained(spark.createDataFrame(list(said.items()), "lang string, text string"))
    tried = ["the", "that", "perro", "xq", "한국", "漢字", "cathe"]
    for k, lang in enumerate(model.languages):
        p = kneser_ney(said[lang].split())
        for word in tried:
            packed, _ = langid.grams([word])
            symbols = [*word, " "]
            grams = [(*[""] * (3 - min(i, 3)), *symbols[max(0, i - 3) : i], c) for i, c in enumerate(symbols)]
            assert np.exp(symbol_scores(model, packed, 4)[:, k]) == pytest.approx([p(g) for g in grams], rel=1e-9)


def test_letters_have_classes_of_their_own():
    codes = langid.classes()
    below = [c for c in range(1 << langid.CLASS_BITS) if chr(c).isalpha()]
    assert (codes[below] == below).all()
    beyond = [c for c in range(1 << langid.CLASS_BITS, 0x110000) if chr(c).isalpha()]
    assert not set(codes[beyond].tolist()) & {0, *below}


def test_judged_is_predict_with_trained_rows(spark, docs, model):
    learn = langid.remainder("doc_id", 4) != 2
    columns = ["doc_id", "lang_pred", "score", "rejected"]
    two = langid.judged(docs.select("doc_id", "text", "lang"), learn).select(*columns).collect()
    one = langid.predict(docs.select("doc_id", "text"), model).select(*columns).collect()
    assert sorted(two) == sorted(one)


def test_least_count(spark):
    table = spark.createDataFrame([(g, n) for g, n in enumerate([1, 1, 2, 3, 4, 9, 100])], "gram long, n long")
    held = [table.filter(F.col("n") >= langid.least_count(table, k)).count() for k in range(9)]
    assert held == [0, 1, 2, 3, 3, 5, 5, 7, 7]


def test_probabilities_sum_to_one_at_most(model):
    context = "th"
    total = np.zeros(len(model.languages))
    for c in [*"abcdefghijklmnopqrstuvwxyzäöüßéèêçñíó", " "]:
        packed, _ = langid.grams([context + c] if c != " " else [context])
        total += np.exp(symbol_scores(model, packed[2:3], langid.ORDER)[0])
    assert (total > 0.9).all() and (total < 1 + 1e-3).all()


def test_odd_texts(spark, model):
    rows = [(1, None, "a"), (2, "", "b"), (3, "123 !? ²", "c"), (4, "the " * 60_000, "d"), (4, "the " * 60_000, "d"), (5, "漢字", "e")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = sorted(map(tuple, langid.predict(frame, model).select("doc_id", "lang_pred", "rejected").collect()))
    assert got[:3] == [(1, "und", True), (2, "und", True), (3, "und", True)]
    assert got[3:5] == [(4, "en", False)] * 2
    assert got[5][1] in model.languages
    assert langid.predict(frame.limit(0), model).count() == 0


def test_noise_is_rejected_and_short_prose_is_not(spark, model):
    draw = np.random.default_rng(3)
    noise = " ".join("".join(chr(c) for c in draw.integers(97, 123, size=8)) for _ in range(200))
    frame = spark.createDataFrame([(1, noise), (2, "The inther and thation of the")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in langid.predict(frame, model).collect()}
    assert got[1]["rejected"] and not got[2]["rejected"]


def test_nothing_to_learn_from(spark, docs):
    model = langid.trained(docs.withColumn("lang", F.lit(None).cast("string")))
    got = langid.predict(docs.limit(5).drop("lang"), model).collect()
    assert {(r["lang_pred"], r["score"], r["rejected"]) for r in got} == {("und", 0.0, True)}


def test_one_language_and_repeats(spark):
    frame = spark.createDataFrame([("xx", "some words here"), ("xx", "some words here"), (None, "y")], "lang string, text string")
    model = langid.trained(frame)
    assert {r["lang_pred"] for r in langid.predict(frame, model).collect()} == {"xx"}


def test_no_gram_is_cut(spark):
    """Grams counted once keep their probability, however many languages and grams there are."""
    draw = np.random.default_rng(5)
    rows = [(f"l{k:03}", " ".join("".join(chr(c) for c in draw.integers(97, 123, size=8)) for _ in range(12))) for k in range(150)]
    model = langid.trained(spark.createDataFrame([("aa", "quip"), *rows], "lang string, text string"))
    packed, _ = langid.grams(["quip"])
    highest, lower = (np.exp(symbol_scores(model, packed[3:4], order)[0, 0]) for order in (langid.ORDER, langid.ORDER - 1))
    # one count, the largest discount, one continuation of the context
    assert highest == pytest.approx(0.1 + 0.9 * lower, rel=1e-3) and highest > 1.01 * lower


def test_grams_joined_give_the_same_sums(spark, model):
    rows = [(1, "the cat and the dog, the end"), (1, "the cat and the dog, the end"), (2, "el perro y el gato"), (3, None), (None, "zzyzx")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda found: sorted(map(str, found.collect()))
    assert key(langid.predict(frame, model)) == key(langid.predict(frame, model, held=2)) == key(langid.predict(frame, model, held=0))


def test_every_language_has_its_own_limit(spark):
    """One row of 60,000 is enough for a language to have an entropy that it rejects from."""
    lang = F.when(F.col("id") % 10_000 == 1, F.concat(F.lit("z"), (F.col("id") / 10_000).cast("int"))).otherwise("aa")
    rows = spark.range(60_000).select(lang.alias("lang"), F.concat(F.lit("some words here "), F.col("lang")).alias("text"))
    model = langid.trained(rows)
    assert len(model.languages) == 7 and np.isfinite(model.most).all()
