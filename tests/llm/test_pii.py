"""Patterns against plain regular expressions, the field on lines that it has not seen."""

from __future__ import annotations

import random
import re

import pytest

from rollbook.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text: str):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            keep = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if keep:
                found.append((m.start(), m.end(), kind))
    return sorted(found, key=lambda s: (s[0], pii.ORDER[s[2]]))


TEXTS = [
    "", "a@b.c", "@b.c x@@y.zz", "a@b@c.dd", "x.y+z%q@sub-1.example.co.uk.", "a@b", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (988) 555-2485", "+1234567890123456", "++1 2345678901", "4111111111111111.5.5.5",
]


@pytest.mark.parametrize("text", TEXTS)
def test_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_random_patterns():
    draw = random.Random(3)
    for _ in range(5000):
        text = "".join(draw.choice("ab@.-+ 0123456789().%é") for _ in range(draw.randint(0, 60)))
        assert pii.base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+" * 200_000, "a@" * 100_000):
        pii.base_spans(text)


def test_field_on_unseen_lines():
    lines = pii.labelled_lines(seed=99)
    field = pii.trained()
    right = sum(pii.field_spans(field, [line])[0] == spans for line, spans in lines)
    assert right >= 0.97 * len(lines)
    together = pii.field_spans(field, [line for line, _ in lines])
    assert together == [pii.field_spans(field, [line])[0] for line, _ in lines]


def test_field_leaves_plain_text_alone():
    assert pii.field_spans(pii.trained(), ["", "\n\n", "The quick fox. It ran, and was gone.", "A B C D\nE F G"]) == [[], [], [], []]


def test_lines_left_out_have_no_span():
    """Deciding a line by its bound gives what decoding it gives."""
    import duckdb
    import numpy as np

    field, draw = pii.trained(), random.Random(6)
    docs = duckdb.connect().execute("SELECT text FROM '/root/testdata/sf0.001/documents.parquet' WHERE text IS NOT NULL").fetchall()
    lines = [line for (text,) in docs for line in text.split("\n")]
    lines += [line for line, _ in pii.labelled_lines(seed=3)]
    mixed = [w for line in lines for w in line.split()]
    lines += [" ".join(draw.choice(mixed) for _ in range(draw.randint(1, 30))) for _ in range(3000)]
    words = [line.split() for line in lines if line.split()]
    sizes = np.array(list(map(len, words)))
    scores = field.emissions(field.lookup(words, int(sizes.sum())), sizes)
    inside = np.maximum.reduceat(pii.labelled(field, scores, sizes) != 0, np.cumsum(sizes) - sizes)
    held = field.may_hold(scores, sizes)
    assert not (inside & ~held).any()
    assert inside.sum() > 100 and held.mean() < 0.6


UNSEEN = [
    ("Please ask for {person} at the desk", "person", False), ("Mr {person} signed the form", "person", True),
    ("Yours sincerely, Mrs. {person}", "person", True), ("Name: {person}, born in spring", "person", True),
    ("Dr {person} will see you", "person", True), ("his SSN {identity} is on file", "identity", True),
    ("passport {identity}", "identity", True), ("the identity number {identity} was wrong", "identity", True),
    ("set password={secret} before you start", "secret", True), ('api_key = "{secret}"', "secret", True),
    ("token: {secret} is valid", "secret", True), ("use secret={secret} here", "secret", True),
]


def test_recall_and_precision_on_other_templates():
    """Lines that no training template gives; announced kinds only, as the field knows words by what announces them."""
    draw, field = random.Random(11), pii.trained()
    given, family = ("Olga", "Ivan", "Sofia", "Karl", "Ines", "Noah"), ("Novak", "Rossi", "Petrov", "Schmidt", "Silva", "Olsen")
    filler = {
        "person": lambda: f"{draw.choice(given)} {draw.choice(family)}",
        "identity": lambda: f"{draw.randint(100, 999)}-{draw.randint(10, 99)}-{draw.randint(1000, 9999)}",
        "secret": lambda: "".join(draw.choice("0123456789abcdef") for _ in range(draw.randint(16, 40))) + "0",
    }
    right = wanted = found = 0
    for template, kind, counts in UNSEEN:
        for _ in range(20 if counts else 0):
            value = filler[kind]()
            start = template.index("{")
            got = pii.field_spans(field, [template.replace("{" + kind + "}", value)])[0]
            wanted, found = wanted + 1, found + len(got)
            right += (start, start + len(value), kind) in got
    assert right >= 0.9 * wanted and right >= 0.9 * found


def test_viterbi_is_the_best_path():
    import itertools

    import numpy as np

    draw = np.random.default_rng(5)
    n = len(pii.STATES)
    moves, first = draw.normal(size=(n, n)), draw.normal(size=n)
    lengths = np.array([1, 2, 4])
    scores = draw.normal(size=(3, 4, n))
    found = pii.viterbi(scores, lengths, moves, first)
    for k, length in enumerate(lengths):
        def worth(path, k=k):
            return first[path[0]] + sum(scores[k, t, s] for t, s in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(path))

        best = max(itertools.product(range(n), repeat=int(length)), key=worth)
        assert tuple(found[k, :length]) == best


def test_columns(spark):
    secret = "password=0f0f12ab99 mail a.b@c.de ok"
    docs = spark.createDataFrame(
        [(1, secret, "x"), (2, None, "y"), (3, "", None), (1, secret, "x"), (4, "clean words " * 20_000, "z")],
        "doc_id long, text string, spans string",
    )
    rows = pii.find(docs, redact="text").collect()
    assert [f for f in rows[0].asDict()] == ["doc_id", "base", "spans", "text"]
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == 5
    assert by_id[1]["base"] == "email:25:33"
    assert by_id[1]["spans"] == "secret:9:19,email:25:33"
    assert by_id[1]["text"] == "password=<secret> mail <email> ok"
    assert by_id[2]["text"] is None and by_id[2]["spans"] == ""
    assert by_id[4]["text"] == "clean words " * 20_000
    assert pii.find(docs.limit(0)).count() == 0
