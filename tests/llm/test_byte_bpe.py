"""Token ids against the tiktoken library, and the way back."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import tiktoken

from rollbook.llm import byte_bpe


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(public_tokenizers.path(byte_bpe.RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.vocabulary.ranks, special_tokens={}
    )


TEXTS = [
    "", " ", "  two  spaces ", "a\n\n b", "tab\t x", " leading", "it's we'LL", "é漢字😀 ß", "123 4567", "   a",
    "x\x1cy \x85", "<|endoftext|>", "a" * 700, " " * 900, "ab" * 1000, "!?" * 400, "word\n" * 300,
]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_ids_of_a_text(encoder, library, text):
    ids, offsets = encoder.encode([text, "", text])
    assert ids[: offsets[1]].tolist() == library.encode_ordinary(text)
    assert offsets[1] == offsets[2] and ids[offsets[2] :].tolist() == ids[: offsets[1]].tolist()


def test_random_texts(encoder, library):
    draw = random.Random(1)
    parts = ["a", "b", "  ", "\n", " the", "é", "漢", "😀", "'s", "1", "!", " ", "\t"]
    for _ in range(200):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 300)))
        ids, offsets = encoder.encode([text])
        assert ids.tolist() == library.encode_ordinary(text)
        flat, _ = byte_bpe.decode_ids(encoder.vocabulary, ids, offsets)
        assert flat.tobytes() == text.encode()


def test_forgetting_changes_nothing(encoder, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    for text in ("one two three four five", "six seven", "one two"):
        assert encoder.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_columns(spark, library):
    rows = [(1, "hello world", "kept"), (2, None, None), (2, None, None), (3, "", "x"), (4, "long " * 60_000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = byte_bpe.encode(docs)
    back = byte_bpe.decode(coded).collect()
    assert coded.columns == ["doc_id", "text", "ids"]
    assert sorted(r["doc_id"] for r in back) == [1, 2, 2, 3, 4]
    for r in back:
        assert r["ids"] == library.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert byte_bpe.digests(byte_bpe.encode(docs.limit(0), decoded="decoded"), "doc_id").count() == 0
