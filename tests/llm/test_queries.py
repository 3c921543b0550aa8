"""The queries' contracts, and their SQL statements where there are any."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import pytest

import __spark_entry__ as contract
from rollbook.llm.oracle import STATEMENTS
from rollbook.llm.queries import NAMED

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")
COLUMNS = {
    "op1_quality_rules": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2_cover_tree_top_k": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op3_feistel_sharding": {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int",
    },
    "op4_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op5_benchmark_decontamination": {
        "doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean",
    },
    "op6_jaccard_components": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op7_personal_data": {
        "doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string",
    },
    "op8_page_extraction": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op9_byte_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op10_chat_formatting": {
        "conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint",
    },
    "op11_conversation_trie": {
        "conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint",
        "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string",
    },
    "op12_quality_votes": {
        "doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
        "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean",
    },
    "op13_embedding_whitening": {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double",
        "identity_error": "double",
    },
}


def test_all_are_registered():
    assert set(NAMED) == set(COLUMNS)
    assert {*NAMED, "pipeline"} <= set(contract.queries())
    assert set(STATEMENTS) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, name):
    kinds = dict(NAMED[name](spark, SF).dtypes)
    assert {c: kinds[c] for c in COLUMNS[name]} == COLUMNS[name]


@pytest.mark.parametrize("name", STATEMENTS)
def test_statement(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    columns = list(COLUMNS[name])
    got = NAMED[name](spark, SF).select(*columns).collect()
    listed = ", ".join(columns)
    expected = con.execute(f"SELECT {listed} FROM ({STATEMENTS[name]})").fetchall()
    key = lambda row: tuple((x is not None, x) for x in row)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def test_shards_of_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = NAMED["op3_feistel_sharding"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "rows", None)


def test_digests_of_ids(spark):
    import public_tokenizers
    import tiktoken

    from rollbook.llm import byte_bpe

    ranks = byte_bpe.Vocabulary(public_tokenizers.path(byte_bpe.RANKS)).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = NAMED["op9_byte_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_base_spans_of_documents(spark):
    from test_pii import brute

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in NAMED["op7_personal_data"](spark, SF).collect():
        base = brute(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [
            sum(kind == k for *_, kind in base) for k in ("email", "ip", "card", "phone")
        ]
        assert {f"{k}:{a}:{b}" for a, b, k in base} <= set(r["spans"].split(","))
