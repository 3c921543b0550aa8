"""The operators applied to the supplied tables, one query each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import byte_bpe, chat, covertree, decontaminate, feistel, jaccard, langid, pages, pii, rules, trie, votes, whitening
from rollbook.llm.storage import table, written

SHARDS = 40
NEIGHBOURS = 10
#: Conversations share the beginning of one in so many, fewer turns than HEAD of it.
TWENTY, HEAD = 20, 4


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(langid.remainder("doc_id", 5) == 0, F.lit(False))
    stats = written(rules.with_statistics(docs).withColumn("held_out", held_out), "statistics")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = rules.trained(stats.filter(~F.col("held_out")).join(labels, "doc_id"), "quality")
    scored = stats.select("doc_id", "held_out", model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def cover_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = covertree.vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", scale=1024)
    return covertree.top_k(rows, rows.filter(F.col("id") % 100 == 0), NEIGHBOURS)


def feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    return feistel.shard(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def byte_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.digests(byte_bpe.encode(docs, decoded="decoded"), "doc_id")


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_chats(turns.unionByName(own)))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", F.coalesce(langid.remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    )
    found = langid.judged(docs, ~F.col("held_out"), keep_text=False)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        "contaminated",
    )


def jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.linked(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def page_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"), out="text")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    kinds = F.transform(F.split("base", ","), lambda x: F.substring_index(x, ":", 1))

    def count(kind: str) -> Column:
        return F.size(F.filter(kinds, lambda x: x == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in pii.BASE),
        F.sha2(F.encode("base", "UTF-8"), 256).alias("base_sha256"),
        "spans",
    )


def rebuilt_paths(turns: DataFrame) -> DataFrame:
    """(conv, path): a few first turns of the conversation at the start of its twenty, then its own turns after as many."""
    own = written(trie.turn_keys(turns, "conv_id", "turn", "role", "text"), "turns")
    first = F.col("conv") - F.col("conv") % TWENTY
    heads = own.filter(F.col("conv") == first).select(F.col("conv").alias("base"), F.slice("keys", 1, HEAD - 1).alias("head"))
    taken = F.pmod(F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")), F.lit(HEAD)).cast("int")
    begin = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    rest = F.slice("keys", F.col("h") + 1, F.greatest(F.size("keys") - F.col("h"), F.lit(0)))
    joined = own.withColumns({"base": first, "h": taken}).join(heads, "base", "left")
    return joined.select("conv", trie.path_of(F.concat(begin, rest)).alias("path"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return trie.prefix_trie(rebuilt_paths(turns))


def quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = votes.judged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("quality") >= 0.5)).alias("kept"),
    )


def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    # beyond 64 bits the exact number has no long and is null
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


NAMED = {
    "op1_quality_rules": quality_rules,
    "op2_cover_tree_top_k": cover_tree_top_k,
    "op3_feistel_sharding": feistel_sharding,
    "op4_language_id": language_id,
    "op5_benchmark_decontamination": benchmark_decontamination,
    "op6_jaccard_components": jaccard_components,
    "op7_personal_data": personal_data,
    "op8_page_extraction": page_extraction,
    "op9_byte_bpe": byte_bpe_round_trip,
    "op10_chat_formatting": chat_formatting,
    "op11_conversation_trie": conversation_trie,
    "op12_quality_votes": quality_votes,
    "op13_embedding_whitening": embedding_whitening,
}
