"""Shards are a permutation: whole, even, and the same however the rows lie."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollbook.llm import feistel


@pytest.mark.parametrize("rows", [1, 2, 3, 5, 16, 17, 1000, 4099])
def test_places_are_a_permutation(spark, rows):
    numbers = spark.range(rows).withColumn("total", F.lit(rows).cast("long"))
    for seed in (0, 9):
        got = [r["place"] for r in feistel.with_place(numbers, "id", "total", "place", seed).collect()]
        assert sorted(got) == list(range(rows))


def table(spark, rows=997):
    data = [(None if n % 50 == 0 else n, None if n % 70 == 0 else "t" * (n % 9), n % 3) for n in range(rows)]
    data += [(7, "copy", 0)] * 400  # a third of all rows
    return spark.createDataFrame(data, "doc_id long, text string, shard int")


def test_shards(spark):
    docs = table(spark).withColumnRenamed("shard", "bucket")
    found = feistel.shard(docs, 40)
    rows = found.collect()
    assert found.columns == ["doc_id", "text", "bucket", "shard", "slot"]
    assert Counter(tuple(r)[:3] for r in rows) == Counter(map(tuple, docs.collect()))
    slots: dict[int, list[int]] = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(slots) == list(range(40))
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_order_and_partitions_change_nothing(spark):
    docs = table(spark)
    first = sorted(map(str, feistel.shard(docs, 7, seed=3).collect()))
    assert sorted(map(str, feistel.shard(docs.repartition(13).orderBy("text"), 7, seed=3, buckets=4096).collect())) == first
    assert sorted(map(str, feistel.shard(docs, 7, seed=4).collect())) != first


def test_empty_and_wrong(spark):
    assert feistel.shard(table(spark).limit(0), 40).count() == 0
    with pytest.raises(ValueError):
        feistel.shard(table(spark), 0)
