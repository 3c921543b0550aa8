"""Shards by a keyed permutation of global row numbers.

Rows are numbered 0 to N-1 in the order of all their columns within hash buckets and
the buckets one after another.  A Feistel network permutes the numbers; position p
goes to shard p mod S, slot p div S, so shards differ by one row at most, slots have
no gaps, and a row's place follows from its number, N, S and the seed alone.

The network works on the rectangle a x b with a = ceil(sqrt N) and b = ceil(N / a):
halves l and r change places while l becomes (l + F(r)) modulo its side.  Of the a * b
cells fewer than a lie outside 0..N-1; a number that lands there walks on through the
network until it is inside (cycle walking), at most a * b - N steps.  Beyond
``MOST_STEPS`` needed steps, which takes a chance below N * (1 / sqrt N) ** 64, the
query fails rather than give a wrong place.

Fully equal rows are counted first and numbered together, so copies of a row never
meet in one task.  Nulls in any column count as values; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 6
MOST_STEPS = 64
#: Rows of the table of bucket offsets, which is broadcast.
BUCKETS = 4096


def _step(state: Column, k: Column, seed: int) -> Column:
    """One round: the halves change places, the former left is moved along its side."""
    moved = F.pmod(state["l"] + F.pmod(F.xxhash64(state["r"], k, F.lit(seed)), state["a"]), state["a"])
    return F.struct(
        state["r"].alias("l"), moved.alias("r"), state["b"].alias("a"), state["a"].alias("b")
    )


def _network(x: Column, a: Column, b: Column, seed: int) -> Column:
    start = F.struct(F.pmod(x, a).alias("l"), F.floor(x / a).cast("long").alias("r"), a.alias("a"), b.alias("b"))
    rounds = F.array(*(F.lit(k) for k in range(ROUNDS)))
    # an even number of rounds leaves the sides where they were
    return F.aggregate(rounds, start, lambda s, k: _step(s, k, seed), lambda s: s["l"] + s["r"] * s["a"])


def sides(total: Column) -> tuple[Column, Column]:
    """Sides a, b of the smallest near-square rectangle with at least ``total`` cells."""
    a = F.greatest(F.ceil(F.sqrt(total.cast("double"))).cast("long"), F.lit(1))
    return a, F.ceil(total / a).cast("long")


def with_place(df: DataFrame, number: str, total: str, out: str, seed: int) -> DataFrame:
    """``df`` with the place of ``number`` in a permutation of 0..total-1."""
    a, b, n = F.col("a_"), F.col("b_"), F.col(total)
    wide, high = sides(n)
    first = df.withColumns({"a_": wide, "b_": high}).withColumn(out, _network(F.col(number), a, b, seed))
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(MOST_STEPS)),
        F.col(out),
        lambda at, _: F.when(at < n, at).otherwise(_network(at, a, b, seed)),
    )
    return first.withColumn(out, F.when(F.col(out) < n, F.col(out)).otherwise(walk)).drop("a_", "b_")


def numbered(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``df`` with ``row_number_`` from 0 and ``rows_``, their count; the same for the same rows in any order."""
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies_"))
    dealt = counted.withColumn("bucket_", F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy("bucket_").agg(F.sum("copies_").alias("size_"))
    # at most ``buckets`` rows, which bounds both this window and the broadcast
    upto = Window.orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "bucket_",
        F.coalesce(F.sum("size_").over(upto), F.lit(0)).alias("offset_"),
        F.sum("size_").over(Window.partitionBy()).alias("rows_"),
    )
    before = Window.partitionBy("bucket_").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("before_", F.coalesce(F.sum("copies_").over(before), F.lit(0)))
    joined = placed.join(F.broadcast(offsets), "bucket_")
    first = F.col("offset_") + F.col("before_")
    return joined.select(
        *columns, "rows_", F.explode(F.sequence(first, first + F.col("copies_") - 1)).alias("row_number_")
    )


def shard(df: DataFrame, shards: int, seed: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """``df`` with ``shard`` and ``slot``, which replace columns of these names."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    rows = numbered(df.select(*kept), buckets)
    placed = with_place(rows, "row_number_", "rows_", "place_", seed)
    sure = F.when(F.col("place_") < F.col("rows_"), F.col("place_")).otherwise(
        F.raise_error(F.lit("cycle walking needs more steps")).cast("long")
    )
    return placed.withColumn("place_", sure).select(
        *kept,
        F.pmod(F.col("place_"), F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("place_") / shards).cast("long").alias("slot"),
    )
