"""Equi joins with a bounded date distance, and with one that is open at its end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_within(
    events: DataFrame,
    anchors: DataFrame,
    key: str,
    event_on: str,
    anchor_on: str,
    lo: int,
    hi: int,
    how: str = "inner",
) -> DataFrame:
    """Pairs with ``anchor_on + lo <= event_on <= anchor_on + hi`` and equal ``key``.

    The calendar is cut into buckets as wide as the window.  An anchor covers at
    most two of them and is repeated that often; an event lies in exactly one.
    Joining on (key, bucket) finds each pair once, spreads a key with many events
    over its dates, and leaves the join with another clustering than the
    per-key step after it, so adaptive skew splitting applies without an extra
    exchange.  ``how="left_semi"`` keeps each event once, whatever it matches.
    """
    placed = place_events(events, event_on, lo, hi)
    return join_placed(placed, F.col(event_on), anchors, key, anchor_on, lo, hi, how)


def _bucket(days: Column, lo: int, hi: int) -> Column:
    return F.floor(days / F.lit(hi - lo + 1)).cast("int")


def place_events(events: DataFrame, event_on: str, lo: int, hi: int) -> DataFrame:
    """Dated events with their bucket, which a caller may narrow before ``join_placed`` moves them."""
    day = F.unix_date(F.col(event_on).cast("date"))
    return events.where(F.col(event_on).isNotNull()).withColumn("_bucket", _bucket(day, lo, hi))


def join_placed(
    placed_events: DataFrame,
    on: Column,
    anchors: DataFrame,
    key: str,
    anchor_on: str,
    lo: int,
    hi: int,
    how: str = "inner",
) -> DataFrame:
    """``join_within`` for placed events, whose date is ``on``."""
    anchor_day = F.unix_date(F.col(anchor_on).cast("date"))
    covered = F.sequence(_bucket(anchor_day + lo, lo, hi), _bucket(anchor_day + hi, lo, hi))
    placed_anchors = (
        anchors.where(F.col(anchor_on).isNotNull())
        .withColumn("_covered", F.explode(covered))
        .withColumnRenamed(key, "_key")
    )
    near = (
        (F.col(key) == F.col("_key"))
        & (F.col("_bucket") == F.col("_covered"))
        & on.between(F.date_add(anchor_on, lo), F.date_add(anchor_on, hi))
    )
    return placed_events.join(placed_anchors, near, how).drop("_key", "_bucket", "_covered")


#: Days of events that one task takes of a key; it tunes the spread and never changes rows.
SINCE_DAYS = 7


def join_since(
    events: DataFrame, anchors: DataFrame, key: str, event_on: str, anchor_on: str
) -> DataFrame:
    """Each event once for every anchor of its key at or before it.

    A key's anchors become one row, the counts of its different dates, so an event meets
    one row and is repeated after the join.  That row is repeated for the calendar stretches
    that the key has events in, and the join is on (key, stretch): a key with very many
    events is spread over its dates, with or without adaptive execution.
    """
    dated = events.where(F.col(event_on).isNotNull() & F.col(key).isNotNull())
    placed = dated.withColumn(
        "_stretch", F.floor(F.unix_date(F.col(event_on).cast("date")) / SINCE_DAYS)
    )
    counts = (
        anchors.where(F.col(anchor_on).isNotNull())
        .groupBy(F.col(key).alias("_key"), F.col(anchor_on).alias("_on"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    steps = counts.groupBy("_key").agg(F.collect_list(F.struct("_on", "_n")).alias("_steps"))
    stretches = placed.select(F.col(key).alias("_key"), F.col("_stretch").alias("_place")).distinct()
    reach = stretches.join(steps, "_key")
    before = F.filter("_steps", lambda x: x["_on"] <= F.col(event_on))
    rows = F.aggregate(before, F.lit(0).cast("long"), lambda n, x: n + x["_n"])
    same = (F.col(key) == F.col("_key")) & (F.col("_stretch") == F.col("_place"))
    met = placed.join(reach, same).withColumn("_rows", rows).where("_rows > 0")
    each = met.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))))
    return each.select(*events.columns)
