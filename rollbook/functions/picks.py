"""First-row-per-key picks as plain aggregates.

A pick is ``min(struct(order..., value))``: Spark combines it on the map side,
so a key that holds a large share of the rows reaches the reducer as one row
per map task.  A ``row_number`` window would send every raw row of the key to
one task.

Null order is spelled out inside the struct (a false flag sorts first), and the
picked value closes the order, so equal dates give the same answer on any
partitioning: smallest value first, null value last.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def earliest(on: Column, value: Column, where: Column | None = None) -> Column:
    """Aggregate: the row with the smallest ``on``, rows without a date last."""
    entry = F.struct(
        on.isNull().alias("late"),
        on.alias("on"),
        value.isNull().alias("blank"),
        value.alias("value"),
    )
    return F.min(entry if where is None else F.when(where, entry))


def latest(on: Column, value: Column, where: Column | None = None) -> Column:
    """Aggregate: the row with the greatest ``on``, rows without a date first."""
    entry = F.struct(
        on.isNotNull().alias("late"),
        (-F.unix_micros(on.cast("timestamp"))).alias("back"),
        value.isNull().alias("blank"),
        value.alias("value"),
        on.alias("on"),
    )
    return F.min(entry if where is None else F.when(where, entry))


PICKS = {"earliest": earliest, "latest": latest}
