"""Several small columns as one whole number, so that rows are narrow where they are moved.

A part has its lowest value and a number of bits.  A row with a part that is null or outside
its bits keeps its columns as they are, in a struct that is null for all others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (lowest value, bits) of a day since 1970: 1900 to 2258.
DAY = (-25_567, 17)

Part = tuple[int, int]


def place(column: Column, known: Sequence[str]) -> Column:
    """Where a text stands among the known ones, from 1; 0 for another one."""
    return F.array_position(F.array(*map(F.lit, known)), column)


def named(place_: Column, known: Sequence[str]) -> Column:
    """The text at a place."""
    return F.get(F.array(*map(F.lit, known)), place_.cast("int") - 1)


def pack(rows: DataFrame, numbers: Mapping[str, Column], parts: Mapping[str, Part]) -> DataFrame:
    """Rows with ``code`` and ``wide`` in place of the columns that ``numbers`` has as whole numbers.

    The numbers are columns first, so that each is worked out once.
    """
    own = {name: f"{name}_number" for name in parts}
    counted = rows.select("*", *[numbers[name].cast("long").alias(n) for name, n in own.items()])
    fits, code = F.lit(True), F.lit(0).cast("long")
    for name, (low, bits) in parts.items():
        number = F.col(own[name])
        fits = fits & number.between(low, low + (1 << bits) - 1)
        code = F.shiftleft(code, bits).bitwiseOR(number - low)
    coded = counted.withColumn("code", F.when(fits, code))
    wide = F.when(F.col("code").isNull(), F.struct(*parts)).alias("wide")
    return coded.select(*[c for c in rows.columns if c not in parts], "code", wide)


def unpack(parts: Mapping[str, Part]) -> dict[str, Column]:
    """The whole numbers in ``code``."""
    values, shift = {}, 0
    for name, (low, bits) in reversed(parts.items()):
        values[name] = F.shiftright("code", shift).bitwiseAND(F.lit((1 << bits) - 1)) + low
        shift += bits
    return values


def row(parts: Mapping[str, Part], read: Mapping[str, Column]) -> Column:
    """The packed columns as a struct: read from ``code``, or as they are in ``wide``."""
    return F.when(F.col("code").isNotNull(), F.struct(*[read[n].alias(n) for n in parts])).otherwise(F.col("wide"))
