"""Joins of an enrolment's forms that stay spread however often a form is repeated.

Rows of forms multiply, so an enrolment with very many rows of one form would fill one
task with every join on the enrolment.  Here the joins are on (enrolment, chunk): an
ordinary enrolment has chunk 0 only; of a heavy one the rows of its largest form are
dealt over as many chunks as they fill, and everything else is repeated for each.  Which
enrolments are heavy is counted in the same plan, with map-side combine, and meets the
tables as a DataFrame; nothing is collected, refused or planned differently by size.

The chunk of a row follows from the row alone: equal rows are counted, and the copies
of a row take the chunks from the row's hash on.  A task that runs again therefore deals
its rows as before, in whatever order they come to it.  Only rows of heavy enrolments are
counted; where there are none, adaptive execution drops that branch unread.

Tables that are stored clustered by enrolment need no exchange for ordinary enrolments:
``clustered`` joins those on the enrolment alone and only the heavy ones on (enrolment, chunk).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.sources.schemas import PID

#: Rows of a form that one chunk takes; it tunes the spread and never changes rows.
CHUNK_ROWS = 1_000
CHUNK, LARGEST, CHUNKS = "chunk_", "largest_form_", "chunks_"


def heavy_enrolments(keys: Mapping[str, DataFrame], chunk_rows: int) -> DataFrame:
    """(enrolment, largest form, chunks) of enrolments with more rows of a form than a chunk takes."""
    stacked = reduce(
        DataFrame.unionAll, [t.select(PID, F.lit(name).alias("form")) for name, t in keys.items()]
    )
    counts = stacked.where(F.col(PID).isNotNull()).groupBy(PID, "form").agg(F.count(F.lit(1)).alias("rows"))
    largest = counts.where(F.col("rows") > chunk_rows).groupBy(PID).agg(F.max(F.struct("rows", "form")).alias("most"))
    found = largest.select(
        PID,
        F.col("most.form").alias(LARGEST),
        F.ceil(F.col("most.rows") / chunk_rows).cast("int").alias(CHUNKS),
    )
    # Not clustered by enrolment, so that a join with it brings its own exchange, which
    # adaptive execution needs to divide a heavy enrolment there.
    return found.repartition(LARGEST)


def dealt(name: str, table: DataFrame, heavy: DataFrame) -> DataFrame:
    """The form's rows of the enrolments that have most of it, each copy of a row in its chunk."""
    columns = [F.col(f"`{c}`") for c in table.columns]
    own = table.join(heavy.where(F.col(LARGEST) == name), PID)
    copies = own.groupBy(*columns, LARGEST, CHUNKS).agg(F.count(F.lit(1)).alias("copies_"))
    each = copies.withColumn("copy_", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies_") - 1)))
    place = F.pmod(F.xxhash64(*columns), F.col(CHUNKS)) + F.col("copy_")
    return each.select(*columns, LARGEST, F.pmod(place, F.col(CHUNKS)).cast("int").alias(CHUNK))


def repeated(table: DataFrame, heavy: DataFrame, how: str) -> DataFrame:
    """Rows once, or for each chunk of a heavy enrolment."""
    chunks = F.when(F.col(CHUNKS).isNull(), F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.col(CHUNKS) - 1)
    )
    return table.join(heavy, PID, how).withColumn(CHUNK, F.explode(chunks)).drop(CHUNKS)


def _chunked(name: str, table: DataFrame, heavy: DataFrame, how: str) -> DataFrame:
    others = repeated(table, heavy, how)
    if how == "left":
        others = others.where(F.col(LARGEST).isNull() | (F.col(LARGEST) != name))
    else:
        others = others.where(F.col(LARGEST) != name)
    return others.unionByName(dealt(name, table, heavy))


def _divided(
    required: Mapping[str, DataFrame],
    optional: Mapping[str, DataFrame],
    together: DataFrame | None,
    heavy: DataFrame,
    how: str,
) -> DataFrame:
    """The joins on (enrolment, chunk), of all enrolments or (``how="inner"``) of heavy ones."""
    rows = None
    for name, table in {**required, **optional}.items():
        own = _chunked(name, table, heavy, how).withColumn(f"has_{name}_", F.lit(True))
        if rows is None:
            rows = own
        else:
            rows = rows.join(own.drop(LARGEST), [PID, CHUNK], "inner" if name in required else "left")
    if together is not None:
        rows = rows.join(repeated(together, heavy, how).drop(LARGEST), [PID, CHUNK], "left")
    # a chunk that got no row of the enrolment's largest form has nothing to say
    for name in optional:
        rows = rows.where(F.col(LARGEST).isNull() | (F.col(LARGEST) != name) | F.col(f"has_{name}_"))
    return rows.drop(CHUNK, LARGEST, *(f"has_{name}_" for name in (*required, *optional)))


def _ordinary(
    required: Mapping[str, DataFrame],
    optional: Mapping[str, DataFrame],
    together: DataFrame | None,
    heavy: DataFrame,
) -> DataFrame:
    """The joins on the enrolment alone, without heavy enrolments."""
    first, *others = required
    rows = required[first].join(heavy.select(PID), PID, "left_anti")
    for name in others:
        rows = rows.join(required[name], PID)
    for table in optional.values():
        rows = rows.join(table, PID, "left")
    return rows if together is None else rows.join(together, PID, "left")


def join_chunked(
    required: Mapping[str, DataFrame],
    optional: Mapping[str, DataFrame],
    features: Iterable[DataFrame] = (),
    keys: Mapping[str, DataFrame] | None = None,
    chunk_rows: int | None = None,
    clustered: bool = False,
) -> DataFrame:
    """Required forms joined, then optional forms and features where present.

    ``features`` have one row per enrolment and are clustered by it; they are joined to
    one another first, so they share one exchange to the chunks.  ``keys`` may name
    smaller tables that hold a form's enrolments about as often as the form does; they
    are counted in its place.  ``clustered`` says that the tables are stored clustered by
    enrolment; it changes the plan and no row.
    """
    heavy = heavy_enrolments({**required, **optional, **(keys or {})}, chunk_rows or CHUNK_ROWS)
    # a union would lose types; every feature has each enrolment once
    features = list(features)
    together = reduce(lambda a, b: a.join(b, PID, "full"), features) if features else None
    if not clustered:
        return _divided(required, optional, together, heavy, "left")
    return _ordinary(required, optional, together, heavy).unionByName(
        _divided(required, optional, together, heavy, "inner")
    )
