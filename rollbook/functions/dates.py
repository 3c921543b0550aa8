"""Date arithmetic shared by the register columns."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_YEAR = 365
MONTHS_PER_YEAR = 12


def as_of_moment(as_of: Column | date | datetime | str | None) -> Column:
    """The moment open treatments are measured to; the clock when not given."""
    if as_of is None:
        return F.localtimestamp()
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return moment.cast("timestamp_ntz")


def whole_days(end: Column, start: Column) -> Column:
    """Full days from ``start`` to ``end``, cut towards zero.

    Computed on timestamps without a zone, so a clock change in the session's
    zone never shortens a day.
    """
    return F.extract(
        F.lit("DAY"), end.cast("timestamp_ntz") - start.cast("timestamp_ntz")
    )


def months(days: Column) -> Column:
    """Days as months of a 365-day year, one decimal."""
    return F.round(days.cast("double") / DAYS_PER_YEAR * MONTHS_PER_YEAR, 1)


def quarter_label(on: Column) -> Column:
    """``2020 - Q1``; a missing date leaves the fixed part, ``' - Q'``."""
    return F.concat_ws(
        "", F.year(on).cast("string"), F.lit(" - Q"), F.quarter(on).cast("string")
    )
