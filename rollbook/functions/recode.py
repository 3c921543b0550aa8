"""Value recodes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def recode(value: Column, names: Mapping[str, str], otherwise: Column | None = None) -> Column:
    """Map exact values to names; anything else, null included, to ``otherwise``."""
    result = None
    for code, name in names.items():
        test = value == code
        result = F.when(test, name) if result is None else result.when(test, name)
    return result if otherwise is None else result.otherwise(otherwise)
