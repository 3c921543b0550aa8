"""Text building with nulls read as empty strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def number_text(df: DataFrame, name: str) -> Column:
    """A numeric column as its shortest plain text: ``800``, ``12.5``."""
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # Spark writes 5.0E-4 and 1.23456785E7; mantissa digits are moved by the exponent instead
        return F.when(F.isnan(column) | (F.abs(column) == float("inf")), column.cast("string")).otherwise(
            _plain(column.cast("string"))
        )
    if isinstance(kind, T.DecimalType):
        return _plain(column.cast("string"))
    return column.cast("string")


def _plain(text: Column) -> Column:
    """A number's text without exponent, trailing zeros and a trailing point."""
    mantissa, power = F.substring_index(text, "E", 1), F.coalesce(F.regexp_extract(text, r"E(-?\d+)$", 1).try_cast("int"), F.lit(0))
    sign = F.when(mantissa.startswith("-"), "-").otherwise("")
    digits = F.regexp_replace(mantissa, r"[^0-9]", "")
    whole = F.char_length(F.regexp_extract(mantissa, r"^-?(\d+)", 1)) + power
    padded = F.concat(F.repeat(F.lit("0"), F.greatest(1 - whole, F.lit(0))), digits, F.repeat(F.lit("0"), F.greatest(whole - F.char_length(digits), F.lit(0))))
    point = F.greatest(whole, F.lit(1))
    before = F.regexp_replace(F.substr(padded, F.lit(1), point), "^0+(?=[0-9])", "")
    after = F.regexp_replace(F.substr(padded, point + 1), "0+$", "")
    plain = F.when(after == "", before).otherwise(F.concat_ws(".", before, after))
    return F.when(text.isNull(), None).when(plain == "0", plain).otherwise(F.concat(sign, plain))


def dose_text(dose: Column, unit: Column) -> Column:
    """``dose unit``; a missing part leaves the blank between them."""
    return F.concat_ws(
        "", dose, F.lit(" "), unit
    )
