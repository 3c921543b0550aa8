"""Serology results per enrolment."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.picks import PICKS
from rollbook.sources.schemas import PID

# Result columns of the laboratory form.
TESTS: dict[str, str] = {
    "hiv_result": "lab_hiv_test_result",
    "hep_b_result": "lab_hepatitis_b_antigen_test_result",
    "hep_c_result": "lab_hepatitis_c_antibody_test_result",
}


def serology_results(
    labs: DataFrame, tests: Mapping[str, str] = TESTS, pick: str = "earliest"
) -> DataFrame:
    """One non-null result per enrolment and test by specimen date, in one pass.

    ``earliest`` is what the register reports; ``latest`` is the other reading of
    "latest result".
    """
    on = F.col("specimen_collection_date")
    any_result = F.coalesce(*[F.col(c) for c in tests.values()]).isNotNull()
    return (
        labs.where(any_result)
        .groupBy(PID)
        .agg(
            *[
                PICKS[pick](on, F.col(c), F.col(c).isNotNull()).alias(name)
                for name, c in tests.items()
            ]
        )
        .select(PID, *[F.col(name)["value"].alias(name) for name in tests])
    )


def serology_result(labs: DataFrame, test: str, pick: str = "earliest") -> DataFrame:
    """(enrolment, result) of one test."""
    return serology_results(labs, {test: TESTS[test]}, pick)
