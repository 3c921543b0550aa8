"""Where an enrolment was last seen, and its next planned visit.

Three forms name a facility: treatment initiation, hospital admission and
follow-up.  All of them are stacked and reduced in one ``groupBy`` on the
enrolment, one pick per form, so a register pays one exchange for the lot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.picks import PICKS, latest
from rollbook.sources.schemas import PID

INITIATION, HOSPITAL, FOLLOWUP = "initiation", "hospital", "followup"


def _stay(source: str, on: str, name: Column, facility: Column, returns: Column | None = None):
    return (
        F.col(PID),
        F.lit(source).alias("source"),
        F.col(on).cast("date").alias("seen_on"),
        name.isNotNull().alias("named"),
        facility.alias("facility"),
        (F.lit(None) if returns is None else returns).cast("date").alias("return_on"),
    )


def _coded_facility() -> tuple[Column, Column]:
    """The chosen facility; the free text next to it when the choice is ``Other``."""
    name = F.col("treatment_facility_name")
    return name, F.when(name != "Other", name).otherwise(F.col("other_treatment_facility_name"))


def initiation_stays(initiations: DataFrame) -> DataFrame:
    name = F.col("ti_treatment_facility_at_start")
    return initiations.select(
        *_stay(INITIATION, "tuberculosis_drug_treatment_start_date", name, name)
    )


def hospital_stays(admissions: DataFrame, mode: str = "coded") -> DataFrame:
    """``mode``: ``coded`` choice with free text, or ``hospital_name`` alone."""
    if mode == "hospital_name":
        name = facility = F.col("han_hospital_name")
    elif mode == "coded":
        name, facility = _coded_facility()
    else:
        raise ValueError(f"unknown hospital mode {mode!r}")
    return admissions.select(*_stay(HOSPITAL, "han_hospital_admission_date", name, facility))


def followup_stays(followups: DataFrame) -> DataFrame:
    name, facility = _coded_facility()
    return followups.select(
        *_stay(FOLLOWUP, "followup_visit_date", name, facility, F.col("return_visit_date"))
    )


def _latest_stay(source: str | None = None) -> Column:
    where = F.col("named")
    if source is not None:
        where = where & (F.col("source") == source)
    return latest(F.col("seen_on"), F.col("facility"), where)


def latest_facility(stays: DataFrame) -> DataFrame:
    """(enrolment, date, facility) of the newest named stay of one form.

    A form without a date counts as newest.  The facility may be null: ``Other``
    without free text still hides older forms.
    """
    return (
        stays.where("named")
        .groupBy(PID)
        .agg(_latest_stay().alias("stay"))
        .select(
            PID,
            F.col("stay.on").cast("date").alias("facility_date"),
            F.col("stay.value").alias("facility"),
        )
    )


def _stacked(stays: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, stays)


def facility_history(stays: list[DataFrame], sources: list[str]) -> DataFrame:
    """Distinct newest stays over the forms, at most one row per form."""
    picks = [_latest_stay(s).alias(s) for s in sources]
    entries = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(s).isNotNull(),
                    F.struct(
                        F.col(s)["on"].cast("date").alias("facility_date"),
                        F.col(s)["value"].alias("facility"),
                    ),
                )
                for s in sources
            ]
        )
    )
    return (
        _stacked(stays)
        .where("named")
        .groupBy(PID)
        .agg(*picks)
        .select(PID, F.inline(F.array_distinct(entries)))
    )


def care_history(
    stays: list[DataFrame], sources: list[str], return_pick: str | None = "earliest"
) -> DataFrame:
    """(enrolment, seen_at, return_on): newest known facility and planned return.

    ``seen_at`` picks the newest stay per form first and drops unknown facilities
    afterwards.  ``return_on`` belongs to one visit, the earliest by default.
    """
    picks = [_latest_stay(s).alias(s) for s in sources]
    rows = _stacked(stays)
    if return_pick is None:
        rows = rows.where("named")
    else:
        visit = PICKS[return_pick](
            F.col("seen_on"), F.col("return_on"), F.col("source") == FOLLOWUP
        )
        picks.append(visit.alias("visit"))
    known = [F.when(F.col(s)["value"].isNotNull(), F.col(s)) for s in sources]
    return (
        rows.groupBy(PID)
        .agg(*picks)
        .select(
            PID,
            F.least(*known)["value"].alias("seen_at"),
            *([F.col("visit.value").alias("return_on")] if return_pick else []),
        )
    )


def registration(rows: DataFrame, *more: str) -> DataFrame:
    """(enrolment, date, facility) of registration from joined attributes and programme rows."""
    return rows.select(
        PID,
        F.col("date_enrolled").cast("date").alias("facility_date"),
        F.col("Registration_Facility").alias("facility"),
        *more,
    )


def enrollment_facility(attributes: DataFrame, enrolments: DataFrame) -> DataFrame:
    """(enrolment, date, facility) of registration, for enrolments with a programme row."""
    return registration(attributes.join(enrolments, PID))


def last_facility(registered: DataFrame) -> DataFrame:
    """Newest known facility (``seen_at``), or the facility of registration."""
    return registered.select(PID, F.coalesce("seen_at", "facility").alias("last_facility"))


def followup_return_visit(followups: DataFrame, pick: str = "earliest") -> DataFrame:
    """(enrolment, return date) of one visit by visit date."""
    visit = PICKS[pick](F.col("followup_visit_date"), F.col("return_visit_date"))
    return (
        followups.groupBy(PID)
        .agg(visit.alias("visit"))
        .select(PID, F.col("visit.value").alias("return_visit_date"))
    )
