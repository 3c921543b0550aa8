"""Register columns derived row by row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollbook.functions.dates import months, quarter_label, whole_days
from rollbook.functions.recode import recode

Columns = dict[str, Column]

NEW_DRUG_DAYS = 7

# Codes of the forms and the names shown in the register.
TICKED = {"True": "Positive", "False": "Negative"}
TICKED_OR_UNKNOWN = {**TICKED, "Unknown": "Unknown"}
REACTION = {"Reactive": "Positive", "Non-reactive": "Negative"}
SEROSTATUS = {"Positive": "Positive", "Negative": "Negative"}
REGIMEN_LISTS = {
    "PNG Regimen List 1": "Short Regimen",
    "PNG Regimen List 2": "Conventional Regimen without new drugs",
    "PNG Regimen List 3": "Regimen including new drugs",
}
NOT_RECORDED = "Not Recorded"


def _fill(unrecorded: str | None) -> Column:
    return F.lit(unrecorded).cast("string")


def dated_period(prefix: str, on: Column) -> Columns:
    """Date, year and quarter label."""
    day = on.cast("date")
    return {
        f"{prefix}_Date": day,
        f"{prefix}_Year": F.year(day),
        f"{prefix}_Quarter": quarter_label(day),
    }


def treatment_period(start: Column) -> Columns:
    return dated_period("Treatment_Start", start)


def clinic_enrollment_period(baseline_date: Column) -> Columns:
    return dated_period("Clinic_Enrollment", baseline_date)


def treatment_duration(start: Column, end: Column, as_of: Column) -> Columns:
    """Months on treatment, open treatments counted up to ``as_of``."""
    until = F.coalesce(end.cast("timestamp_ntz"), as_of)
    return {"Treatment_Duration_(months)": months(whole_days(until, start))}


def new_drug_start(dlm: Column, bdq: Column, days: int = NEW_DRUG_DAYS) -> Columns:
    """First start of either new drug, and of both when started close together."""
    first = F.least(dlm, bdq).cast("date")
    bdq_day = bdq.cast("date")
    together = dlm.between(F.date_sub(bdq_day, days), F.date_add(bdq_day, days))
    return {
        "Start_Date_(Dlm)": dlm.cast("date"),
        "Start_Date_(Bdq)": bdq_day,
        "Start_Date_(Dlm_or_Bdq)": first,
        "Start_Date_(Dlm_and_Bdq)": F.when(together, first),
    }


def _status(disease: str, lab: Column, lab_codes, baseline: Column, baseline_codes, unrecorded):
    """Laboratory result where it is conclusive, else the baseline form."""
    named = {c: f"{disease} {n}" for c, n in lab_codes.items()}
    stated = {c: f"{disease} {n}" for c, n in baseline_codes.items()}
    return recode(lab, named, recode(baseline, stated, _fill(unrecorded)))


def hiv_status(baseline: Column, lab: Column, unrecorded: str | None = None) -> Columns:
    return {
        "HIV_Baseline": baseline,
        "HIV_Lab": lab,
        "HIV_Status": _status("HIV", lab, SEROSTATUS, baseline, SEROSTATUS, unrecorded),
    }


def hep_b_status(baseline: Column, lab: Column, unrecorded: str | None = None) -> Columns:
    return {
        "Hep_B_Baseline": recode(baseline, TICKED_OR_UNKNOWN),
        "Hep_B_Lab": lab,
        "Hep_B_Status": _status("Hep B", lab, REACTION, baseline, TICKED, unrecorded),
    }


def hep_c_status(baseline: Column, lab: Column, unrecorded: str | None = None) -> Columns:
    return {
        "Hep_C_Baseline": recode(baseline, TICKED),
        "Hep_C_Lab": lab,
        "Hep_C_Status": _status("Hep C", lab, REACTION, baseline, TICKED, unrecorded),
    }


def diabetes_status(baseline: Column, unrecorded: str | None = None) -> Columns:
    return {"Diabetes_Baseline": recode(baseline, TICKED, _fill(unrecorded))}


def culture_flags(
    start: Column,
    closest_positive: Column,
    closer_negative: Column,
    converted: Column,
    reverted: Column,
) -> Columns:
    return {
        "Positive_Culture_at_Baseline": F.when(closest_positive.isNotNull(), "Y"),
        "Negative_Culture_Closer_to_Baseline_Than_Positive_Culture": closer_negative,
        "Culture_Conversion_(for_positive_at_baseline_only)": F.when(converted.isNotNull(), "Y"),
        "Initial_Culture_Conversion_Date": converted,
        "Months_to_Initial_Culture_Conversion": months(whole_days(converted, start)),
        "Reconversion_after_Initial_Culture_Conversion": reverted,
    }


def next_visit(planned: Column, baseline_planned: Column) -> Columns:
    return {"Next_Visit": F.coalesce(planned, baseline_planned)}


def active_treatment(end: Column) -> Columns:
    return {"Active_Treatment": F.when(end.isNull(), "Yes")}


def regimen_type(code: Column) -> Columns:
    return {"Type_of_Regimen": recode(code, REGIMEN_LISTS, code)}
