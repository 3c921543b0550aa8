"""Site variants of the register as data."""

from __future__ import annotations

from dataclasses import dataclass

from rollbook.operators.columns import NOT_RECORDED
from rollbook.operators.medication import DRUGS

# Output labels of the register, in order.
REGISTRATION = (
    "Registration_Number",
    "Register",
    "EMR_ID",
    "Sex",
    "Age_at_Registration",
    "Age_Group_at_Registration",
)
BASELINE = (
    "WHO_Registration_Group",
    "History_of_Previously_Treated",
    "Baseline_Disease_Site",
    "MTB_Confirmed",
    "Drug_Resistance_Profile",
    "Sub-class_of_Drug_Resistance_Profile",
)
TREATMENT = (
    "Treatment_Start_Date",
    "Treatment_Start_Year",
    "Treatment_Start_Quarter",
    "Treatment_Duration_(months)",
)
CLINIC = ("Clinic_Enrollment_Date", "Clinic_Enrollment_Year", "Clinic_Enrollment_Quarter")
DRUG_STARTS = (
    "Second_Line_Treatment_Type",
    "Start_Date_(Dlm)",
    "Start_Date_(Bdq)",
    "Start_Date_(Dlm_or_Bdq)",
    "Start_Date_(Dlm_and_Bdq)",
    "Last_Facility",
)
# The labels differ from the drug columns in two places.
DRUG_LABELS = {
    short: "Initial_Drug_" + {"Imp/Cln": "Imp/Clm", "Rpt or P": "Rpt_or_P"}.get(short, short)
    for short in DRUGS.values()
}
REGIMEN = tuple(DRUG_LABELS.values())
SEROLOGY = (
    "HIV_Baseline",
    "HIV_Lab",
    "HIV_Status",
    "Hep_B_Baseline",
    "Hep_B_Lab",
    "Hep_B_Status",
    "Hep_C_Baseline",
    "Hep_C_Lab",
    "Hep_C_Status",
    "Diabetes_Baseline",
)
CULTURES = (
    "Positive_Culture_at_Baseline",
    "Negative_Culture_Closer_to_Baseline_Than_Positive_Culture",
    "Culture_Conversion_(for_positive_at_baseline_only)",
    "Initial_Culture_Conversion_Date",
    "Months_to_Initial_Culture_Conversion",
    "Reconversion_after_Initial_Culture_Conversion",
)
OUTCOME = ("Outcome", "End_of_Treatment_Date")
TECHNICAL = ("patient_id", "patient_program_id", "background_sum", "background_count")

TECHNICAL_PREFIX = "99_"


@dataclass(frozen=True)
class Variant:
    """What a site reports and which forms it keeps."""

    name: str
    columns: tuple[str, ...]
    numbered: bool = False
    hospital: str | None = "coded"
    followup_return: bool = True
    district: bool = False
    unrecorded: str | None = None

    def labels(self) -> dict[str, str]:
        """Column to output label; numbered sites prefix the position."""
        reported = {
            c: f"{i:02d}_{c}" if self.numbered else c for i, c in enumerate(self.columns, 1)
        }
        prefix = TECHNICAL_PREFIX if self.numbered else ""
        return {**reported, **{c: prefix + c for c in TECHNICAL}}


GENERIC = Variant(
    name="generic",
    columns=(
        *REGISTRATION, *BASELINE, *TREATMENT, *CLINIC, *DRUG_STARTS,
        *REGIMEN, *SEROLOGY, *CULTURES, *OUTCOME, "Next_Visit",
    ),
)

PK = Variant(
    name="pk",
    columns=(
        *REGISTRATION, *BASELINE, *TREATMENT, *CLINIC, *DRUG_STARTS,
        *REGIMEN, *SEROLOGY, *CULTURES, *OUTCOME, "Active_Treatment",
    ),
    numbered=True,
    hospital="hospital_name",
    followup_return=False,
    unrecorded=NOT_RECORDED,
)

PNG = Variant(
    name="png",
    columns=(
        *REGISTRATION[:3], "District", *REGISTRATION[3:], *BASELINE, *TREATMENT,
        "Type_of_Regimen", *DRUG_STARTS,
        *REGIMEN, *SEROLOGY, *CULTURES, *OUTCOME, "Next_Visit", "Active_Treatment",
    ),
    numbered=True,
    hospital=None,
    district=True,
)

VARIANTS = {v.name: v for v in (GENERIC, PK, PNG)}
