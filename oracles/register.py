"""Check statements of the three registers."""

from __future__ import annotations

from oracles import steps
from oracles.steps import NOT_RECORDED, P, START, select_list

# Short drug names in the register's order.
DRUGS = (
    "H",
    "R",
    "E",
    "Z",
    "S",
    "Am",
    "Km",
    "Cm",
    "Lfx",
    "Mfx",
    "Pto",
    "Eto",
    "Cs",
    "Trd",
    "PAS",
    "PAS-Na",
    "Bdq",
    "Dlm",
    "Lzd",
    "Cfz",
    "Imp/Cln",
    "Amx/Clv",
    "Mpm",
    "Pa",
    "Rpt or P",
)
RENAMED = {"Imp/Cln": "Imp/Clm", "Rpt or P": "Rpt_or_P"}


def _columns(last_seen: str, otherwise: str = "NULL") -> dict[str, str]:
    return {
        "Registration_Number": "a.Registration_Number",
        "Register": "program_name",
        "EMR_ID": "i.Patient_Identifier",
        "District": 'd."patientDistrict"',
        "Sex": "gender",
        "Age_at_Registration": "age_at_program",
        "Age_Group_at_Registration": "age_group_at_program",
        "WHO_Registration_Group": "baseline_who_registration_group",
        "History_of_Previously_Treated": "category_iv_tuberculosis_classification",
        "Baseline_Disease_Site": "disease_site",
        "MTB_Confirmed": "baseline_mdr_tb_diagnosis_method",
        "Drug_Resistance_Profile": "baseline_drug_resistance",
        "Sub-class_of_Drug_Resistance_Profile": (
            "baseline_subclassification_for_confimed_drug_resistant_case"
        ),
        "Treatment_Start_Date": f"s.{START}",
        "Treatment_Start_Year": f"CAST(year(s.{START}) AS INTEGER)",
        "Treatment_Start_Quarter": f"concat(year(s.{START}), ' - Q', quarter(s.{START}))",
        "Treatment_Duration_(months)": steps.DURATION.replace(START, f"s.{START}"),
        "Type_of_Regimen": steps.REGIMEN_TYPE,
        "Clinic_Enrollment_Date": "baseline_date_of_baseline",
        "Clinic_Enrollment_Year": "CAST(year(baseline_date_of_baseline) AS INTEGER)",
        "Clinic_Enrollment_Quarter": (
            "concat(year(baseline_date_of_baseline), ' - Q', quarter(baseline_date_of_baseline))"
        ),
        "Second_Line_Treatment_Type": "ti_second_line_regimen_drug_type",
        **steps.NEW_DRUGS,
        "Last_Facility": f"{last_seen}.last_facility",
        **{f"Initial_Drug_{RENAMED.get(x, x)}": f'g."{x}"' for x in DRUGS},
        **steps.hiv(otherwise),
        **steps.hep_b(otherwise),
        **steps.hep_c(otherwise),
        **steps.diabetes(otherwise),
        **steps.CULTURE_FLAGS,
        "Outcome": "eot_outcome",
        "End_of_Treatment_Date": "tuberculosis_treatment_end_date",
        "Next_Visit": "coalesce(f.return_visit_date, b.return_visit_date)",
        "Active_Treatment": "CASE WHEN tuberculosis_treatment_end_date IS NULL THEN 'Yes' END",
    }


TECHNICAL = {
    "patient_id": "s.patient_id",
    "patient_program_id": f"s.{P}",
    "background_sum": "1",
    "background_count": "'x'",
}


def _register(leave_out: set[str], last_seen: str, numbered: bool, otherwise: str = "NULL") -> str:
    kept = {k: v for k, v in _columns(last_seen, otherwise).items() if k not in leave_out}
    if numbered:
        kept = {f"{n:02d}_{k}": v for n, (k, v) in enumerate(kept.items(), 1)}
    technical = {("99_" if numbered else "") + k: v for k, v in TECHNICAL.items()}
    by_enrolment = "".join(
        f"\n        LEFT JOIN {table} ON s.{P} = {alias}.{P}"
        for table, alias in (
            ("program_attributes a", "a"),
            ("baseline_template b", "b"),
            ("site_of_form st", "st"),
            ("_new_drugs nd", "nd"),
            (last_seen, last_seen),
            ("regimen g", "g"),
            ("lab_hiv lh", "lh"),
            ("lab_hep_b lb", "lb"),
            ("lab_hep_c lc", "lc"),
            ("baseline_pair bp", "bp"),
            ("conversion cc", "cc"),
            ("outcome_end_of_treatment_template o", "o"),
            ("planned_return f", "f"),
        )
    )
    return f"""
        SELECT {select_list({**kept, **technical})}
        FROM _spine s
        LEFT JOIN patient_identifier i ON s.patient_id = i.patient_id
        LEFT JOIN person_attributes d ON s.patient_id = d.person_id{by_enrolment}"""


REGISTERS: dict[str, str] = {
    "register_generic": _register(
        {"District", "Type_of_Regimen", "Active_Treatment"}, "last_seen", numbered=False
    ),
    "register_pk": _register(
        {"District", "Type_of_Regimen", "Next_Visit"}, "last_seen_pk", True, NOT_RECORDED
    ),
    "register_png": _register(
        {"Clinic_Enrollment_Date", "Clinic_Enrollment_Year", "Clinic_Enrollment_Quarter"},
        "last_seen_png",
        True,
    ),
    "register_grain": f"""
        SELECT rows_per_enrolment, count(*) AS enrolments
        FROM (SELECT {P}, count(*) AS rows_per_enrolment FROM register_generic GROUP BY {P})
        GROUP BY rows_per_enrolment""",
}
