"""Steps of the check statements, one per operator."""

from __future__ import annotations

P = "patient_program_id"
START = "tuberculosis_drug_treatment_start_date"


def _first(key: str, table: str, columns: str, order: str, where: str = "TRUE") -> str:
    return (
        f"SELECT {key}, {columns} FROM {table} WHERE {where} "
        f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"
    )


def _newest(on: str, facility: str, table: str, named: str) -> str:
    return _first(
        P,
        table,
        f"{on} AS facility_date, {facility} AS facility",
        f"{on} DESC NULLS FIRST, {facility} ASC NULLS LAST",
        f"{named} IS NOT NULL",
    )


_CHOICE = (
    "CASE WHEN treatment_facility_name <> 'Other' THEN treatment_facility_name "
    "ELSE other_treatment_facility_name END"
)


def _last_seen(history: str) -> str:
    newest = _first(
        P,
        history,
        "facility",
        "facility_date DESC NULLS FIRST, facility ASC",
        "facility IS NOT NULL",
    )
    return (
        f"SELECT r.{P}, coalesce(n.facility, r.facility) AS last_facility "
        f"FROM registered_at r LEFT JOIN ({newest}) n ON r.{P} = n.{P}"
    )


def _lab(column: str, name: str) -> str:
    return _first(
        P,
        "lab_results_serology_template",
        f"{column} AS {name}",
        f"specimen_collection_date ASC NULLS LAST, {column}",
        f"{column} IS NOT NULL",
    )


# Drug names of the mart and their short names.
_DRUGS = (
    ("Isoniazid (H)", "H"),
    ("Rifampicin (R)", "R"),
    ("Ethambutol (E)", "E"),
    ("Pyrazinamide (Z)", "Z"),
    ("Streptomycin (S)", "S"),
    ("Amikacin (Am)", "Am"),
    ("Kanamycin (Km)", "Km"),
    ("Capreomycin (Cm)", "Cm"),
    ("Levofloxacin (Lfx)", "Lfx"),
    ("Moxifloxacin (Mfx)", "Mfx"),
    ("Prothionamide (Pto)", "Pto"),
    ("Ethionamide (Eto)", "Eto"),
    ("Cycloserine (Cs)", "Cs"),
    ("Terizidone (Trd)", "Trd"),
    ("Para-aminosalicylic acid (PAS)", "PAS"),
    ("Para-aminosalicylic acid - sodium (PAS-Na)", "PAS-Na"),
    ("Bedaquiline (Bdq)", "Bdq"),
    ("Delamanid (Dlm)", "Dlm"),
    ("Linezolid (Lzd)", "Lzd"),
    ("Clofazimine (Cfz)", "Cfz"),
    ("Imipenem/Cilastatin (Imp/Cln)", "Imp/Cln"),
    ("Amoxicillin/Clavulanate (Amx/Clv)", "Amx/Clv"),
    ("Meropenem (Mpm)", "Mpm"),
    ("Pretomanid (Pa)", "Pa"),
    ("Rifapentine (Rpt or P)", "Rpt or P"),
)
_DRUG_CELLS = ",\n".join(
    f"max(CASE WHEN drug = '{name}' THEN concat(dose, ' ', dose_unit) END) AS \"{short}\""
    for name, short in _DRUGS
)

# Culture results.
POSITIVE = "Positive for M. tuberculosis"
NEGATIVE = "Negative for M. tuberculosis"


def _window(kind: str) -> str:
    diff = f"(e.specimen_collection_date - t.{START})"
    return (
        f"SELECT t.{P}, t.{START}, e.specimen_collection_date, e.bacteriology_culture_results, "
        f"CAST({diff} AS INTEGER) AS day_diff "
        f"FROM treatment_initiation_template t JOIN specimen_results e ON t.{P} = e.{P} "
        f"WHERE e.bacteriology_culture_results = '{kind}' AND {diff} BETWEEN -90 AND 15"
    )


def _nearest(window: str) -> str:
    return _first(
        P,
        window,
        f"{START}, specimen_collection_date, bacteriology_culture_results, day_diff",
        f"abs(day_diff), specimen_collection_date, {START}",
    )


def _on_treatment(kind: str) -> str:
    return (
        f"SELECT e.{P}, e.specimen_collection_date AS collection_date "
        f"FROM specimen_results e JOIN treatment_initiation_template t ON e.{P} = t.{P} "
        f"WHERE e.bacteriology_culture_results = '{kind}' "
        f"AND e.specimen_collection_date >= t.{START}"
    )


def _months(days: str) -> str:
    return f"round(({days}) / 365.0::DOUBLE * 12, 1)"


def _period(prefix: str, on: str) -> str:
    return (
        f'{on} AS "{prefix}_Date", CAST(year({on}) AS INTEGER) AS "{prefix}_Year", '
        f"concat(year({on}), ' - Q', quarter({on})) AS \"{prefix}_Quarter\""
    )


def _lab_or_baseline(lab: str, positive: str, negative: str, baseline: str, yes: str, no: str,
                     disease: str, otherwise: str) -> str:
    return (
        f"CASE WHEN {lab} = '{positive}' OR ({lab} IS DISTINCT FROM '{negative}' "
        f"AND {baseline} = '{yes}') THEN '{disease} Positive' "
        f"WHEN {lab} = '{negative}' OR {baseline} = '{no}' THEN '{disease} Negative' "
        f"ELSE {otherwise} END"
    )


HIV = "baseline_hiv_serostatus_result"


def hiv(otherwise: str = "NULL") -> dict[str, str]:
    return {
        "HIV_Baseline": HIV,
        "HIV_Lab": "hiv_result",
        "HIV_Status": _lab_or_baseline(
            "hiv_result", "Positive", "Negative", HIV, "Positive", "Negative", "HIV", otherwise
        ),
    }


def hep_b(otherwise: str = "NULL") -> dict[str, str]:
    tick = "baseline_hepatitis_b"
    return {
        "Hep_B_Baseline": f"CASE {tick} WHEN 'True' THEN 'Positive' WHEN 'False' THEN 'Negative' "
        "WHEN 'Unknown' THEN 'Unknown' END",
        "Hep_B_Lab": "hep_b_result",
        "Hep_B_Status": _lab_or_baseline(
            "hep_b_result", "Reactive", "Non-reactive", tick, "True", "False", "Hep B", otherwise
        ),
    }


def hep_c(otherwise: str = "NULL") -> dict[str, str]:
    tick = "baseline_hepatitis_c"
    return {
        "Hep_C_Baseline": f"CASE {tick} WHEN 'True' THEN 'Positive' WHEN 'False' THEN 'Negative' END",
        "Hep_C_Lab": "hep_c_result",
        "Hep_C_Status": _lab_or_baseline(
            "hep_c_result", "Reactive", "Non-reactive", tick, "True", "False", "Hep C", otherwise
        ),
    }


def diabetes(otherwise: str = "NULL") -> dict[str, str]:
    return {
        "Diabetes_Baseline": "CASE diabetes_mellitus WHEN 'True' THEN 'Positive' "
        f"WHEN 'False' THEN 'Negative' ELSE {otherwise} END"
    }


def select_list(columns: dict[str, str]) -> str:
    return ",\n".join(f'{sql} AS "{label}"' for label, sql in columns.items())


def _status(columns: dict[str, str], lab: str | None) -> str:
    join = f" LEFT JOIN {lab} l ON b.{P} = l.{P}" if lab else ""
    return f"SELECT b.{P}, {select_list(columns)} FROM baseline_template b{join}"


NOT_RECORDED = "'Not Recorded'"
AS_OF = "DATE '2002-01-01'"

DURATION = _months(f"coalesce(tuberculosis_treatment_end_date, {AS_OF}) - {START}")
NEW_DRUGS = {
    "Start_Date_(Dlm)": "dlm_start_date",
    "Start_Date_(Bdq)": "bdq_start_date",
    "Start_Date_(Dlm_or_Bdq)": "CASE WHEN dlm_start_date < bdq_start_date "
    "OR bdq_start_date IS NULL THEN dlm_start_date ELSE bdq_start_date END",
    "Start_Date_(Dlm_and_Bdq)": "CASE WHEN abs(dlm_start_date - bdq_start_date) <= 7 "
    "THEN least(dlm_start_date, bdq_start_date) END",
}
CULTURE_FLAGS = {
    "Positive_Culture_at_Baseline": "CASE WHEN closest_positive IS NOT NULL THEN 'Y' END",
    "Negative_Culture_Closer_to_Baseline_Than_Positive_Culture": "closer_negative",
    "Culture_Conversion_(for_positive_at_baseline_only)": "CASE WHEN initial_cc_date "
    "IS NOT NULL THEN 'Y' END",
    "Initial_Culture_Conversion_Date": "initial_cc_date",
    "Months_to_Initial_Culture_Conversion": _months(f"initial_cc_date - s.{START}"),
    "Reconversion_after_Initial_Culture_Conversion": "revert_after_cc",
}
REGIMEN_TYPE = (
    "CASE ti_type_of_treatment_regimen WHEN 'PNG Regimen List 1' THEN 'Short Regimen' "
    "WHEN 'PNG Regimen List 2' THEN 'Conventional Regimen without new drugs' "
    "WHEN 'PNG Regimen List 3' THEN 'Regimen including new drugs' "
    "ELSE ti_type_of_treatment_regimen END"
)
TREATMENT_PERIOD = _period("Treatment_Start", START)
CLINIC_PERIOD = _period("Clinic_Enrollment", "baseline_date_of_baseline")

_SPINE_END = (
    f"_spine s LEFT JOIN outcome_end_of_treatment_template o ON s.{P} = o.{P}"
)

STEPS: dict[str, str] = {
    "site_of_form": f"""
        SELECT {P}, id_baseline_template,
               CASE string_agg(baseline_disease_site, ',' ORDER BY baseline_disease_site)
                    WHEN 'Pulmonary' THEN 'Pulmonary'
                    WHEN 'Extrapulmonary' THEN 'Extrapulmonary'
                    WHEN 'Extrapulmonary,Pulmonary' THEN 'Both' END AS disease_site
        FROM baseline_disease_site GROUP BY ALL""",
    "stay_initiation": _newest(
        START,
        "ti_treatment_facility_at_start",
        "treatment_initiation_template",
        "ti_treatment_facility_at_start",
    ),
    "stay_hospital": _newest(
        "han_hospital_admission_date",
        _CHOICE,
        "hospital_admission_notification_template",
        "treatment_facility_name",
    ),
    "stay_hospital_named": _newest(
        "han_hospital_admission_date",
        "han_hospital_name",
        "hospital_admission_notification_template",
        "han_hospital_name",
    ),
    "stay_followup": _newest(
        "followup_visit_date", _CHOICE, "followup_template", "treatment_facility_name"
    ),
    "history": "SELECT * FROM stay_initiation UNION SELECT * FROM stay_hospital "
    "UNION SELECT * FROM stay_followup",
    "_history_pk": "SELECT * FROM stay_initiation UNION SELECT * FROM stay_hospital_named "
    "UNION SELECT * FROM stay_followup",
    "history_no_hospital": "SELECT * FROM stay_initiation UNION SELECT * FROM stay_followup",
    "registered_at": f"""
        SELECT d.{P}, d.date_enrolled AS facility_date, a.Registration_Facility AS facility
        FROM program_attributes a JOIN patient_program_data_default d ON a.{P} = d.{P}""",
    "last_seen": _last_seen("history"),
    "last_seen_pk": _last_seen("_history_pk"),
    "last_seen_png": _last_seen("history_no_hospital"),
    "first_dlm": f"""SELECT {P}, min(start_date) AS start_date FROM medication_data_default
        WHERE coded_drug_name = 'Delamanid (Dlm)' GROUP BY {P}""",
    "first_bdq": f"""SELECT {P}, min(start_date) AS start_date FROM medication_data_default
        WHERE coded_drug_name = 'Bedaquiline (Bdq)' GROUP BY {P}""",
    "near_start": f"""
        SELECT DISTINCT m.{P}, m.coded_drug_name AS drug, m.dose, m.dose_units AS dose_unit
        FROM medication_data_default m JOIN treatment_initiation_template t ON m.{P} = t.{P}
        WHERE abs(m.start_date - t.{START}) <= 7 AND m.coded_drug_name IS NOT NULL""",
    "regimen": f"SELECT {P}, {_DRUG_CELLS} FROM near_start GROUP BY {P}",
    "lab_hiv": _lab("lab_hiv_test_result", "hiv_result"),
    "lab_hep_b": _lab("lab_hepatitis_b_antigen_test_result", "hep_b_result"),
    "lab_hep_c": _lab("lab_hepatitis_c_antibody_test_result", "hep_c_result"),
    "planned_return": _first(
        P,
        "followup_template",
        "return_visit_date",
        "followup_visit_date ASC NULLS LAST, return_visit_date ASC NULLS LAST",
    ),
    "specimen_results": f"""
        SELECT r.{P}, c.specimen_collection_date, r.bacteriology_culture_results
        FROM bacteriology_culture_results_details r LEFT JOIN bacteriology_concept_set c
          ON r.id_bacteriology_concept_set = c.id_bacteriology_concept_set
        WHERE r.bacteriology_culture_results IN
              ('{POSITIVE}', '{NEGATIVE}')""",
    "window_positive": _window(POSITIVE),
    "window_negative": _window(NEGATIVE),
    "nearest_positive": _nearest("window_positive"),
    "nearest_negative": _nearest("window_negative"),
    "baseline_pair": f"""
        SELECT p.{P}, p.{START}, p.specimen_collection_date AS closest_positive,
               n.specimen_collection_date AS closest_negative,
               CASE WHEN p.{START} - p.specimen_collection_date
                       > p.{START} - n.specimen_collection_date THEN 'Y' END AS closer_negative
        FROM nearest_positive p LEFT JOIN nearest_negative n ON p.{P} = n.{P}""",
    "negatives_on_treatment": _on_treatment(NEGATIVE),
    "positives_on_treatment": _on_treatment(POSITIVE),
    "conversion_pairs_every": f"""
        SELECT a.{P}, a.collection_date AS collection_date1, b.collection_date AS collection_date2,
               CAST(b.collection_date - a.collection_date AS INTEGER) AS days_between,
               CAST(count(base.closest_positive) AS BIGINT) AS pos_baseline,
               CAST(count(*) FILTER (WHERE p.collection_date >= a.collection_date
                    AND p.collection_date <= b.collection_date) AS BIGINT) AS pos_between,
               CAST(count(*) FILTER (WHERE base.closest_positive < a.collection_date) AS BIGINT)
                    AS cc_after_pos,
               CAST(count(*) FILTER (WHERE p.collection_date > b.collection_date) AS BIGINT)
                    AS pos_after_cc
        FROM negatives_on_treatment a
        JOIN negatives_on_treatment b ON a.{P} = b.{P} AND b.collection_date > a.collection_date + 15
        LEFT JOIN positives_on_treatment p ON a.{P} = p.{P}
        LEFT JOIN baseline_pair base ON a.{P} = base.{P}
        GROUP BY a.{P}, a.collection_date, b.collection_date""",
    "confirming_pairs": f"""
        SELECT * FROM conversion_pairs_every
        QUALIFY collection_date2 = min(collection_date2) OVER (PARTITION BY {P}, collection_date1)""",
    "conversion": f"""
        SELECT a.{P}, a.collection_date AS initial_cc_date,
               CASE WHEN EXISTS (SELECT 1 FROM positives_on_treatment p WHERE p.{P} = a.{P}
                    AND p.collection_date > b.collection_date) THEN 'Y' END AS revert_after_cc
        FROM (SELECT DISTINCT * FROM negatives_on_treatment) a
        JOIN (SELECT DISTINCT * FROM negatives_on_treatment) b
          ON a.{P} = b.{P} AND b.collection_date - a.collection_date > 15
        JOIN baseline_pair base ON base.{P} = a.{P} AND base.closest_positive < a.collection_date
        WHERE NOT EXISTS (SELECT 1 FROM positives_on_treatment p WHERE p.{P} = a.{P}
              AND p.collection_date BETWEEN a.collection_date AND b.collection_date)
        QUALIFY row_number() OVER (PARTITION BY a.{P}
                ORDER BY a.collection_date, b.collection_date) = 1""",
    "_spine": f"""
        SELECT v.*, t.* EXCLUDE ({P})
        FROM patient_program_view v JOIN treatment_initiation_template t ON v.{P} = t.{P}
        WHERE t.{START} IS NOT NULL AND v.patient_program_voided = 'false'""",
    "register_spine": f"SELECT {P}, patient_id, {START} FROM _spine",
    "treatment_period": f"SELECT {P}, {TREATMENT_PERIOD} FROM _spine",
    "treatment_duration": f"""
        SELECT s.{P}, {DURATION} AS "Treatment_Duration_(months)" FROM {_SPINE_END}""",
    "active_treatment": f"""
        SELECT s.{P}, CASE WHEN tuberculosis_treatment_end_date IS NULL THEN 'Yes' END
               AS "Active_Treatment" FROM {_SPINE_END}""",
    "clinic_enrollment_period": f"SELECT {P}, {CLINIC_PERIOD} FROM baseline_template",
    "_new_drugs": f"""
        SELECT {P}, d.start_date AS dlm_start_date, b.start_date AS bdq_start_date
        FROM first_dlm d FULL JOIN first_bdq b USING ({P})""",
    "new_drug_start": f"SELECT {P}, {select_list(NEW_DRUGS)} FROM _new_drugs",
    "hiv_status": _status(hiv(), "lab_hiv"),
    "hiv_status_pk": _status(hiv(NOT_RECORDED), "lab_hiv"),
    "hep_b_status": _status(hep_b(), "lab_hep_b"),
    "hep_b_status_pk": _status(hep_b(NOT_RECORDED), "lab_hep_b"),
    "hep_c_status": _status(hep_c(), "lab_hep_c"),
    "hep_c_status_pk": _status(hep_c(NOT_RECORDED), "lab_hep_c"),
    "diabetes_status": _status(diabetes(), None),
    "diabetes_status_pk": _status(diabetes(NOT_RECORDED), None),
    "culture_flags": f"""
        SELECT s.{P}, {select_list(CULTURE_FLAGS)}
        FROM _spine s LEFT JOIN baseline_pair p ON s.{P} = p.{P}
        LEFT JOIN conversion c ON s.{P} = c.{P}""",
    "next_visit": f"""
        SELECT v.{P}, CASE WHEN f.return_visit_date IS NULL THEN b.return_visit_date
               ELSE f.return_visit_date END AS "Next_Visit"
        FROM patient_program_view v LEFT JOIN baseline_template b ON v.{P} = b.{P}
        LEFT JOIN planned_return f ON v.{P} = f.{P}""",
    "regimen_type": f"""
        SELECT {P}, {REGIMEN_TYPE} AS "Type_of_Regimen" FROM treatment_initiation_template""",
    "district": f"""
        SELECT {P}, "patientDistrict" AS "District"
        FROM patient_program_view LEFT JOIN person_attributes ON patient_id = person_id""",
}
