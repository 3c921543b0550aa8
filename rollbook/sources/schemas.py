"""Declared columns of the input tables (fixed values: names follow the mart)."""

PID = "patient_program_id"

TABLES: dict[str, str] = {
    "patient_program_view": (
        "patient_program_id BIGINT, patient_id BIGINT, program_name STRING, gender STRING, "
        "age_at_program INT, age_group_at_program STRING, patient_program_voided STRING"
    ),
    "treatment_initiation_template": (
        "patient_program_id BIGINT, tuberculosis_drug_treatment_start_date DATE, "
        "ti_treatment_facility_at_start STRING, ti_second_line_regimen_drug_type STRING, "
        "ti_type_of_treatment_regimen STRING"
    ),
    "patient_identifier": "patient_id BIGINT, Patient_Identifier STRING",
    "program_attributes": (
        "patient_program_id BIGINT, Registration_Number STRING, Registration_Facility STRING"
    ),
    "baseline_template": (
        "patient_program_id BIGINT, id_baseline_template BIGINT, "
        "baseline_who_registration_group STRING, category_iv_tuberculosis_classification STRING, "
        "baseline_mdr_tb_diagnosis_method STRING, baseline_drug_resistance STRING, "
        "baseline_subclassification_for_confimed_drug_resistant_case STRING, "
        "baseline_hiv_serostatus_result STRING, baseline_hepatitis_b STRING, "
        "baseline_hepatitis_c STRING, diabetes_mellitus STRING, "
        "baseline_date_of_baseline DATE, return_visit_date DATE"
    ),
    "baseline_disease_site": (
        "patient_program_id BIGINT, id_baseline_template BIGINT, baseline_disease_site STRING"
    ),
    "hospital_admission_notification_template": (
        "patient_program_id BIGINT, han_hospital_admission_date DATE, "
        "treatment_facility_name STRING, other_treatment_facility_name STRING, "
        "han_hospital_name STRING"
    ),
    "followup_template": (
        "patient_program_id BIGINT, followup_visit_date DATE, return_visit_date DATE, "
        "treatment_facility_name STRING, other_treatment_facility_name STRING"
    ),
    "patient_program_data_default": "patient_program_id BIGINT, date_enrolled DATE",
    "medication_data_default": (
        "patient_program_id BIGINT, coded_drug_name STRING, dose INT, dose_units STRING, "
        "start_date DATE"
    ),
    "lab_results_serology_template": (
        "patient_program_id BIGINT, specimen_collection_date DATE, lab_hiv_test_result STRING, "
        "lab_hepatitis_b_antigen_test_result STRING, lab_hepatitis_c_antibody_test_result STRING"
    ),
    "bacteriology_culture_results_details": (
        "patient_program_id BIGINT, id_bacteriology_concept_set BIGINT, "
        "bacteriology_culture_results STRING"
    ),
    "bacteriology_concept_set": (
        "id_bacteriology_concept_set BIGINT, specimen_collection_date DATE"
    ),
    "outcome_end_of_treatment_template": (
        "patient_program_id BIGINT, eot_outcome STRING, tuberculosis_treatment_end_date DATE"
    ),
    "person_attributes": "person_id BIGINT, patientDistrict STRING",
}
