"""Named queries: every operator over the mart bound to the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.functions.chunks import join_chunked
from rollbook.functions.dates import as_of_moment
from rollbook.operators import columns as col_ops
from rollbook.operators import cultures, facility, medication, serology
from rollbook.operators.disease_site import disease_site
from rollbook.plans import register as reg
from rollbook.plans.variants import GENERIC, PK, PNG, VARIANTS, Variant
from rollbook.sources.bindings import supplied_mart
from rollbook.sources.mart import Mart
from rollbook.sources.schemas import PID

AS_OF = "2002-01-01"
START = cultures.START

Query = Callable[[Mart], DataFrame]


def _initiations(m: Mart) -> DataFrame:
    return m["treatment_initiation_template"]


def _spine(m: Mart) -> DataFrame:
    return reg.register_spine(m["patient_program_view"], _initiations(m))


def _spine_with(m: Mart, optional: dict[str, DataFrame], features: list[DataFrame] | None = None):
    forms = {"initiation": reg.treated(_initiations(m)), "program": reg.enrolled(m["patient_program_view"])}
    return join_chunked(forms, optional, features or [])


def _stays(m: Mart, form: str, mode: str = "coded") -> DataFrame:
    if form == facility.INITIATION:
        return facility.initiation_stays(_initiations(m))
    if form == facility.FOLLOWUP:
        return facility.followup_stays(m["followup_template"])
    return facility.hospital_stays(m["hospital_admission_notification_template"], mode)


def _registered(m: Mart) -> DataFrame:
    return facility.enrollment_facility(
        m["program_attributes"], m["patient_program_data_default"]
    )


def _last_facility(m: Mart, variant: Variant) -> DataFrame:
    care = facility.care_history(*reg.care_sources(m, variant), return_pick=None)
    forms = {"attributes": m["program_attributes"], "enrolled": m["patient_program_data_default"]}
    return facility.last_facility(facility.registration(join_chunked(forms, {}, [care]), "seen_at"))


def _first_start(drug: str) -> Query:
    return lambda m: medication.first_drug_start(m["medication_data_default"], drug)


def _near(m: Mart) -> DataFrame:
    return medication.orders_near_start(m["medication_data_default"], _initiations(m))


def _serology(test: str) -> Query:
    return lambda m: serology.serology_result(m["lab_results_serology_template"], test)


def _cultures(m: Mart) -> tuple[DataFrame, DataFrame]:
    return m["bacteriology_culture_results_details"], m["bacteriology_concept_set"]


def _window(m: Mart, result: str) -> DataFrame:
    events = cultures.culture_events(*_cultures(m), result)
    return cultures.baseline_window(_initiations(m), events)


def _marks(m: Mart) -> DataFrame:
    return cultures.culture_marks(_initiations(m), *_cultures(m))


def _timeline(m: Mart) -> DataFrame:
    return cultures.culture_timeline(cultures.culture_days(_marks(m)))


def _summary(m: Mart) -> DataFrame:
    return cultures.culture_summary(_timeline(m))


def _keyed(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return rows.select(PID, *[c.alias(label) for label, c in columns.items()])


def _treatment_duration(m: Mart) -> DataFrame:
    rows = _spine_with(m, {"outcome": m["outcome_end_of_treatment_template"]})
    end = F.col("tuberculosis_treatment_end_date")
    return _keyed(rows, col_ops.treatment_duration(F.col(START), end, as_of_moment(AS_OF)))


def _active_treatment(m: Mart) -> DataFrame:
    rows = _spine_with(m, {"outcome": m["outcome_end_of_treatment_template"]})
    return _keyed(rows, col_ops.active_treatment(F.col("tuberculosis_treatment_end_date")))


def _new_drug_start(m: Mart) -> DataFrame:
    starts = medication.first_drug_starts(m["medication_data_default"])
    return _keyed(
        starts, col_ops.new_drug_start(F.col("dlm_start_date"), F.col("bdq_start_date"))
    )


def _status(test: str, baseline: str, columns: Callable, variant: Variant) -> Query:
    def query(m: Mart) -> DataFrame:
        lab = serology.serology_result(m["lab_results_serology_template"], test)
        rows = join_chunked({"baseline": m["baseline_template"]}, {}, [lab])
        return _keyed(rows, columns(F.col(baseline), F.col(test), variant.unrecorded))

    return query


def _diabetes(variant: Variant) -> Query:
    return lambda m: _keyed(
        m["baseline_template"],
        col_ops.diabetes_status(F.col("diabetes_mellitus"), variant.unrecorded),
    )


def _culture_flags(m: Mart) -> DataFrame:
    rows = _spine_with(m, {}, [_summary(m).drop(START)])
    return _keyed(
        rows,
        col_ops.culture_flags(
            *map(F.col, (START, "closest_positive", "closer_negative")),
            *map(F.col, ("initial_cc_date", "revert_after_cc")),
        ),
    )


def _next_visit(m: Mart) -> DataFrame:
    planned = facility.followup_return_visit(m["followup_template"])
    baseline = m["baseline_template"].select(PID, F.col("return_visit_date").alias("b"))
    rows = join_chunked(
        {"program": m["patient_program_view"].select(PID)}, {"baseline": baseline}, [planned]
    )
    return _keyed(rows, col_ops.next_visit(F.col("return_visit_date"), F.col("b")))


def _register(name: str) -> Query:
    return lambda m: reg.register(m, VARIANTS[name], AS_OF)


NAMED: dict[str, Query] = {
    "disease_site_recode": lambda m: disease_site(m["baseline_disease_site"]),
    "latest_facility_treatment_start": lambda m: facility.latest_facility(
        _stays(m, facility.INITIATION)
    ),
    "latest_facility_hospital": lambda m: facility.latest_facility(
        _stays(m, facility.HOSPITAL)
    ),
    "latest_facility_hospital_named": lambda m: facility.latest_facility(
        _stays(m, facility.HOSPITAL, "hospital_name")
    ),
    "latest_facility_followup": lambda m: facility.latest_facility(
        _stays(m, facility.FOLLOWUP)
    ),
    "facility_history": lambda m: facility.facility_history(*reg.care_sources(m, GENERIC)),
    "facility_history_no_hospital": lambda m: facility.facility_history(
        *reg.care_sources(m, PNG)
    ),
    "enrollment_facility": _registered,
    "last_facility": lambda m: _last_facility(m, GENERIC),
    "last_facility_pk": lambda m: _last_facility(m, PK),
    "last_facility_png": lambda m: _last_facility(m, PNG),
    "first_start_dlm": _first_start(medication.DELAMANID),
    "first_start_bdq": _first_start(medication.BEDAQUILINE),
    "regimen_near_start": lambda m: medication.regimen_near_start(
        m["medication_data_default"], _initiations(m)
    ),
    "regimen_pivot": lambda m: medication.regimen_pivot(_near(m)),
    "serology_hiv": _serology("hiv_result"),
    "serology_hep_b": _serology("hep_b_result"),
    "serology_hep_c": _serology("hep_c_result"),
    "followup_return_visit": lambda m: facility.followup_return_visit(m["followup_template"]),
    "culture_events": lambda m: cultures.culture_events(
        *_cultures(m), cultures.POSITIVE, cultures.NEGATIVE
    ),
    "baseline_window_positive": lambda m: _window(m, cultures.POSITIVE),
    "baseline_window_negative": lambda m: _window(m, cultures.NEGATIVE),
    "closest_positive": lambda m: cultures.closest_event(_timeline(m), cultures.POSITIVE),
    "closest_negative": lambda m: cultures.closest_event(_timeline(m), cultures.NEGATIVE),
    "baseline_positive": lambda m: cultures.baseline_positive(_summary(m)),
    "post_start_negative": lambda m: cultures.post_start_cultures(
        _initiations(m), *_cultures(m), cultures.NEGATIVE
    ),
    "post_start_positive": lambda m: cultures.post_start_cultures(
        _initiations(m), *_cultures(m), cultures.POSITIVE
    ),
    "conversion_pairs": lambda m: cultures.conversion_pairs(
        cultures.culture_timeline(cultures.culture_counts(_marks(m)))
    ),
    "conversion_pairs_every": lambda m: cultures.conversion_pairs(
        cultures.culture_timeline(cultures.culture_counts(_marks(m))), every=True
    ),
    "initial_conversion": lambda m: cultures.initial_conversion(_summary(m)),
    "treatment_period": lambda m: _keyed(_spine(m), col_ops.treatment_period(F.col(START))),
    "treatment_duration": _treatment_duration,
    "clinic_enrollment_period": lambda m: _keyed(
        m["baseline_template"],
        col_ops.clinic_enrollment_period(F.col("baseline_date_of_baseline")),
    ),
    "new_drug_start": _new_drug_start,
    "hiv_status": _status(
        "hiv_result", "baseline_hiv_serostatus_result", col_ops.hiv_status, GENERIC
    ),
    "hiv_status_pk": _status(
        "hiv_result", "baseline_hiv_serostatus_result", col_ops.hiv_status, PK
    ),
    "hep_b_status": _status(
        "hep_b_result", "baseline_hepatitis_b", col_ops.hep_b_status, GENERIC
    ),
    "hep_b_status_pk": _status(
        "hep_b_result", "baseline_hepatitis_b", col_ops.hep_b_status, PK
    ),
    "hep_c_status": _status(
        "hep_c_result", "baseline_hepatitis_c", col_ops.hep_c_status, GENERIC
    ),
    "hep_c_status_pk": _status(
        "hep_c_result", "baseline_hepatitis_c", col_ops.hep_c_status, PK
    ),
    "diabetes_status": _diabetes(GENERIC),
    "diabetes_status_pk": _diabetes(PK),
    "culture_flags": _culture_flags,
    "next_visit": _next_visit,
    "active_treatment": _active_treatment,
    "regimen_type": lambda m: _keyed(
        _initiations(m), col_ops.regimen_type(F.col("ti_type_of_treatment_regimen"))
    ),
    "district": lambda m: reg.district(
        m["patient_program_view"], m["person_attributes"]
    ).select(PID, F.col("patientDistrict").alias("District")),
    "register_spine": lambda m: _spine(m).select(PID, "patient_id", START),
    "register_grain": lambda m: reg.grain(_register("generic")(m)),
    "register_grain_forecast": lambda m: reg.grain_forecast(m, GENERIC),
    "register_generic": _register("generic"),
    "register_pk": _register("pk"),
    "register_png": _register("png"),
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return NAMED[name](supplied_mart(spark, sf_dir))
