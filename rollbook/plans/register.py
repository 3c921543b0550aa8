"""The register: one wide row per treated enrolment."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.chunks import CHUNK_ROWS, join_chunked
from rollbook.functions.dates import as_of_moment
from rollbook.operators import columns as col_ops
from rollbook.operators import cultures, facility, medication, serology
from rollbook.operators.disease_site import disease_site
from rollbook.plans.variants import DRUG_LABELS, GENERIC, PK, PNG, VARIANTS, Variant
from rollbook.sources.mart import Mart
from rollbook.sources.schemas import PID

START = cultures.START


def with_patient(rows: DataFrame, attributes: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows left-joined to attributes of their patient, both sides read once.

    Equal attributes are counted first, with map-side combine, and expanded after the
    join.  A patient with very many different ones, whom Spark never divides on the
    optional side of an outer join, has them dealt over chunks by their hash, and rows
    of the patient repeated for each; a patient with very many rows is on the side that adaptive
    execution divides.
    """
    names = attributes.columns
    # without null patients, and counted by the copies: so that both uses are one exchange
    known = attributes.where(F.col("patient_id").isNotNull())
    kinds = known.groupBy(*names).agg(F.count(F.lit(1)).alias("copies_"))
    heavy = (
        kinds.groupBy("patient_id")
        .agg(F.ceil(F.count_if(F.col("copies_") > 0) / chunk_rows).cast("int").alias("chunks_"))
        .where("chunks_ > 1")
    )
    chunks = F.col("chunks_")
    first = F.array(F.lit(0))
    place = F.when(chunks.isNull(), 0).otherwise(F.pmod(F.xxhash64(*names), chunks).cast("int"))
    each = F.when(chunks.isNull(), first).otherwise(F.sequence(F.lit(0), chunks - 1))
    there = kinds.join(heavy, "patient_id", "left").withColumn("chunk_", place).drop("chunks_")
    spread = rows.join(heavy, "patient_id", "left").withColumn("chunk_", F.explode(each))
    joined = spread.join(there, ["patient_id", "chunk_"], "left")
    # a chunk that got no attribute of a heavy patient has nothing to say
    kept = joined.where(chunks.isNull() | F.col("copies_").isNotNull())
    copies = F.sequence(F.lit(1).cast("long"), F.coalesce("copies_", F.lit(1).cast("long")))
    return kept.withColumn("copy_", F.explode(copies)).drop("chunk_", "chunks_", "copies_", "copy_")


def district(program_rows: DataFrame, persons: DataFrame) -> DataFrame:
    """Programme rows with the district of the patient."""
    districts = persons.select(F.col("person_id").alias("patient_id"), "patientDistrict")
    return with_patient(program_rows, districts)


def enrolled(program_rows: DataFrame) -> DataFrame:
    """Programme rows that are not voided; a missing flag drops the row."""
    return program_rows.where(F.col("patient_program_voided").cast("string") == "false")


def treated(initiations: DataFrame) -> DataFrame:
    """Initiation forms with a treatment start date."""
    return initiations.where(F.col(START).isNotNull())


def register_spine(program_rows: DataFrame, initiations: DataFrame) -> DataFrame:
    """Enrolments that are not voided and have a treatment start date."""
    return enrolled(program_rows).join(treated(initiations), PID)


def care_sources(mart: Mart, variant: Variant) -> tuple[list[DataFrame], list[str]]:
    """The facility forms that the site keeps."""
    stays = [
        facility.initiation_stays(mart["treatment_initiation_template"]),
        facility.followup_stays(mart["followup_template"]),
    ]
    sources = [facility.INITIATION, facility.FOLLOWUP]
    if variant.hospital is not None:
        admissions = mart["hospital_admission_notification_template"]
        stays.append(facility.hospital_stays(admissions, variant.hospital))
        sources.append(facility.HOSPITAL)
    return stays, sources


def culture_features(mart: Mart) -> DataFrame:
    marks = cultures.culture_marks(
        mart["treatment_initiation_template"],
        mart["bacteriology_culture_results_details"],
        mart["bacteriology_concept_set"],
    )
    return cultures.culture_summary(cultures.culture_timeline(cultures.culture_days(marks)))


def programs(mart: Mart, variant: Variant) -> DataFrame:
    """Programme rows with patient attributes.

    The joins on the patient come first, while the rows are narrow; everything
    after them joins on the enrolment.
    """
    rows = enrolled(mart["patient_program_view"])
    if variant.district:
        rows = district(rows, mart["person_attributes"])
    identifiers = mart["patient_identifier"].select(
        "patient_id", F.col("patient_id").alias("identified_patient_id"), "Patient_Identifier"
    )
    return with_patient(rows, identifiers)


def required_forms(mart: Mart, variant: Variant) -> dict[str, DataFrame]:
    """Tables that a register row needs; repeats multiply register rows."""
    return {
        "initiation": treated(mart["treatment_initiation_template"]),
        "program": programs(mart, variant),
    }


def optional_forms(mart: Mart) -> dict[str, DataFrame]:
    """Tables that a register row may lack; repeats multiply register rows."""
    attributes = mart["program_attributes"]
    registered = facility.enrollment_facility(attributes, mart["patient_program_data_default"])
    return {
        "attributes": attributes.select(PID, "Registration_Number"),
        "baseline": mart["baseline_template"]
        .drop("id_baseline_template")
        .withColumnRenamed("return_visit_date", "baseline_return_date"),
        "site": disease_site(mart["baseline_disease_site"]).drop("id_baseline_template"),
        "registered": registered.select(PID, "facility", F.lit(True).alias("registered")),
        "outcome": mart["outcome_end_of_treatment_template"],
    }


def features(mart: Mart, variant: Variant) -> list[DataFrame]:
    """Tables with one row per enrolment, each clustered by it."""
    initiations = mart["treatment_initiation_template"]
    medications = mart["medication_data_default"]
    return [
        medication.first_drug_starts(medications),
        facility.care_history(
            *care_sources(mart, variant), "earliest" if variant.followup_return else None
        ),
        medication.regimen_pivot(medication.orders_near_start(medications, initiations)),
        serology.serology_results(mart["lab_results_serology_template"]),
        culture_features(mart).drop(START),
    ]


def assemble(mart: Mart, variant: Variant) -> DataFrame:
    """One row per combination of an enrolment's forms, with every feature.

    A lazy plan that divides an enrolment with very many rows of a form
    (``rollbook.functions.chunks``).
    """
    programs_ = mart["patient_program_view"].select(PID, "patient_id")
    patients = mart["patient_identifier"].select("patient_id")
    if variant.district:
        persons = mart["person_attributes"].select(F.col("person_id").alias("patient_id"))
        patients = patients.unionAll(persons)
    keys = {
        "program": programs_.join(patients, "patient_id"),
        "site": mart["baseline_disease_site"],
        "registered": mart["patient_program_data_default"],
    }
    return join_chunked(
        required_forms(mart, variant),
        optional_forms(mart),
        features(mart, variant),
        keys,
        clustered=mart.clustered,
    )


def register_columns(variant: Variant, as_of: Column) -> dict[str, Column]:
    """Every reportable column over the assembled rows."""
    c = F.col
    unrecorded = variant.unrecorded
    columns = {
        "Registration_Number": c("Registration_Number"),
        "Register": c("program_name"),
        "EMR_ID": c("Patient_Identifier"),
        "Sex": c("gender"),
        "Age_at_Registration": c("age_at_program"),
        "Age_Group_at_Registration": c("age_group_at_program"),
        "WHO_Registration_Group": c("baseline_who_registration_group"),
        "History_of_Previously_Treated": c("category_iv_tuberculosis_classification"),
        "Baseline_Disease_Site": c("disease_site"),
        "MTB_Confirmed": c("baseline_mdr_tb_diagnosis_method"),
        "Drug_Resistance_Profile": c("baseline_drug_resistance"),
        "Sub-class_of_Drug_Resistance_Profile": c(
            "baseline_subclassification_for_confimed_drug_resistant_case"
        ),
        **col_ops.treatment_period(c(START)),
        **col_ops.treatment_duration(
            c(START), c("tuberculosis_treatment_end_date"), as_of
        ),
        **col_ops.clinic_enrollment_period(c("baseline_date_of_baseline")),
        "Second_Line_Treatment_Type": c("ti_second_line_regimen_drug_type"),
        **col_ops.regimen_type(c("ti_type_of_treatment_regimen")),
        **col_ops.new_drug_start(c("dlm_start_date"), c("bdq_start_date")),
        "Last_Facility": F.when(c("registered"), F.coalesce("seen_at", "facility")),
        **{label: c(f"`{short}`") for short, label in DRUG_LABELS.items()},
        **col_ops.hiv_status(
            c("baseline_hiv_serostatus_result"), c("hiv_result"), unrecorded
        ),
        **col_ops.hep_b_status(c("baseline_hepatitis_b"), c("hep_b_result"), unrecorded),
        **col_ops.hep_c_status(c("baseline_hepatitis_c"), c("hep_c_result"), unrecorded),
        **col_ops.diabetes_status(c("diabetes_mellitus"), unrecorded),
        **col_ops.culture_flags(
            c(START),
            c("closest_positive"),
            c("closer_negative"),
            c("initial_cc_date"),
            c("revert_after_cc"),
        ),
        "Outcome": c("eot_outcome"),
        "End_of_Treatment_Date": c("tuberculosis_treatment_end_date"),
        **col_ops.active_treatment(c("tuberculosis_treatment_end_date")),
        "patient_id": c("patient_id"),
        "patient_program_id": c(PID),
        "background_sum": F.lit(1),
        "background_count": F.lit("x"),
    }
    if variant.followup_return:
        columns |= col_ops.next_visit(c("return_on"), c("baseline_return_date"))
    if variant.district:
        columns["District"] = c("patientDistrict")
    return columns


def register(
    mart: Mart,
    variant: Variant | str = GENERIC,
    as_of: Column | date | datetime | str | None = None,
    ordered: bool = False,
) -> DataFrame:
    """The register of one site.

    ``as_of`` fixes the moment that open treatments are measured to (default: the
    clock).  ``ordered`` sorts by the patient of the identifier table, unknown
    patients last; leave it off when writing at scale.  Rows of one patient, and those of
    unknown ones, are ordered by a hash of their enrolment, which lets the sort's ranges part them.
    """
    if isinstance(variant, str):
        variant = VARIANTS[variant]
    rows = assemble(mart, variant)
    if ordered:
        rows = rows.orderBy(F.asc_nulls_last("identified_patient_id"), F.xxhash64(PID))
    columns = register_columns(variant, as_of_moment(as_of))
    return rows.select(*[columns[c].alias(label) for c, label in variant.labels().items()])


def register_generic(mart: Mart, as_of=None, ordered: bool = False) -> DataFrame:
    return register(mart, GENERIC, as_of, ordered)


def register_pk(mart: Mart, as_of=None, ordered: bool = False) -> DataFrame:
    return register(mart, PK, as_of, ordered)


def register_png(mart: Mart, as_of=None, ordered: bool = False) -> DataFrame:
    return register(mart, PNG, as_of, ordered)


def grain(rows: DataFrame, key: str = PID) -> DataFrame:
    """How many enrolments have how many rows; anything above one was multiplied."""
    return (
        rows.groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows_per_enrolment"))
        .groupBy("rows_per_enrolment")
        .agg(F.count(F.lit(1)).alias("enrolments"))
    )


def grain_forecast(mart: Mart, variant: Variant = GENERIC) -> DataFrame:
    """What ``grain`` will find, from counts of forms alone and before any of them is joined.

    An enrolment's register rows are the product of its rows of each form; a form that
    may be absent counts once then.  Every form is counted with map-side combine, and
    only counts meet.
    """
    required, optional = required_forms(mart, variant), optional_forms(mart)
    stacked = None
    for name, table in {**required, **optional}.items():
        counts = table.where(F.col(PID).isNotNull()).groupBy(PID).agg(F.count(F.lit(1)).alias("rows"))
        own = counts.select(PID, F.lit(name).alias("form"), "rows")
        stacked = own if stacked is None else stacked.unionAll(own)
    rows = {name: F.coalesce(F.sum(F.when(F.col("form") == name, F.col("rows"))), F.lit(0)) for name in (*required, *optional)}
    product = F.lit(1).cast("long")
    for name in required:
        product = product * rows[name]
    for name in optional:
        product = product * F.greatest(rows[name], F.lit(1))
    forecast = stacked.groupBy(PID).agg(product.alias("rows_per_enrolment"))
    return (
        forecast.where("rows_per_enrolment > 0")
        .groupBy("rows_per_enrolment")
        .agg(F.count(F.lit(1)).alias("enrolments"))
    )
