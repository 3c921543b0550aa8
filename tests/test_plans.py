"""Shape of the physical plans."""

from __future__ import annotations

import re

import pytest
from minimart import DAY_0, MartBuilder

from rollbook import queries as named
from rollbook.functions.chunks import join_chunked
from rollbook.operators import cultures, medication, serology
from rollbook.plans import register as reg
from rollbook.plans.register import register
from rollbook.plans.variants import VARIANTS
from rollbook.sources.mart import Mart
from rollbook.sources.schemas import PID, TABLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    b = MartBuilder()
    b.enrolment(1)
    b.drug(1, "Isoniazid (H)", DAY_0, 1, "mg")
    return b.mart(spark, tmp_path_factory.mktemp("plans"))


@pytest.fixture
def sort_merge(spark):
    """Plans as they are when no side is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(named.NAMED))
def test_no_python_and_no_pairing_of_everything(spark, name):
    plan = plan_of(named.run(name, spark, SF_DIR))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas", "MapInArrow"):
        assert node not in plan


def exchanges(plan: str) -> list[str]:
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    return [re.sub(r"#\d+L?", "", k) for k in keys]


@pytest.mark.parametrize("variant", sorted(VARIANTS))
def test_register_moves_each_table_once_per_key(sort_merge, mart, variant):
    """No exchange between the joins: one per form, and one for all features together."""
    plan = plan_of(register(mart, variant, "2020-02-01"))
    found = exchanges(plan)
    # initiation, programme, attributes, baseline, site, registration, outcome, features
    assert found.count("patient_program_id, chunk_") == 8
    # Heavy enrolments are one plan, which adaptive execution runs once and reuses: once
    # to repeat rows of a form, once to deal them.
    assert found.count("largest_form_") == 8 + 7


FORMS = (
    "treatment_initiation_template", "patient_program_view", "program_attributes", "baseline_template",
    "baseline_disease_site", "patient_program_data_default", "outcome_end_of_treatment_template",
)


@pytest.fixture
def bucketed(spark, mart, tmp_path):
    """The mart as catalog tables, those with enrolments bucketed by them."""
    spark.sql(f"CREATE DATABASE bucketed_mart LOCATION '{tmp_path}/tables'")
    for name in TABLES:
        writer = mart[name].write
        if PID in mart[name].columns:
            writer = writer.bucketBy(4, PID).sortBy(PID)
        writer.saveAsTable(f"bucketed_mart.{name}")
    yield Mart.from_catalog(spark, "bucketed_mart")
    spark.sql("DROP DATABASE bucketed_mart CASCADE")


def test_stored_clustered_forms_stay_where_they_are(spark, sort_merge, mart, bucketed):
    """Ordinary enrolments are joined bucket by bucket: no form of theirs is moved."""
    assert bucketed.clustered and not mart.clustered
    required = {"initiation": reg.treated(bucketed[FORMS[0]]), "program": bucketed[FORMS[1]]}
    rows = join_chunked(required, reg.optional_forms(bucketed), clustered=True)
    plan = plan_of(rows)
    ordinary = plan[plan.index("Union") : plan.index("chunk_")]
    moved = [k for k in exchanges(ordinary) if k == "patient_program_id"]
    # heavy enrolments only: their forms' counts meet, and their keys go to the buckets
    assert len(moved) == 2
    assert ordinary.count("Bucketed: true") >= len(FORMS)
    # the whole register: programme rows come from joins on the patient, so they are moved
    plain = register(mart, "generic", "2020-02-01").collect()
    assert register(bucketed, "generic", "2020-02-01").collect() == plain


def test_patients_are_read_once_a_side(spark, sort_merge, tmp_path):
    b = MartBuilder()
    for k in range(20):
        b.enrolment(k)
        b.person(k, f"district {k}")
    mart = b.mart(spark, tmp_path)
    rows = reg.district(mart["patient_program_view"], mart["person_attributes"])
    rows.collect()
    plan = plan_of(rows).split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 2  # the count of attributes a patient is a reused exchange
    assert "ReusedExchange" in plan


def test_culture_windows_share_one_exchange(sort_merge, mart):
    marks = cultures.culture_marks(
        mart["treatment_initiation_template"],
        mart["bacteriology_culture_results_details"],
        mart["bacteriology_concept_set"],
    )
    days = cultures.culture_days(marks)
    plan = plan_of(cultures.culture_summary(cultures.culture_timeline(days)))
    assert exchanges(plan) == [
        "patient_program_id",
        "patient_program_id, day",
        "id_bacteriology_concept_set",
        "id_bacteriology_concept_set",
    ]
    assert "partial_bit_or" in plan


def test_picks_combine_before_the_exchange(mart):
    plan = plan_of(serology.serology_results(mart["lab_results_serology_template"]))
    assert "partial_min" in plan and "Window" not in plan
    assert exchanges(plan) == ["patient_program_id"]


def test_scans_read_what_they_need(mart):
    plan = plan_of(
        medication.first_drug_start(mart["medication_data_default"], medication.DELAMANID)
    )
    schema = re.search(r"ReadSchema: (\S+)", plan).group(1)
    assert "dose" not in schema
    assert "EqualTo(coded_drug_name,Delamanid (Dlm))" in plan
    assert "HashAggregate" in plan and "SortAggregate" not in plan
