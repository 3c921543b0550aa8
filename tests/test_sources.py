"""Mart access and the text helpers that depend on declared types."""

from __future__ import annotations

import pytest
from minimart import DAY_0, MartBuilder, day

from rollbook.functions.text import number_text
from rollbook.operators import medication
from rollbook.sources.bindings import BINDINGS, supplied_mart
from rollbook.sources.mart import Mart
from rollbook.session import start_partitions
from rollbook.sources.schemas import TABLES

SF_DIR = "/root/testdata/sf0.001"


def test_bindings_give_the_declared_columns(spark):
    mart = supplied_mart(spark, SF_DIR)
    assert set(BINDINGS) == set(TABLES)
    for name, ddl in TABLES.items():
        declared = [tuple(c.lower() for c in column.split()) for column in ddl.split(", ")]
        assert [(n.lower(), t) for n, t in mart[name].dtypes] == declared


def test_unknown_table(spark):
    with pytest.raises(KeyError):
        supplied_mart(spark, SF_DIR)["patients"]


def test_tables_load_once_and_on_demand(spark):
    loaded = []

    def load(name):
        loaded.append(name)
        return spark.createDataFrame([], TABLES[name])

    mart = Mart(load)
    assert loaded == []
    assert mart["person_attributes"] is mart["person_attributes"]
    assert loaded == ["person_attributes"]


def test_catalog_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE rollbook_case LOCATION '{tmp_path}'")
    try:
        frame = spark.createDataFrame([(1, "North")], TABLES["person_attributes"])
        frame.write.saveAsTable("rollbook_case.person_attributes")
        mart = Mart.from_catalog(spark, "rollbook_case")
        assert mart["person_attributes"].first()["patientDistrict"] == "North"
    finally:
        spark.sql("DROP DATABASE rollbook_case CASCADE")


@pytest.mark.parametrize(
    "kind, values",
    [
        ("INT", {"800": "800"}),
        ("DOUBLE", {"1000": "1000", "12.5": "12.5", "0.25": "0.25"}),
        ("DECIMAL(10,2)", {"800": "800", "12.50": "12.5", "100": "100"}),
        ("DECIMAL(10,0)", {"800": "800"}),
    ],
)
def test_numbers_as_text(spark, kind, values):
    rows = ", ".join(f"(CAST({v} AS {kind}), '{text}')" for v, text in values.items())
    frame = spark.sql(f"SELECT * FROM VALUES {rows} AS t(dose, wanted)")
    for row in frame.select(number_text(frame, "dose").alias("got"), "wanted").collect():
        assert row.got == row.wanted


def test_fractional_dose_in_the_regimen(spark, tmp_path):
    b = MartBuilder()
    b.enrolment(1)
    b.drug(1, "Isoniazid (H)", day(1), 12.5, "mg")
    b.drug(1, "Rifampicin (R)", day(1), 600.0, "mg")
    schema = TABLES["medication_data_default"].replace("dose INT", "dose DOUBLE")
    mart = b.mart(spark, tmp_path, {"medication_data_default": schema})
    near = medication.orders_near_start(
        mart["medication_data_default"], mart["treatment_initiation_template"]
    )
    row = medication.regimen_pivot(near).first()
    assert (row["H"], row["R"], row["E"]) == ("12.5 mg", "600 mg", None)


def test_order_timestamps_keep_their_time_of_day(spark):
    """An order on the evening of the last day is past the window, as a date it is not."""
    initiations = spark.createDataFrame(
        [(1, DAY_0)], "patient_program_id BIGINT, tuberculosis_drug_treatment_start_date DATE"
    )
    orders = spark.sql(
        "SELECT 1L AS patient_program_id, drug AS coded_drug_name, 1 AS dose, 'mg' AS dose_units, "
        "CAST(at AS TIMESTAMP) AS start_date FROM VALUES ('A', '2020-01-08 00:00:00'), "
        "('B', '2020-01-08 18:00:00'), ('C', '2019-12-25 06:00:00') AS t(drug, at)"
    )
    near = medication.orders_near_start(orders, initiations).collect()
    assert sorted(r.drug for r in near) == ["A", "C"]


@pytest.mark.parametrize("kind", ["double", "decimal(30,8)"])
def test_numbers_have_no_exponent(spark, kind):
    values = {0.0005: "0.0005", 12345678.5: "12345678.5", 1e15: "1000000000000000", -0.5: "-0.5", 0.0: "0", 0.00001: "0.00001", -800.0: "-800"}
    frame = spark.createDataFrame([(v,) for v in [*values, None]], "v double").selectExpr(f"CAST(v AS {kind}) AS d", "v")
    got = {r["v"]: r["text"] for r in frame.select("v", number_text(frame, "d").alias("text")).collect()}
    assert got == {**values, None: None}


def test_jdbc_bounds_are_per_table(spark):
    with pytest.raises(KeyError, match="person_attributes"):
        Mart.from_jdbc(spark, "jdbc:none:", {"patient_program_id": 10}, 4)["person_attributes"]


def test_start_partitions():
    assert start_partitions(0) == 200
    assert start_partitions(100 * 10**12) > 300_000
