"""Small hand-made marts, written as parquet and read back with the declared schemas."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

from rollbook.sources.mart import Mart
from rollbook.sources.schemas import TABLES

ARROW = {
    "BIGINT": pa.int64(),
    "INT": pa.int32(),
    "STRING": pa.string(),
    "DATE": pa.date32(),
    "DOUBLE": pa.float64(),
}
DAY_0 = dt.date(2020, 1, 1)


def day(offset: int) -> dt.date:
    return DAY_0 + dt.timedelta(days=offset)


def date(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def mini_mart(spark, folder: Path, rows: dict[str, list[dict]], schemas=None) -> Mart:
    """A mart whose tables hold ``rows``; columns left out are null."""
    declared = {**TABLES, **(schemas or {})}
    for name, ddl in declared.items():
        fields = [column.split() for column in ddl.split(", ")]
        schema = pa.schema([(column, ARROW[kind]) for column, kind in fields])
        given = [{c: row.get(c) for c, _ in fields} for row in rows.get(name, [])]
        (folder / name).mkdir(parents=True)
        pq.write_table(pa.Table.from_pylist(given, schema=schema), folder / name / "part.parquet")
    return Mart.from_parquet(spark, str(folder), schemas)


class MartBuilder:
    """Collects rows by short form names."""

    def __init__(self):
        self.rows: dict[str, list[dict]] = {}
        self._specimen = 0

    def add(self, table: str, pid: int, **values) -> None:
        self.rows.setdefault(table, []).append({"patient_program_id": pid, **values})

    def program(self, pid: int, patient: int | None = None, voided: str | None = "false", **values):
        patient = pid if patient is None else patient
        self.add(
            "patient_program_view",
            pid,
            patient_id=patient,
            patient_program_voided=voided,
            program_name="P",
            **values,
        )

    def start(self, pid: int, on: dt.date | None = DAY_0, **values):
        values["tuberculosis_drug_treatment_start_date"] = on
        self.add("treatment_initiation_template", pid, **values)

    def enrolment(self, pid: int, on: dt.date = DAY_0, **values):
        self.program(pid)
        self.start(pid, on, **values)

    def baseline(self, pid: int, form: int = 1, **values):
        self.add("baseline_template", pid, id_baseline_template=form, **values)

    def site(self, pid: int, site: str | None, form: int = 1):
        self.add(
            "baseline_disease_site", pid, id_baseline_template=form, baseline_disease_site=site
        )

    def visit(self, pid: int, on: dt.date | None, name=None, other=None, returns=None):
        self.add(
            "followup_template",
            pid,
            followup_visit_date=on,
            treatment_facility_name=name,
            other_treatment_facility_name=other,
            return_visit_date=returns,
        )

    def registration(self, pid: int, facility: str, enrolled: bool = True):
        self.add(
            "program_attributes", pid, Registration_Number=f"N{pid}", Registration_Facility=facility
        )
        if enrolled:
            self.add("patient_program_data_default", pid, date_enrolled=DAY_0)

    def drug(self, pid: int, drug: str | None, on: dt.date | None, dose=None, unit=None):
        self.add(
            "medication_data_default",
            pid,
            coded_drug_name=drug,
            start_date=on,
            dose=dose,
            dose_units=unit,
        )

    def lab(self, pid: int, on: dt.date | None, hiv=None, hep_b=None, hep_c=None):
        self.add(
            "lab_results_serology_template",
            pid,
            specimen_collection_date=on,
            lab_hiv_test_result=hiv,
            lab_hepatitis_b_antigen_test_result=hep_b,
            lab_hepatitis_c_antibody_test_result=hep_c,
        )

    def culture(self, pid: int, on: dt.date | None, result: str):
        self._specimen += 1
        self.add(
            "bacteriology_culture_results_details",
            pid,
            id_bacteriology_concept_set=self._specimen,
            bacteriology_culture_results=result,
        )
        self.rows.setdefault("bacteriology_concept_set", []).append(
            {"id_bacteriology_concept_set": self._specimen, "specimen_collection_date": on}
        )

    def positive(self, pid: int, *days: int):
        for offset in days:
            self.culture(pid, day(offset), "Positive for M. tuberculosis")

    def negative(self, pid: int, *days: int):
        for offset in days:
            self.culture(pid, day(offset), "Negative for M. tuberculosis")

    def outcome(self, pid: int, end: dt.date | None, outcome: str = "Cured"):
        self.add(
            "outcome_end_of_treatment_template",
            pid,
            eot_outcome=outcome,
            tuberculosis_treatment_end_date=end,
        )

    def identifier(self, patient: int, text: str):
        self.rows.setdefault("patient_identifier", []).append(
            {"patient_id": patient, "Patient_Identifier": text}
        )

    def person(self, patient: int, district: str):
        self.rows.setdefault("person_attributes", []).append(
            {"person_id": patient, "patientDistrict": district}
        )

    def mart(self, spark, folder: Path, schemas=None) -> Mart:
        return mini_mart(spark, folder, self.rows, schemas)
