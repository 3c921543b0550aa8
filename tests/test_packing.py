"""Rows that are moved as one number come back as they were, and the moves are shared and narrow."""

from __future__ import annotations

import datetime as dt
import itertools
from collections import Counter

import pytest
from minimart import MartBuilder, day
from pyspark.sql import functions as F

from rollbook.functions.packing import pack, row, unpack
from rollbook.operators import medication, serology
from rollbook.sources.bindings import BINDINGS, lines_by_order, supplied_mart

PARTS = {"a": (-3, 3), "b": (10, 5)}


@pytest.fixture
def sort_merge(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def rows_of(frame) -> Counter:
    return Counter(map(tuple, frame.collect()))


def test_numbers_come_back(spark):
    ends = (None, -(2**63), -4, -3, 0, 4, 5, 9, 10, 41, 42, 2**63 - 1)
    table = spark.createDataFrame(list(itertools.product([1], ends, ends)), "k int, a long, b long")
    packed = pack(table, {"a": F.col("a"), "b": F.col("b")}, PARTS)
    assert packed.columns == ["k", "code", "wide"]
    assert rows_of(packed.select("k", row(PARTS, unpack(PARTS)).alias("r")).select("k", "r.*")) == rows_of(table)
    # inside their bits: -3 to 4 and 10 to 41
    assert packed.where("code is not null and wide is null").count() == 3 * 2
    assert packed.where("code is null and wide is not null").count() == len(ends) ** 2 - 6


LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


def odd_lines() -> list[tuple]:
    base = [1, 27, 5, 3, 17.0, "R", "O", dt.datetime(1996, 12, 31)]
    odd = {
        0: [None, 2, 99],
        1: [None, 0, -1, -27, -105, 103, 104, 2**62],
        3: [None, 0, 1, 63, 64, -1],
        4: [None, 0.0, 2.5, -0.5, -3.0, 65535.0, 65535.5, 65536.0, 1e9],
        5: [None, "", "A", "N", "r", "other"],
        6: [None, "", "F", "o"],
        7: [None, dt.datetime(1996, 12, 31, 23, 59, 59), dt.datetime(1997, 1, 1), dt.datetime(1850, 3, 1), dt.datetime(2400, 1, 1)],
    }
    made = [base]
    for at, values in odd.items():
        made += [[*base[:at], value, *base[at + 1 :]] for value in values]
    made += [[2, k, k, k % 7, float(k), "ANR"[k % 3], "FO"[k % 2], dt.datetime(1996, 12, 1) + dt.timedelta(hours=7 * k)] for k in range(200)]
    return [tuple(r) for r in made]


@pytest.mark.parametrize("name", sorted(n for n, s in BINDINGS.items() if "{lineitem}" in s and "{orders}" in s))
def test_lines_by_order_give_the_same_rows(spark, name):
    lineitem = spark.createDataFrame(odd_lines(), LINES)
    orders = spark.createDataFrame([(1, 4), (1, 4), (2, 6), (None, 7), (3, None)], "o_orderkey long, o_custkey long")
    want = spark.sql(BINDINGS[name], lineitem=lineitem, orders=orders)
    got = spark.sql(BINDINGS[name], lineitem=lines_by_order(lineitem), orders=orders)
    assert got.dtypes == want.dtypes
    assert rows_of(got) == rows_of(want)


def test_lines_are_moved_to_their_orders_once(spark, sort_merge):
    mart = supplied_mart(spark, "/root/testdata/sf0.001")
    orders = mart["medication_data_default"]
    near = medication.orders_near_start(orders, mart["treatment_initiation_template"])
    both = medication.first_drug_starts(orders).join(medication.regimen_pivot(near), "patient_program_id", "full")
    both = both.join(serology.serology_results(mart["lab_results_serology_template"]), "patient_program_id", "full")
    both.collect()
    plan = both._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("struct<l_orderkey") == 1
    assert plan.count("ReusedExchange") >= 2


@pytest.fixture
def near_mart(spark, tmp_path):
    b = MartBuilder()
    for pid in range(3):
        b.enrolment(pid)
        drugs = (*list(medication.DRUGS)[:3], list(medication.DRUGS)[-1], "Another drug", "", None)
        for n, (drug, dose) in enumerate(itertools.product(drugs, (None, -1, 0, 800, 65535, 65536, 2**31 - 1))):
            b.drug(pid, drug, day(n % 20 - 10), dose, ("mg", None, "tab")[n % 3])
        b.drug(pid, "Isoniazid (H)", None, 1, "mg")
    return b.mart(spark, tmp_path), b.rows["medication_data_default"]


def test_orders_near_start_come_back(near_mart):
    mart, orders = near_mart
    near = medication.orders_near_start(mart["medication_data_default"], mart["treatment_initiation_template"])
    assert near.dtypes == [("patient_program_id", "bigint"), ("drug", "string"), ("dose", "int"), ("dose_unit", "string")]
    want = Counter(
        (r["patient_program_id"], r["coded_drug_name"], r.get("dose"), r.get("dose_units"))
        for r in orders
        if r["coded_drug_name"] is not None and r["start_date"] is not None and abs((r["start_date"] - day(0)).days) <= 7
    )
    assert rows_of(near) == want


def test_orders_move_without_their_drug_names(sort_merge, near_mart):
    mart, _ = near_mart
    near = medication.orders_near_start(mart["medication_data_default"], mart["treatment_initiation_template"])
    plan = near._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(k for k, line in enumerate(plan) if "Exchange hashpartitioning(patient_program_id" in line and "_bucket" in line)
    moved = plan[at + 1].split("Project [")[1]
    assert "code#" in moved.split("CASE")[0] and "drug#" not in moved.split("CASE")[0]
