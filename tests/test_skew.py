"""Row-level joins split an enrolment that holds most of the rows."""

from __future__ import annotations

import random
import tempfile
from collections import Counter

import pytest
from minimart import DAY_0, MartBuilder, day
from pyspark.sql import functions as F

from rollbook.functions.chunks import dealt, join_chunked
from rollbook.functions.ranges import join_since
from rollbook.operators import cultures, medication
from rollbook.plans import register as reg
from rollbook.plans.register import register
from rollbook.plans.variants import GENERIC
from rollbook.queries import NAMED
from rollbook.sources.schemas import PID

HOT_ROWS = 6000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.files.maxPartitionBytes": "16KB",
    "spark.sql.files.openCostInBytes": "0",
}


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    rnd = random.Random(7)
    b = MartBuilder()
    for pid in range(200):
        b.enrolment(pid)
        b.positive(pid, -5)
        b.negative(pid, 10, 40)
        b.drug(pid, "Isoniazid (H)", DAY_0, pid % 7, "mg")
    for n in range(HOT_ROWS):
        b.negative(0, rnd.randint(0, 90))
        b.drug(0, "Rifampicin (R)", day(3), rnd.randint(1, 10**9), "mg")
        b.visit(0, day(n % 300), f"Facility {n}")
        b.lab(0, day(n % 300), hiv="Positive")
    folder = tmp_path_factory.mktemp("hot")
    wide = b.mart(spark, folder)
    # Many input splits, so that a heavy partition has map outputs to be divided by.
    for name in ("medication_data_default", "bacteriology_culture_results_details"):
        path = tmp_path_factory.mktemp("split") / name
        wide[name].repartition(8).write.parquet(str(path))
        wide._tables[name] = spark.read.parquet(str(path))
    return wide


@pytest.fixture
def small_thresholds(spark):
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key in SMALL:
        spark.conf.unset(key)


def final_plan(frame) -> str:
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_orders_near_start(small_thresholds, mart):
    near = medication.orders_near_start(
        mart["medication_data_default"], mart["treatment_initiation_template"]
    )
    assert near.count() == 200 + HOT_ROWS
    assert "skew=true" in final_plan(medication.regimen_pivot(near))


def test_post_start_cultures(spark, small_thresholds, mart):
    """The heavy enrolment is spread over its dates, without help from adaptive execution."""
    rows = cultures.post_start_cultures(
        mart["treatment_initiation_template"],
        mart["bacteriology_culture_results_details"],
        mart["bacteriology_concept_set"],
        cultures.NEGATIVE,
    )
    assert rows.count() == 400 + HOT_ROWS
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        most, total = largest_share(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert total == 400 + HOT_ROWS and most < 0.6 * total


def test_join_since_against_pairs(spark):
    rnd = random.Random(3)
    events = [(rnd.choice([1, 2, 3, None]), day(rnd.randint(0, 400)) if rnd.random() < 0.9 else None, n) for n in range(300)]
    anchors = [(rnd.choice([1, 2, 4, None]), day(rnd.choice([5, 5, 90, 200])) if rnd.random() < 0.8 else None) for _ in range(12)]
    a = spark.createDataFrame(events, "k int, at date, n int")
    b = spark.createDataFrame(anchors, "k int, since date")
    got = Counter(map(tuple, join_since(a, b, "k", "at", "since").collect()))
    want = Counter(e for e in events for k, since in anchors if None not in (e[0], e[1], since) and k == e[0] and since <= e[1])
    assert got == want


def test_baseline_window(small_thresholds, mart):
    events = cultures.culture_events(
        mart["bacteriology_culture_results_details"],
        mart["bacteriology_concept_set"],
        cultures.NEGATIVE,
    )
    window = cultures.baseline_window(mart["treatment_initiation_template"], events)
    assert "skew=true" in final_plan(window)


def test_register_of_a_heavy_enrolment(mart):
    row = register(mart, "generic", "2020-12-31").where("patient_program_id = 0").collect()
    assert len(row) == 1
    assert row[0]["HIV_Lab"] == "Positive"
    assert row[0]["Initial_Drug_R"].startswith("9")
    assert row[0]["Initial_Culture_Conversion_Date"] is not None


def heavy_mart(spark, folder, form: str):
    """200 plain enrolments; number 0 has very many rows of one form."""
    b = MartBuilder()
    for pid in range(200):
        b.enrolment(pid)
        b.baseline(pid, pid, diabetes_mellitus="True")
        b.outcome(pid, day(90))
    for n in range(HOT_ROWS):
        if form == "baseline":
            b.baseline(0, n, baseline_hiv_serostatus_result="Positive")
        elif form == "start":
            b.start(0, day(n % 50))
        elif form == "outcome":
            b.outcome(0, day(n % 90))
        else:
            b.identifier(0, f"EMR{n}")
    return b.mart(spark, folder)


def largest_share(frame) -> tuple[int, int]:
    """Rows of the fullest output partition, and of all; every column is kept."""
    sizes = frame.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    return max(sizes), sum(sizes)


@pytest.mark.parametrize("form", ["baseline", "start", "outcome", "identifier"])
def test_register_divides_a_heavy_form(spark, small_thresholds, tmp_path, form):
    most, total = largest_share(register(heavy_mart(spark, tmp_path, form), "generic", "2020-12-31"))
    assert total >= HOT_ROWS
    assert most < 0.45 * total


@pytest.mark.parametrize(
    "name, form",
    [("hiv_status", "baseline"), ("next_visit", "baseline"), ("treatment_duration", "start"),
     ("active_treatment", "outcome"), ("culture_flags", "start")],
)
def test_joins_outside_the_register_divide_too(spark, small_thresholds, tmp_path, name, form):
    most, total = largest_share(NAMED[name](heavy_mart(spark, tmp_path, form)))
    assert total >= HOT_ROWS
    assert most < 0.45 * total


def chunks_of(frame) -> Counter:
    return Counter(map(tuple, frame.collect()))


@pytest.mark.parametrize("form", ["program", "site", "registered", "initiation", "outcome"])
def test_chunks_follow_from_rows(spark, mart, form):
    """Whatever order a task meets the rows in, each copy of a row gets its chunk, and no row is lost."""
    tables = {**reg.required_forms(mart, GENERIC), **reg.optional_forms(mart)}
    table = tables[form].unionByName(tables[form].where(f"{PID} % 5 = 0")).unionByName(tables[form].where(f"{PID} = 3"))
    heavy = spark.createDataFrame([(n, form, 7) for n in range(0, 200, 3)], f"{PID} long, largest_form_ string, chunks_ int")
    names = table.columns
    seen = []
    for order in (table.coalesce(1).sortWithinPartitions(*names), table.repartition(6, F.rand(3)).sortWithinPartitions(F.rand(5))):
        # written, so that the order is the one rows are read in
        folder = tempfile.mkdtemp(prefix="rows-")
        order.write.mode("overwrite").parquet(folder)
        seen.append(chunks_of(dealt(form, spark.read.schema(table.schema).parquet(folder), heavy)))
    assert seen[0] == seen[1]
    assert sum(seen[0].values()) == table.where(f"{PID} % 3 = 0").count()
    copies = Counter(row[:-2] for row in seen[0].elements())
    assert copies == Counter(tuple(r) for r in table.where(f"{PID} % 3 = 0").select(*names).collect())


def test_copies_of_a_row_are_dealt_over_all_chunks(spark):
    table = spark.range(1000).select(F.lit(1).cast("long").alias(PID), F.lit("same").alias("x"))
    heavy = spark.createDataFrame([(1, "form", 10)], f"{PID} long, largest_form_ string, chunks_ int")
    found = dealt("form", table, heavy).groupBy("chunk_").count().collect()
    assert sorted(r["count"] for r in found) == [100] * 10


@pytest.mark.parametrize("clustered", [False, True])
def test_joins_in_chunks_change_no_row(spark, clustered):
    a = spark.createDataFrame([(k % 4, f"a{k % 3}") for k in range(60)] + [(None, "n")], f"{PID} long, a string")
    b = spark.createDataFrame([(k % 5, k % 2) for k in range(1, 40)], f"{PID} long, b int")
    c = spark.createDataFrame([(0, 1.5), (0, 1.5), (2, None), (9, 1.0)], f"{PID} long, c double")
    feature = spark.createDataFrame([(k, k * 10) for k in (0, 1, 3, 9)], f"{PID} long, f int")
    plain = a.join(b, PID).join(c, PID, "left").join(feature, PID, "left")
    for rows in (1, 7, 13, 1000):
        got = join_chunked({"a": a, "b": b}, {"c": c}, [feature], None, rows, clustered).select(*plain.columns)
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, plain.collect()))


@pytest.mark.parametrize("chunk_rows", [1, 3, 1000])
def test_patients_join_once_whatever_repeats(spark, chunk_rows):
    rows = spark.createDataFrame([(k % 7, k) for k in range(50)] + [(None, -1), (99, -2)], "patient_id long, n int")
    ids = [(k % 5, f"id{k % 11}") for k in range(60)] + [(1, "same")] * 9 + [(2, None)] * 2 + [(None, "x"), (50, "y")]
    attributes = spark.createDataFrame(ids, "patient_id long, identifier string")
    want = rows.join(attributes, "patient_id", "left").select("patient_id", "n", "identifier")
    got = reg.with_patient(rows, attributes, chunk_rows).select("patient_id", "n", "identifier")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_every_pair_of_a_long_enrolment_is_dealt(spark, small_thresholds, tmp_path):
    b = MartBuilder()
    b.enrolment(0)
    b.positive(0, -3, 700)
    b.negative(0, *range(5, 1500, 2))
    mart = b.mart(spark, tmp_path)
    pairs = NAMED["conversion_pairs_every"](mart)
    days = list(range(5, 1500, 2))
    assert pairs.count() == sum(1 for x in days for y in days if y - x > cultures.CONFIRM_AFTER_DAYS)
    most, total = largest_share(pairs)
    assert most < 0.6 * total


def test_final_order_parts_unknown_patients(spark, small_thresholds, tmp_path):
    b = MartBuilder()
    for pid in range(3000):
        b.enrolment(pid)
        if pid % 3:
            b.identifier(pid, f"EMR{pid}")
    wide = b.mart(spark, tmp_path)
    rows = register(wide, "generic", "2020-12-31", ordered=True)
    sizes = [n for n in rows.rdd.mapPartitions(lambda x: [sum(1 for _ in x)]).collect() if n]
    assert max(sizes) < 0.3 * sum(sizes)
    emr = [r["EMR_ID"] for r in rows.select("EMR_ID").collect()]
    known = [x for x in emr if x is not None]
    assert emr == known + [None] * (len(emr) - len(known)) and len(known) == 2000
