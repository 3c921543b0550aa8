"""Linear forms against brute force on random marts, one enrolment holding a third of the rows."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import product

import pytest
from minimart import MartBuilder, day

from rollbook.operators import cultures, facility, medication, serology
from rollbook.operators.disease_site import disease_site
from rollbook.queries import NAMED

PID = "patient_program_id"
HOT = 0


def random_mart(seed: int):
    """Builder plus the plain facts that brute force works on."""
    rnd = random.Random(seed)
    b = MartBuilder()
    facts = defaultdict(lambda: defaultdict(list))
    for pid in range(40):
        size = 60 if pid == HOT else rnd.randint(0, 8)
        for _ in range(rnd.choice([0, 1, 1, 1, 2]) if pid != HOT else 4):
            start = rnd.choice([None, *range(0, 40)])
            b.start(pid, None if start is None else day(start))
            if start is not None:
                facts[pid]["starts"].append(start)
        for _ in range(size):
            kind = rnd.choice(["positive", "negative", "negative"])
            at = rnd.randint(-120, 160)
            getattr(b, kind)(pid, at)
            facts[pid][kind].append(at)
        for _ in range(size):
            drug, at = rnd.choice(["A", "B"]), rnd.randint(-20, 60)
            dose = rnd.choice([None, 5, 10])
            b.drug(pid, drug, day(at), dose, "mg")
            facts[pid]["orders"].append((drug, at, dose))
        for _ in range(size):
            at = rnd.choice([None, *range(5)])
            name = rnd.choice([None, "Other", "X", "Y"])
            other, returns = rnd.choice([None, "Z"]), rnd.choice([None, 7, 8])
            b.visit(
                pid, None if at is None else day(at), name, other, returns and day(returns)
            )
            facts[pid]["visits"].append((at, name, other, returns))
        for _ in range(size):
            at, result = rnd.choice([None, *range(5)]), rnd.choice([None, "P", "N"])
            b.lab(pid, None if at is None else day(at), hiv=result)
            facts[pid]["labs"].append((at, result))
        for _ in range(size % 5):
            site, form = rnd.choice([None, "Pulmonary", "Extrapulmonary"]), rnd.randint(1, 2)
            b.site(pid, site, form)
            facts[pid]["sites"].append((form, site))
    return b, facts


@pytest.fixture(scope="module", params=[1, 2, 3])
def case(request, spark, tmp_path_factory):
    b, facts = random_mart(request.param)
    return b.mart(spark, tmp_path_factory.mktemp(f"random{request.param}")), facts


@pytest.fixture(scope="module")
def marks(case):
    mart, _ = case
    return cultures.culture_marks(
        mart["treatment_initiation_template"],
        mart["bacteriology_culture_results_details"],
        mart["bacteriology_concept_set"],
    )


@pytest.fixture(scope="module")
def timeline(marks):
    return cultures.culture_timeline(cultures.culture_days(marks))


def nearest(fact, kind):
    pairs = [
        (abs(e - s), e, s)
        for e, s in product(fact[kind], fact["starts"])
        if -90 <= e - s <= 15
    ]
    return min(pairs, default=None)


def on_treatment(fact, kind):
    """Days with one entry per (culture, earlier start)."""
    return [e for e, s in product(fact[kind], fact["starts"]) if e >= s]


def offset(value):
    return None if value is None else (value - day(0)).days


def collect(frame, *columns):
    return {
        r[PID]: tuple(offset(r[c]) if hasattr(r[c], "year") else r[c] for c in columns)
        for r in frame.collect()
    }


def test_baseline_and_conversion(case, timeline):
    _, facts = case
    wanted = {}
    for pid, fact in facts.items():
        base = nearest(fact, "positive")
        if base is None:
            continue
        other = nearest(fact, "negative")
        negatives = sorted(set(on_treatment(fact, "negative")))
        positives = set(on_treatment(fact, "positive"))
        found = [
            (d1, d2)
            for d1, d2 in product(negatives, negatives)
            if d2 - d1 > 15 and d1 > base[1] and not any(d1 <= p <= d2 for p in positives)
        ]
        first, second = min(found, default=(None, None))
        reverted = "Y" if found and any(p > second for p in positives) else None
        closer = "Y" if other and other[1] > base[1] else None
        wanted[pid] = (base[2], base[1], other and other[1], closer, first, reverted)
    summary = cultures.culture_summary(timeline)
    assert wanted == collect(
        summary, cultures.START, "closest_positive", "closest_negative", "closer_negative",
        "initial_cc_date", "revert_after_cc",
    )


def test_closest_event(case, timeline):
    _, facts = case
    for result, kind in ((cultures.POSITIVE, "positive"), (cultures.NEGATIVE, "negative")):
        wanted = {p: nearest(f, kind) for p, f in facts.items() if nearest(f, kind)}
        found = cultures.closest_event(timeline, result)
        assert {p: (s, e, e - s) for p, (_, e, s) in wanted.items()} == collect(
            found, cultures.START, cultures.COLLECTED, "day_diff"
        )


def test_conversion_pairs(case, marks):
    _, facts = case
    counted = cultures.culture_timeline(cultures.culture_counts(marks))
    wanted = {}
    for pid, fact in facts.items():
        base = nearest(fact, "positive")
        negatives = Counter(on_treatment(fact, "negative"))
        positives = on_treatment(fact, "positive")
        for d1 in negatives:
            later = [d for d in negatives if d - d1 > 15]
            if not later:
                continue
            d2 = min(later)
            rows = negatives[d1] * negatives[d2]
            joined = rows * max(1, len(positives))
            wanted[pid, d1] = (
                d2,
                d2 - d1,
                joined if base else 0,
                rows * sum(d1 <= p <= d2 for p in positives),
                joined if base and base[1] < d1 else 0,
                rows * sum(p > d2 for p in positives),
            )
    found = {
        (r[PID], offset(r.collection_date1)): (
            offset(r.collection_date2),
            r.days_between,
            r.pos_baseline,
            r.pos_between,
            r.cc_after_pos,
            r.pos_after_cc,
        )
        for r in cultures.conversion_pairs(counted).collect()
    }
    assert found == wanted


def test_window_and_post_start_rows(case):
    mart, facts = case
    details, specimens = (
        mart["bacteriology_culture_results_details"],
        mart["bacteriology_concept_set"],
    )
    initiations = mart["treatment_initiation_template"]
    window = cultures.baseline_window(
        initiations, cultures.culture_events(details, specimens, cultures.NEGATIVE)
    )
    found = Counter(
        (r[PID], offset(r[cultures.START]), offset(r[cultures.COLLECTED]), r.day_diff)
        for r in window.collect()
    )
    assert found == Counter(
        (pid, s, e, e - s)
        for pid, f in facts.items()
        for e, s in product(f["negative"], f["starts"])
        if -90 <= e - s <= 15
    )
    post = cultures.post_start_cultures(initiations, details, specimens, cultures.POSITIVE)
    found = Counter((r[PID], offset(r.collection_date)) for r in post.collect())
    assert found == Counter(
        (pid, e) for pid, f in facts.items() for e in on_treatment(f, "positive")
    )


def test_regimen(case):
    mart, facts = case
    orders, initiations = mart["medication_data_default"], mart["treatment_initiation_template"]
    near = {
        (pid, drug, dose)
        for pid, f in facts.items()
        for drug, at, dose in f["orders"]
        if any(abs(at - s) <= 7 for s in f["starts"])
    }
    rows = medication.regimen_near_start(orders, initiations).collect()
    assert len(rows) == len(near)
    assert {(r[PID], r.drug, r.dose) for r in rows} == near
    cells = defaultdict(dict)
    for pid, drug, dose in near:
        text = f"{'' if dose is None else dose} mg"
        cells[pid][drug] = max(cells[pid].get(drug, text), text)
    pivot = medication.regimen_pivot(
        medication.orders_near_start(orders, initiations), {"A": "a", "B": "b"}
    )
    assert collect(pivot, "a", "b") == {
        p: (c.get("A"), c.get("B")) for p, c in cells.items()
    }


def last(value):
    return (value is None, value or "")


def test_facility_and_visits(case):
    mart, facts = case
    stays = facility.followup_stays(mart["followup_template"])
    newest, planned = {}, {}
    for pid, f in facts.items():
        named = [
            (at, name if name != "Other" else other)
            for at, name, other, _ in f["visits"]
            if name is not None
        ]
        if named:
            newest[pid] = min(named, key=lambda v: (v[0] is not None, -(v[0] or 0), last(v[1])))
        if f["visits"]:
            visit = min(
                f["visits"],
                key=lambda v: (v[0] is None, v[0] or 0, v[3] is None, v[3] or 0),
            )
            planned[pid] = (visit[3],)
    assert collect(facility.latest_facility(stays), "facility_date", "facility") == newest
    assert (
        collect(facility.followup_return_visit(mart["followup_template"]), "return_visit_date")
        == planned
    )
    fused = facility.care_history([stays], [facility.FOLLOWUP, facility.HOSPITAL])
    assert collect(fused, "seen_at", "return_on") == {
        pid: (newest.get(pid, (None, None))[1], *planned[pid]) for pid in planned
    }


def test_serology(case):
    mart, facts = case
    labs = mart["lab_results_serology_template"]
    for pick, sign in (("earliest", 1), ("latest", -1)):
        wanted = {}
        for pid, f in facts.items():
            known = [(at, r) for at, r in f["labs"] if r is not None]
            if known:
                missing_last = sign == 1
                wanted[pid] = (
                    min(
                        known,
                        key=lambda v: ((v[0] is None) == missing_last, sign * (v[0] or 0), v[1]),
                    )[1],
                )
        assert collect(serology.serology_result(labs, "hiv_result", pick), "hiv_result") == wanted


def test_disease_site(case):
    mart, facts = case
    names = {
        "Pulmonary": "Pulmonary",
        "Extrapulmonary": "Extrapulmonary",
        "Extrapulmonary,Pulmonary": "Both",
    }
    wanted = {}
    for pid, f in facts.items():
        for form in {form for form, _ in f["sites"]}:
            ticks = sorted(s for at, s in f["sites"] if at == form and s is not None)
            wanted[pid, form] = names.get(",".join(ticks))
    found = {
        (r[PID], r.id_baseline_template): r.disease_site
        for r in disease_site(mart["baseline_disease_site"]).collect()
    }
    assert found == wanted


@pytest.mark.parametrize("name", ["closest_positive", "closest_negative", "baseline_positive", "initial_conversion", "conversion_pairs"])
def test_rows_without_an_enrolment_are_no_enrolment(spark, tmp_path, name):
    """A start and cultures that both lack the enrolment do not belong together."""
    b = MartBuilder()
    for pid in (None, 1):
        b.start(pid)
        b.positive(pid, -5)
        b.negative(pid, -3, 10, 40)
    found = NAMED[name](b.mart(spark, tmp_path)).collect()
    assert found and {r["patient_program_id"] for r in found} == {1}
