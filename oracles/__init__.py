"""DuckDB statements that the Spark queries are checked against.

Written straight from the definition of each operator - row numbers, ordered
lists, pairwise comparisons - and not from the way Spark computes it.  ``VIEWS``
are named steps; a statement is its last step plus whatever steps and bound
tables it mentions.
"""

from __future__ import annotations

import re

from oracles.register import REGISTERS
from oracles.steps import STEPS
from rollbook.sources.bindings import BINDINGS

VIEWS: dict[str, str] = {**STEPS, **REGISTERS}

# Query name to the step that answers it, where the names differ.
ANSWERS: dict[str, str] = {
    "disease_site_recode": "site_of_form",
    "latest_facility_treatment_start": "stay_initiation",
    "latest_facility_hospital": "stay_hospital",
    "latest_facility_hospital_named": "stay_hospital_named",
    "latest_facility_followup": "stay_followup",
    "facility_history": "history",
    "facility_history_no_hospital": "history_no_hospital",
    "enrollment_facility": "registered_at",
    "last_facility": "last_seen",
    "last_facility_pk": "last_seen_pk",
    "last_facility_png": "last_seen_png",
    "first_start_dlm": "first_dlm",
    "first_start_bdq": "first_bdq",
    "regimen_near_start": "near_start",
    "regimen_pivot": "regimen",
    "serology_hiv": "lab_hiv",
    "serology_hep_b": "lab_hep_b",
    "serology_hep_c": "lab_hep_c",
    "followup_return_visit": "planned_return",
    "culture_events": "specimen_results",
    "baseline_window_positive": "window_positive",
    "baseline_window_negative": "window_negative",
    "closest_positive": "nearest_positive",
    "closest_negative": "nearest_negative",
    "baseline_positive": "baseline_pair",
    "post_start_negative": "negatives_on_treatment",
    "post_start_positive": "positives_on_treatment",
    "conversion_pairs": "confirming_pairs",
    "initial_conversion": "conversion",
    "register_grain": "register_grain",
    "register_grain_forecast": "register_grain",
}


def _mentioned(sql: str) -> set[str]:
    return set(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", sql))


def _needed(name: str, found: dict[str, str]) -> None:
    if name in found or not (name in VIEWS or name in BINDINGS):
        return
    sql = VIEWS[name] if name in VIEWS else BINDINGS[name].replace("{", "").replace("}", "")
    for other in sorted(_mentioned(sql)):
        _needed(other, found)
    found[name] = sql


def statement(view: str) -> str:
    """One self-contained statement for a step."""
    found: dict[str, str] = {}
    _needed(view, found)
    body = found.pop(view)
    steps = ",\n".join(f"{name} AS ({sql})" for name, sql in found.items())
    return f"WITH {steps}\n{body}"


def statements() -> dict[str, str]:
    answered = set(ANSWERS.values())
    public = {name: name for name in VIEWS if name not in answered and not name.startswith("_")}
    return {query: statement(view) for query, view in {**ANSWERS, **public}.items()}
