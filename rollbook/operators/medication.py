"""Drug start dates and the regimen at treatment start."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.functions.packing import Part, named, pack, place, row, unpack
from rollbook.functions.ranges import join_placed, place_events
from rollbook.functions.text import dose_text, number_text
from rollbook.sources.schemas import PID

# Drug names of the mart and their short column names.
DRUGS: dict[str, str] = {
    "Isoniazid (H)": "H",
    "Rifampicin (R)": "R",
    "Ethambutol (E)": "E",
    "Pyrazinamide (Z)": "Z",
    "Streptomycin (S)": "S",
    "Amikacin (Am)": "Am",
    "Kanamycin (Km)": "Km",
    "Capreomycin (Cm)": "Cm",
    "Levofloxacin (Lfx)": "Lfx",
    "Moxifloxacin (Mfx)": "Mfx",
    "Prothionamide (Pto)": "Pto",
    "Ethionamide (Eto)": "Eto",
    "Cycloserine (Cs)": "Cs",
    "Terizidone (Trd)": "Trd",
    "Para-aminosalicylic acid (PAS)": "PAS",
    "Para-aminosalicylic acid - sodium (PAS-Na)": "PAS-Na",
    "Bedaquiline (Bdq)": "Bdq",
    "Delamanid (Dlm)": "Dlm",
    "Linezolid (Lzd)": "Lzd",
    "Clofazimine (Cfz)": "Cfz",
    "Imipenem/Cilastatin (Imp/Cln)": "Imp/Cln",
    "Amoxicillin/Clavulanate (Amx/Clv)": "Amx/Clv",
    "Meropenem (Mpm)": "Mpm",
    "Pretomanid (Pa)": "Pa",
    "Rifapentine (Rpt or P)": "Rpt or P",
}
DELAMANID, BEDAQUILINE = "Delamanid (Dlm)", "Bedaquiline (Bdq)"
NEW_DRUGS = {DELAMANID: "dlm_start_date", BEDAQUILINE: "bdq_start_date"}

NEAR_START_DAYS = 7


def first_drug_starts(orders: DataFrame, drugs: Mapping[str, str] = NEW_DRUGS) -> DataFrame:
    """Earliest start per enrolment, one column per named drug, in one pass.

    Only dates are aggregated, which keeps this a hash aggregate.
    """
    drug = F.col("coded_drug_name")
    return (
        orders.where(drug.isin(*drugs))
        .groupBy(PID)
        .agg(*[F.min(F.when(drug == d, F.col("start_date"))).alias(c) for d, c in drugs.items()])
    )


def first_drug_start(orders: DataFrame, drug: str) -> DataFrame:
    """(enrolment, earliest start of one drug)."""
    return first_drug_starts(orders, {drug: "start_date"})


#: What an order's number holds on its way to the treatment starts.
ORDER: dict[str, Part] = {"drug": (1, 6), "dose": (0, 16)}


def _narrow(orders: DataFrame) -> DataFrame:
    """Orders with drug and dose as one number; a row that does not fit keeps its columns."""
    return pack(orders, {"drug": place(F.col("drug"), list(DRUGS)), "dose": F.col("dose")}, ORDER)


def _drug_and_dose(kind: T.DataType) -> Column:
    read = unpack(ORDER)
    return row(ORDER, {"drug": named(read["drug"], list(DRUGS)), "dose": read["dose"].cast(kind)})


def orders_near_start(
    orders: DataFrame, initiations: DataFrame, days: int = NEAR_START_DAYS
) -> DataFrame:
    """Drug orders that start within ``days`` of treatment start, both ends included.

    A semi join on the distinct starts: repeated initiation forms neither repeat
    an order nor lengthen the search for its match.
    """
    dated = orders.where(F.col("coded_drug_name").isNotNull()).select(
        PID,
        F.col("coded_drug_name").alias("drug"),
        "dose",
        F.col("dose_units").alias("dose_unit"),
        "start_date",
    )
    starts = initiations.select(
        PID, F.col("tuberculosis_drug_treatment_start_date").alias("treatment_start")
    ).distinct()
    placed, kind = place_events(dated, "start_date", -days, days), dated.schema["dose"].dataType
    whole = isinstance(kind, T.IntegralType)
    near = join_placed(
        _narrow(placed) if whole else placed,
        *(F.col("start_date"), starts, PID, "treatment_start", -days, days, "left_semi"),
    )
    if whole:
        near = near.withColumn("order", _drug_and_dose(kind))
    return near.select(PID, *(("order.drug", "order.dose") if whole else ORDER), "dose_unit")


def regimen_near_start(
    orders: DataFrame, initiations: DataFrame, days: int = NEAR_START_DAYS
) -> DataFrame:
    """Distinct (enrolment, drug, dose, unit) started near treatment start."""
    return orders_near_start(orders, initiations, days).distinct()


def regimen_pivot(near: DataFrame, drugs: Mapping[str, str] = DRUGS) -> DataFrame:
    """One column per drug holding ``dose unit``; the greatest text when several.

    Repeats do not change a maximum, so the orders near start need no distinct.
    """
    text = dose_text(number_text(near, "dose"), F.col("dose_unit"))
    cells = near.groupBy(PID).pivot("drug", list(drugs)).agg(F.max(text))
    return cells.toDF(PID, *drugs.values())
