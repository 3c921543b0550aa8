"""Disease site of a baseline form from its ticked options."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.sources.schemas import PID

LUNG, OTHER_SITE = "Pulmonary", "Extrapulmonary"
TICKED_TOGETHER = f"{OTHER_SITE},{LUNG}"


def disease_site(sites: DataFrame) -> DataFrame:
    """``Pulmonary``, ``Extrapulmonary`` or ``Both`` per (enrolment, form).

    A form counts only when its ticks are exactly one of each named option (a
    repeated tick is not a known answer and gives null).  Counters decide that,
    so the ticks of a form are never gathered in one place.
    """
    site = F.col("baseline_disease_site")
    counted = sites.groupBy(PID, "id_baseline_template").agg(
        F.count(site).alias("ticks"),
        F.count_if(site == LUNG).alias("lung"),
        F.count_if(site == OTHER_SITE).alias("other"),
        F.count_if(site == TICKED_TOGETHER).alias("together"),
    )
    ticks, lung, other = F.col("ticks"), F.col("lung"), F.col("other")
    one, two = ticks == 1, ticks == 2
    return counted.select(
        PID,
        "id_baseline_template",
        F.when(one & (lung == 1), LUNG)
        .when(one & (other == 1), OTHER_SITE)
        .when((two & (lung == 1) & (other == 1)) | (one & (F.col("together") == 1)), "Both")
        .alias("disease_site"),
    )
