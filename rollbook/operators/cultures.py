"""Baseline culture and culture conversion.

The row-level operators (events, baseline window, post-start dates) are joins.
The per-enrolment results do not use them: specimens and treatment starts are
stacked and collapsed to one row per (enrolment, day) with counters, after which
every question is a running value over the days of an enrolment.  The collapse
combines on the map side, so an enrolment with very many culture rows reaches
the windows with no more rows than it has calendar days, and nothing compares
cultures pairwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions.ranges import join_since, join_within
from rollbook.sources.schemas import PID

# Culture results of the mart.
POSITIVE = "Positive for M. tuberculosis"
NEGATIVE = "Negative for M. tuberculosis"

BASELINE_LO, BASELINE_HI = -90, 15
CONFIRM_AFTER_DAYS = 15

START = "tuberculosis_drug_treatment_start_date"
RESULT = "bacteriology_culture_results"
COLLECTED = "specimen_collection_date"
SPECIMEN = "id_bacteriology_concept_set"


def culture_events(results: DataFrame, specimens: DataFrame, *wanted: str) -> DataFrame:
    """(enrolment, specimen date, result) of the wanted results; the date may be null."""
    return (
        results.where(F.col(RESULT).isin(*wanted))
        .join(specimens, SPECIMEN, "left")
        .select(PID, COLLECTED, RESULT)
    )


def baseline_window(
    initiations: DataFrame, events: DataFrame, lo: int = BASELINE_LO, hi: int = BASELINE_HI
) -> DataFrame:
    """Events whose distance from treatment start lies in ``[lo, hi]`` days."""
    return join_within(
        events, initiations.select(PID, START), PID, COLLECTED, START, lo, hi
    ).select(
        PID, START, COLLECTED, RESULT, F.date_diff(COLLECTED, START).alias("day_diff")
    )


def post_start_cultures(
    initiations: DataFrame, results: DataFrame, specimens: DataFrame, wanted: str
) -> DataFrame:
    """(enrolment, date) of wanted cultures on or after treatment start, once for each such start."""
    events = culture_events(results, specimens, wanted).select(PID, COLLECTED)
    return join_since(events, initiations.select(PID, START), PID, COLLECTED, START).select(
        PID, F.col(COLLECTED).cast("date").alias("collection_date")
    )


def _by_day() -> Window:
    return Window.partitionBy(PID).orderBy("day")


def _so_far() -> Window:
    return _by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _all_days() -> Window:
    return _by_day().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


# Marks of a day, one bit each.
STARTED, WAS_POSITIVE, WAS_NEGATIVE = 1, 2, 4
KINDS = {"start": STARTED, "positive": WAS_POSITIVE, "negative": WAS_NEGATIVE}


def culture_marks(
    initiations: DataFrame, results: DataFrame, specimens: DataFrame
) -> DataFrame:
    """(enrolment, day, mark): treatment starts stacked with dated culture results.

    Results become marks before they meet their specimen, so no text is moved.  Rows
    without an enrolment belong to none and are left out.
    """
    result = F.col(RESULT)
    marked = results.where(result.isin(POSITIVE, NEGATIVE) & F.col(PID).isNotNull()).select(
        PID,
        SPECIMEN,
        F.when(result == POSITIVE, WAS_POSITIVE).otherwise(WAS_NEGATIVE).alias("mark"),
    )
    dated = specimens.where(F.col(COLLECTED).isNotNull())
    cultures = marked.join(dated, SPECIMEN).select(
        PID, F.col(COLLECTED).cast("date").alias("day"), "mark"
    )
    starts = initiations.where(F.col(START).isNotNull() & F.col(PID).isNotNull()).select(
        PID, F.col(START).cast("date").alias("day"), F.lit(STARTED).alias("mark")
    )
    return cultures.unionByName(starts)


def culture_days(marks: DataFrame) -> DataFrame:
    """One row per (enrolment, day), with 0/1 columns ``start``, ``positive``, ``negative``.

    The marks of a day are one integer up to here, and the rows are clustered by
    enrolment while they are that narrow.
    """
    days = marks.groupBy(PID, "day").agg(F.bit_or("mark").alias("marks")).repartition(PID)
    return days.select(
        PID,
        "day",
        *[
            (F.col("marks").bitwiseAND(bit) != 0).cast("int").alias(kind)
            for kind, bit in KINDS.items()
        ],
    )


def culture_counts(marks: DataFrame) -> DataFrame:
    """As ``culture_days``, with the number of starts and of cultures on the day."""
    return marks.groupBy(PID, "day").agg(
        *[F.count_if(F.col("mark") == bit).alias(kind) for kind, bit in KINDS.items()]
    )


def _nearest(kind: str, lo: int, hi: int) -> Column:
    """Best (distance, event, start) that a day can offer for one kind of culture.

    The nearest pair overall is either an event with the last start before it, or
    a start with the last event before it, so looking back from every day finds it.
    """
    day = F.col("day")

    def pair(test, event, start):
        distance = F.abs(F.date_diff(event, start))
        return F.when(
            test & F.date_diff(event, start).between(lo, hi),
            F.struct(distance.alias("distance"), event.alias("event"), start.alias("start")),
        )

    return F.least(
        pair(F.col(kind) > 0, day, F.col("last_start")),
        pair(F.col("start") > 0, F.col(f"last_{kind}"), day),
    )


def culture_timeline(days: DataFrame, lo: int = BASELINE_LO, hi: int = BASELINE_HI) -> DataFrame:
    """Days with the enrolment's baseline pair of cultures and post-start counters.

    ``starts`` counts the treatment starts up to the day (zero: not yet treated);
    ``base`` and ``base_neg`` are the nearest positive and negative cultures of
    the baseline window.  Every window shares one exchange and one sort.
    """
    if not lo <= 0 <= hi:
        raise ValueError("the baseline window must contain the day of treatment start")
    so_far, all_days = _so_far(), _all_days()
    seen = days.select(
        "*",
        F.sum("start").over(so_far).alias("starts"),
        *[
            F.max(F.when(F.col(kind) > 0, F.col("day"))).over(so_far).alias(f"last_{kind}")
            for kind in ("start", "positive", "negative")
        ],
    )
    return seen.select(
        PID,
        "day",
        "starts",
        "positive",
        "negative",
        F.min(_nearest("positive", lo, hi)).over(all_days).alias("base"),
        F.min(_nearest("negative", lo, hi)).over(all_days).alias("base_neg"),
    )


def closest_event(timeline: DataFrame, wanted: str) -> DataFrame:
    """The wanted culture nearest to treatment start; the earlier specimen on a tie."""
    pair = F.col({POSITIVE: "base", NEGATIVE: "base_neg"}[wanted])
    return (
        timeline.where(pair.isNotNull())
        .select(
            PID,
            pair["start"].alias(START),
            pair["event"].alias(COLLECTED),
            F.lit(wanted).alias(RESULT),
            F.date_diff(pair["event"], pair["start"]).alias("day_diff"),
        )
        .distinct()
    )


def culture_summary(
    timeline: DataFrame, confirm_after: int = CONFIRM_AFTER_DAYS
) -> DataFrame:
    """Baseline and conversion of every enrolment with a positive baseline culture.

    Days on treatment are cut into stretches at each day with a positive culture.
    Negative days of one stretch have no positive between them, so conversion is
    the first negative day after the baseline positive whose stretch still has a
    negative more than ``confirm_after`` days later; it reverts when any positive
    follows.
    """
    day = F.col("day")
    treated = F.col("starts") > 0
    positive = treated & (F.col("positive") > 0)
    clean = treated & (F.col("negative") > 0) & (F.col("positive") == 0)
    enrolment = [PID, START, "closest_positive", "closest_negative"]
    stretches = (
        timeline.where(F.col("base").isNotNull())
        .select(
            PID,
            F.col("base.start").alias(START),
            F.col("base.event").alias("closest_positive"),
            F.col("base_neg.event").alias("closest_negative"),
            F.sum(positive.cast("int")).over(_so_far()).alias("stretch"),
            F.when(clean, day).alias("clean_day"),
            F.when(positive, day).alias("positive_day"),
        )
        .groupBy(*enrolment, "stretch")
        .agg(
            F.min(
                F.when(F.col("clean_day") > F.col("closest_positive"), F.col("clean_day"))
            ).alias("first_clean"),
            F.max("clean_day").alias("last_clean"),
            F.max("positive_day").alias("last_positive"),
        )
    )
    confirmed = F.date_diff("last_clean", "first_clean") > confirm_after
    return (
        stretches.groupBy(*enrolment)
        .agg(
            F.min(F.when(confirmed, F.col("first_clean"))).alias("initial_cc_date"),
            F.max("last_positive").alias("last_positive"),
        )
        .select(
            *enrolment,
            F.when(F.col("closest_negative") > F.col("closest_positive"), "Y").alias(
                "closer_negative"
            ),
            "initial_cc_date",
            F.when(F.col("last_positive") > F.col("initial_cc_date"), "Y").alias(
                "revert_after_cc"
            ),
        )
    )


def baseline_positive(summary: DataFrame) -> DataFrame:
    """Closest positive and negative baseline culture of each enrolment."""
    return summary.select(
        PID, START, "closest_positive", "closest_negative", "closer_negative"
    )


def initial_conversion(summary: DataFrame) -> DataFrame:
    """Date of culture conversion and whether a positive followed."""
    return summary.where(F.col("initial_cc_date").isNotNull()).select(
        PID, "initial_cc_date", "revert_after_cc"
    )


#: First days of pairs that one task takes of an enrolment; it tunes the spread and never changes rows.
PAIR_DAYS = 366


def conversion_pairs(
    timeline: DataFrame, confirm_after: int = CONFIRM_AFTER_DAYS, every: bool = False
) -> DataFrame:
    """Each negative day on treatment with the first negative that can confirm it.

    The confirming day is the nearest negative more than ``confirm_after`` days
    later; if a positive lies between these two it lies in every longer pair too,
    so one row per first day decides conversion.  ``every`` lists the longer pairs as well.
    The counters carry the multiplicity of a join of both days with the enrolment's
    positive cultures and its baseline positive (one unit per joined row), taken from
    running sums at the two ends: no pair meets a positive.
    """
    so_far, all_days = _so_far(), _all_days()
    positives = F.col("positive") * F.col("starts")
    counted = timeline.select(
        PID,
        "day",
        F.col("base.event").alias("closest_positive"),
        (F.col("negative") * F.col("starts")).alias("negatives"),
        positives.alias("positives"),
        F.sum(positives).over(so_far).alias("positives_so_far"),
        F.sum(positives).over(all_days).alias("positives_total"),
    )
    paired = _every_later(counted, confirm_after) if every else _first_later(counted, confirm_after)
    pairs = paired.withColumn("rows", F.col("negatives") * F.col("to.negatives"))
    joined = F.col("rows") * F.greatest(F.lit(1), F.col("positives_total"))
    baseline, nothing = F.col("closest_positive"), F.lit(0)
    between = F.col("to.positives_so_far") - F.col("positives_so_far") + F.col("positives")
    after = F.col("positives_total") - F.col("to.positives_so_far")
    return pairs.select(
        PID,
        F.col("day").alias("collection_date1"),
        F.col("to.day").alias("collection_date2"),
        F.date_diff("to.day", "day").alias("days_between"),
        F.when(baseline.isNotNull(), joined).otherwise(nothing).alias("pos_baseline"),
        (F.col("rows") * between).alias("pos_between"),
        F.when(baseline < F.col("day"), joined).otherwise(nothing).alias("cc_after_pos"),
        (F.col("rows") * after).alias("pos_after_cc"),
    )


def _later_end() -> Column:
    """What a pair needs of its later day."""
    return F.struct("day", "negatives", "positives_so_far")


def _first_later(counted: DataFrame, confirm_after: int) -> DataFrame:
    # Latest day first, so the frame "at least this many days later" only grows.
    later = (
        Window.partitionBy(PID)
        .orderBy(-F.unix_date("day"))
        .rangeBetween(Window.unboundedPreceding, -(confirm_after + 1))
    )
    confirming = F.min(F.when(F.col("negatives") > 0, _later_end())).over(later)
    return counted.withColumn("to", confirming).where((F.col("negatives") > 0) & F.col("to").isNotNull())


def _every_later(counted: DataFrame, confirm_after: int) -> DataFrame:
    """Negative days with each negative day far enough behind them.

    The pairs of an enrolment are dealt by calendar stretches of the first day: a later
    day is repeated for each stretch from the enrolment's first negative day to itself,
    so a task has the pairs of one stretch, however long the enrolment is.
    """
    stretch = F.floor(F.unix_date("day") / PAIR_DAYS).cast("int")
    negatives = counted.where("negatives > 0").withColumn("stretch", stretch)
    earliest = F.min("stretch").over(Window.partitionBy(PID))
    ends = negatives.withColumn("since", earliest).select(
        F.col(PID).alias("later_key"),
        F.explode(F.sequence("since", "stretch")).alias("later_stretch"),
        _later_end().alias("to"),
    )
    apart = F.date_diff("to.day", "day") > confirm_after
    same = (F.col(PID) == F.col("later_key")) & (F.col("stretch") == F.col("later_stretch"))
    return negatives.join(ends, same & apart).drop("stretch", "later_key", "later_stretch")
