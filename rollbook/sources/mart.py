"""Access to the input tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from rollbook.sources.schemas import PID, TABLES

#: Forms that repeat and so decide whether a mart counts as clustered by enrolment.
FORMS = (
    "treatment_initiation_template",
    "program_attributes",
    "baseline_template",
    "outcome_end_of_treatment_template",
)


class Mart:
    """The input tables by name, each loaded on first use and kept as a plan.

    A register touches only the tables its variant needs, so a site may leave
    the others out.  ``clustered`` says that the forms are stored clustered by enrolment,
    so that ordinary enrolments are joined where they lie.
    """

    def __init__(self, load: Callable[[str], DataFrame], clustered: bool = False):
        self._load = load
        self._tables: dict[str, DataFrame] = {}
        self.clustered = clustered

    def __getitem__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(f"unknown table {name!r}")
        if name not in self._tables:
            self._tables[name] = self._load(name)
        return self._tables[name]

    @classmethod
    def from_frames(cls, frames: Mapping[str, DataFrame]) -> Mart:
        return cls(frames.__getitem__)

    @classmethod
    def from_parquet(
        cls, spark: SparkSession, root: str, schemas: Mapping[str, str] | None = None
    ) -> Mart:
        """One parquet table per name under ``root``, read with the declared schema.

        ``schemas`` replaces single declarations, for instance a decimal dose.
        """
        declared = {**TABLES, **(schemas or {})}
        return cls(lambda name: spark.read.schema(declared[name]).parquet(f"{root}/{name}"))

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> Mart:
        """Catalog tables; where the forms are bucketed by enrolment, ordinary enrolments need no exchange."""
        forms = [f"{database}.{name}" for name in FORMS]
        clustered = all(
            spark.catalog.tableExists(form)
            and any(c.name == PID and c.isBucket for c in spark.catalog.listColumns(form))
            for form in forms
        )
        return cls(lambda name: spark.table(f"{database}.{name}"), clustered)

    @classmethod
    def from_jdbc(
        cls,
        spark: SparkSession,
        url: str,
        upper_bounds: Mapping[str, int],
        num_partitions: int,
        properties: Mapping[str, str] | None = None,
    ) -> Mart:
        """Tables of a relational mart, read in parallel ranges of their first key.

        ``upper_bounds`` has the greatest key of each table, by the table's name or by
        its key's (enrolments, patients, specimens and persons are numbered apart).
        """

        def load(name: str) -> DataFrame:
            key = TABLES[name].split()[0]
            if name not in upper_bounds and key not in upper_bounds:
                raise KeyError(f"no upper bound for {name!r} or its key {key!r}")
            return spark.read.jdbc(
                url,
                name,
                column=key,
                lowerBound=0,
                upperBound=upper_bounds.get(name, upper_bounds.get(key)),
                numPartitions=num_partitions,
                properties=dict(properties or {}),
            )

        return cls(load)
