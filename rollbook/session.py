"""Session settings for the register."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The register compiles more generated classes than the default cache holds, so
# with the default every executor compiles them again for every job.  The hash map
# threshold lets a join whose shuffled partitions all proved small skip the sort;
# larger ones keep the sort-merge join, which spills.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.codegen.cache.maxEntries": "1000",
    "spark.sql.session.timeZone": "UTC",
}


#: Shuffled bytes that a partition should hold at most when the number of partitions is set.
PARTITION_BYTES = 256 << 20
LEAST_PARTITIONS = 200


def start_partitions(input_bytes: int) -> int:
    """Shuffle partitions to start with for tables of this size.

    Adaptive execution merges small partitions but never makes more, so the start has
    to suit the largest exchange, which for a register is about the input: 100 TB give
    400,000.
    """
    return max(LEAST_PARTITIONS, -(-input_bytes // PARTITION_BYTES))


def configured(builder: SparkSession.Builder, input_bytes: int | None = None) -> SparkSession.Builder:
    """A builder with the settings that the register is meant to run under."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(start_partitions(input_bytes)))
    return builder


def local_session(name: str, cores: int, memory: str) -> SparkSession:
    """One JVM for tests and benchmarks."""
    return (
        configured(SparkSession.builder.appName(name).master(f"local[{cores}]"))
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
