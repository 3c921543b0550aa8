"""Reading the tables and keeping intermediate results where every executor sees them."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}

#: Bytes of rows that go to a Python worker at once; a longer row goes alone.
BATCH_BYTES = 4 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


#: The folder that this package is imported from.
SOURCE = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, if they see that folder."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if SOURCE not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, SOURCE]))


def bounded(spark: SparkSession) -> None:
    """Batches for Python workers end at ``BATCH_BYTES``, unless the session has its own limit.

    Spark's is 10,000 rows or 64 MB, which each task holds in the executor's JVM and again in its worker.
    """
    if BATCH_LIMIT not in spark.conf.getAll:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))


def prepared(spark: SparkSession) -> None:
    """To be called before an operator is applied to tables that this module has not read.

    Workers belong to the environment of the function they run: one made before ``importable``
    has a daemon and workers of its own, which stay beside the others.
    """
    importable(spark)
    bounded(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepared(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset a folder of this machine, in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if "folder" not in _LOCAL:
        _LOCAL["folder"] = tempfile.mkdtemp(prefix="rollbook-")
    return f"file://{_LOCAL['folder']}"


def written(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """``df`` as a written table in the shared folder: lineage ends here, lost executors cost nothing.

    ``files`` merges the parts of a small result.
    """
    spark = df.sparkSession
    prepared(spark)
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    (df.coalesce(files) if files else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def swept(spark: SparkSession) -> None:
    """Shuffle files of queries that have ended go as the driver's JVM collects its garbage; Spark alone asks for it twice an hour."""
    spark.sparkContext._jvm.System.gc()
