"""Times the headline queries and prints one JSON line.

Every query runs once to warm up and then ``BENCH_REPEATS`` times; the median
counts, planning included.  ``*_mart`` reads the mart as written tables, the way a
site would hold it; the other queries derive the mart from the supplied tables
within the query.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from rollbook import queries as named
from rollbook.plans.register import register
from rollbook.session import local_session
from rollbook.sources.bindings import supplied_mart
from rollbook.sources.mart import Mart
from rollbook.sources.schemas import TABLES

HEADLINE = (
    "register_generic",
    "register_pk",
    "register_png",
    "last_facility",
    "regimen_pivot",
    "serology_hiv",
    "baseline_positive",
    "initial_conversion",
    "conversion_pairs",
)
WRITTEN = ("register_generic", "register_pk", "register_png")


def seconds(build, repeats: int) -> float:
    """Median wall time of planning and running a query to the end, warm."""
    times = []
    for _ in range(repeats + 1):
        begin = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - begin)
    return round(statistics.median(times[1:]), 3)


def written_mart(spark, sf_dir: str) -> Mart:
    # on a cluster, a folder that all executors share
    root = os.environ.get("BENCH_MART_DIR") or tempfile.mkdtemp(prefix="bench-mart-")
    mart = supplied_mart(spark, sf_dir)
    for name in TABLES:
        mart[name].write.mode("overwrite").parquet(f"{root}/{name}")
    return Mart.from_parquet(spark, root)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session("rollbook-bench", cores=cpus, memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    times = {
        name: seconds(lambda name=name: named.run(name, spark, sf_dir), repeats)
        for name in HEADLINE
    }
    mart = written_mart(spark, sf_dir)
    for name in WRITTEN:
        variant = name.removeprefix("register_")
        times[f"{name}_mart"] = seconds(
            lambda variant=variant: register(mart, variant, named.AS_OF), repeats
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_median_wall_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
