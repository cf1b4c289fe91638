"""Benchmark: run every registered query on $BENCH_SF_DIR (default sf0.1) on
local[$BENCH_CPUS] and print ONE JSON line with per-query wall seconds.

Each query is executed $BENCH_REPEATS times (default 3; the median counts), fully, with the ``noop`` sink (all rows produced, none
collected to the driver). The session (JVM and Python workers) is warmed up on
the smallest table first; that warm-up is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from presslens import catalog  # noqa: E402
from presslens.session import get_spark  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    # spark.checkpoint.dir is taken from the session's configuration; only a
    # local session without one gets a fresh folder (presslens.session)
    spark = get_spark(f"local[{cpus}]", app="presslens-bench", shuffle_partitions=cpus,
                      extra={"spark.driver.memory": "16g",
                             "spark.sql.files.maxPartitionBytes": str(32 * 1024 * 1024)})
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    qs = catalog.queries()
    names = only or sorted(qs)
    # warm-up (not timed): JVM code paths and the Python workers used by mapInPandas
    region = spark.read.parquet(os.path.join(sf_dir, "region.parquet"))
    region.write.format("noop").mode("overwrite").save()
    region.mapInPandas(lambda it: it, region.schema).write.format("noop").mode("overwrite").save()
    nation = spark.read.parquet(os.path.join(sf_dir, "nation.parquet"))
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    (nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
     .groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"))
     .withColumn("r", F.row_number().over(Window.orderBy("n")))
     .write.format("noop").mode("overwrite").save())
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        runs = []
        try:
            for _ in range(repeats):
                t0 = time.perf_counter()
                qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
            times[name] = round(median(runs), 3)
        except Exception as e:  # keep going; report the failure
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
           "cpus": cpus, "runs_each": repeats, "n_queries": len(times)}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
