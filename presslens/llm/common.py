"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslens.session import shared_dir

# words of the contracts: runs of anything but ASCII white space
WORD = r"[^\x20\x09-\x0D]+"

BATCH_BYTES = 4 << 20  # of rows sent to a Python worker at once
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read back.

    Cuts the lineage with files that outlive any executor, so no later stage
    repeats the work above, and fixes values that depend on the partitioning.
    """
    path = shared_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in Arrow batches of about BATCH_BYTES, from now on in this session.

    By Spark's defaults a batch has up to 10,000 rows and 64 MB; of whole texts, each task then holds it several times, in
    Arrow buffers, as rows that wait for their results, and as Python strings. A lower limit of the session's own stays.
    """
    n, unit = re.match(r"(\d+)\s*([kmgtp]?)", spark.conf.get(_BATCH_LIMIT).lower()).groups()
    if int(n) << 10 * " kmgtp".index(unit or " ") > BATCH_BYTES:
        spark.conf.set(_BATCH_LIMIT, str(BATCH_BYTES))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def prefix_sums(df: DataFrame, order: list[Column | str], value: str | list[str], out: str | list[str], name: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` (or of each one of a list) over all rows before this one in ``order``.

    Range partitions hold consecutive rows; each sums on its own and adds the
    total of the partitions before it (a table of one row a partition). Ties in
    ``order`` take some order, the same in every later read of the result.
    """
    values, outs = ([value], [out]) if isinstance(value, str) else (value, out)
    n = partitions(df.sparkSession)
    t = written(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                .withColumn("_part", F.spark_partition_id())
                .withColumn("_row", F.monotonically_increasing_id()), name)
    totals = t.groupBy("_part").agg(*[F.sum(v).alias(f"_total{i}") for i, v in enumerate(values)])
    before = totals.select("_part", *[(F.sum(f"_total{i}").over(Window.orderBy("_part")) - F.col(f"_total{i}")).alias(f"_before{i}")
                                      for i in range(len(values))])
    here = Window.partitionBy("_part").orderBy("_row")
    t = t.withColumns({f"_run{i}": F.sum(v).over(here) - F.col(v) for i, v in enumerate(values)})
    return (t.join(F.broadcast(before), "_part")  # a row per range partition
            .withColumns({o: F.col(f"_run{i}") + F.col(f"_before{i}") for i, o in enumerate(outs)})
            .drop("_part", "_row", *[f"_{k}{i}" for k in ("run", "before") for i in range(len(values))]))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the long pairs in the first two columns.

    ``component`` is the smallest node reachable. Alternates large-star and
    small-star steps (each node's larger, then smaller, neighbours move to its
    smallest one) until the edges are stars; every step is two aggregations and
    two equi-joins over edges that never grow in number beyond the input's, and is written out.
    """
    a, b = edges.columns[:2]
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = written(e, "edges")
    mark = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.union(low).distinct(), "edges")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(e.select("v", "v").distinct())


def worker_state(name: str, make):
    """A value kept in this Python worker from task to task (bounded by its maker)."""
    store = sys.modules.setdefault("_presslens_llm_state", types.ModuleType("_presslens_llm_state"))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)
