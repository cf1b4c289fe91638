"""Streams whose state is Spark's own (STM-04, STM-06, STM-08, AGG-14, AGG-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens import specs
from presslens.catalog import ORACLE, register
from presslens.operators.store import KeyedStore
from presslens.plans.streaming_jobs import CUTOFF_NOW, STREAM_PARTS, _raw_articles, publish
from presslens.session import shared_dir
from presslens.sources.tables import table
from presslens.streaming.source import decode, file_stream
from presslens.streaming.state import finished, run_cutoff_files, run_live_sources


def _in_turn(spark: SparkSession, parts: list[str], root: str):
    """Moves the published parts into the stream's folder one after the other."""
    jvm = spark.sparkContext._jvm
    for k, part in enumerate(parts):
        src, dst = (jvm.org.apache.hadoop.fs.Path(p) for p in (part, f"{root}/in/{k}"))
        fs = src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(dst.getParent())
        fs.rename(src, dst)
        yield k


def stream_cutoffs_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of ``stream_cutoffs``, a run of the stream each; cutoffs in the checkpoint's state store."""
    root = shared_dir(spark, "stream-state")
    parts = publish(_raw_articles(spark, sf_dir), f"{root}/staged", STREAM_PARTS, "event_id")
    for _ in _in_turn(spark, parts, root):
        stream = decode(file_stream(spark, f"{root}/in/*"))
        run_cutoff_files(stream, f"{root}/out", f"{root}/checkpoint", F.lit(CUTOFF_NOW), {"availableNow": True}).awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    return out.select(F.regexp_extract("url", r"([0-9]+)$", 1).cast("bigint").alias("event_id"), "source")


register("stream_cutoffs_state", ORACLE["stream_cutoffs"])(stream_cutoffs_state)


def live_source_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and source means after all batches of the published events, from sums kept over the batches."""
    root = shared_dir(spark, "live-sources")
    e = table(spark, sf_dir, "events")
    rows = e.select("event_id", F.col("event_type").alias("source"), F.lit("").alias("url"), F.lit("").alias("title"),
                    F.col("ts").cast("timestamp").alias("date"), F.floor("value").cast("string").alias("text"))
    parts = publish(rows, f"{root}/staged", STREAM_PARTS, "event_id")
    store = KeyedStore(spark, f"{root}/store", "source", buckets=2)
    for _ in _in_turn(spark, parts, root):
        stream = decode(file_stream(spark, f"{root}/in/*")).withColumn("pct", F.col("text").try_cast("double"))
        run_live_sources(stream, store, f"{root}/checkpoint", {"availableNow": True}).awaitTermination()
    return finished(store.read())


register("live_source_means", f"""
WITH v AS (SELECT event_type AS source, coalesce(nullif(floor(value), 0), {specs.DASH_DEFAULT_SCORE}) AS pct FROM events),
s AS (SELECT source, CAST(floor(sum(pct) / count(*) + 0.5) AS BIGINT) AS mean_score, count(*) AS n FROM v GROUP BY source)
SELECT source, mean_score, n, (SELECT count(*) FROM v) AS total,
       CAST(ceil((SELECT count(*) FROM v) / {specs.FEED_PAGE_SIZE}.0) AS BIGINT) AS pages FROM s
""")(live_source_means)
