"""Streaming bindings: events published as raw-article JSON lines, consumed
with the file stream source (Kafka stand-in), ``availableNow`` trigger."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.catalog import register
from presslens.operators.score import LexiconScorer
from presslens.operators.store import KeyedStore
from presslens.plans import sql as S
from presslens.session import shared_dir
from presslens.sources.tables import table
from presslens.streaming.jobs import run_cutoff_stream, run_scored_stream
from presslens.streaming.source import decode, encode, file_stream

LEFT_S = ["click", "view"]
RIGHT_S = ["purchase", "signup"]
STREAM_PARTS = 4
CUTOFF_NOW = dt.datetime(2024, 1, 1, 0, 0, 0)


def _raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id"),
        F.col("event_type").alias("source"),
        F.concat(F.lit("event/"), F.col("event_id").cast("string")).alias("url"),
        F.concat_ws(" ", "event_type", F.col("user_id").cast("string")).alias("title"),
        F.col("ts").cast("timestamp").alias("date"),
        F.concat_ws(" ", "event_type", "props").alias("text"))


def publish(df: DataFrame, path: str, parts: int = 1, order_col: str | None = None) -> list[str]:
    """SNK-01 (file form): JSON-lines payloads, in one partitioned write.

    With ``parts`` > 1 rows are dealt by ``order_col`` modulo; returns the parts' directories."""
    if parts == 1:
        encode(df).write.text(path)
        return [path]
    dealt = df.withColumn("part", F.pmod(F.col(order_col), F.lit(parts))).drop(order_col)
    encode(dealt, "part").write.partitionBy("part").text(path)
    return [f"{path}/part={k}" for k in range(parts)]


def stream_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "stream-scored")
    publish(_raw_articles(spark, sf_dir).drop("event_id"), f"{root}/in")
    store = KeyedStore(spark, f"{root}/store")
    q = run_scored_stream(decode(file_stream(spark, f"{root}/in")), LexiconScorer(LEFT_S, RIGHT_S), store,
                          f"{root}/checkpoint", trigger={"availableNow": True}, backoff=0)
    q.awaitTermination()
    return store.read().select("_id", "source", F.round("ai_labels.bias", 6).alias("bias"),
                               F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"))


def stream_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run of the stream per published part, all with one checkpoint: a scheduled job."""
    root = shared_dir(spark, "stream-cutoffs")
    parts = publish(_raw_articles(spark, sf_dir), f"{root}/staged", STREAM_PARTS, "event_id")
    state, sink = KeyedStore(spark, f"{root}/state", "source", buckets=2), KeyedStore(spark, f"{root}/sink", buckets=8)
    jvm = spark.sparkContext._jvm
    for k, part in enumerate(parts):
        src, dst = (jvm.org.apache.hadoop.fs.Path(p) for p in (part, f"{root}/in/{k}"))
        fs = src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(dst.getParent())
        fs.rename(src, dst)
        q = run_cutoff_stream(decode(file_stream(spark, f"{root}/in/*")), state, sink, f"{root}/checkpoint",
                              lambda: CUTOFF_NOW, trigger={"availableNow": True})
        q.awaitTermination()
    return sink.read().select(F.regexp_extract("url", r"([0-9]+)$", 1).cast("bigint").alias("event_id"), "source")


_IN_L = ", ".join(S.q(x) for x in LEFT_S)
_IN_R = ", ".join(S.q(x) for x in RIGHT_S)

register("stream_scored", f"""
WITH a AS (SELECT md5('event/' || CAST(event_id AS VARCHAR)) AS _id, event_type AS source,
                  'ΤΙΤΛΟΣ: ' || event_type || ' ' || CAST(user_id AS VARCHAR) || chr(10) || 'ΚΕΙΜΕΝΟ: ' || event_type || ' ' || props AS prompt,
                  ts FROM events),
t AS (SELECT *, regexp_extract_all(lower(prompt), '[a-z]+') AS toks FROM a),
c AS (SELECT *, len(list_filter(toks, lambda x: x IN ({_IN_L}))) AS nl, len(list_filter(toks, lambda x: x IN ({_IN_R}))) AS nr FROM t)
SELECT _id, source, round((1.0 + nr) / (2.0 + nl + nr), 6) AS bias, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date FROM c
""")(stream_scored)

_FLOOR = f"(TIMESTAMP '{CUTOFF_NOW:%Y-%m-%d %H:%M:%S}' - INTERVAL 2 HOURS)"
_steps = [f"""f AS (SELECT event_id, event_type AS source, date_trunc('millisecond', CAST(ts AS TIMESTAMP)) AS d,
                 event_id % {STREAM_PARTS} AS k FROM events)""",
          "a0 AS (SELECT event_id, source, d FROM f WHERE k = 0 AND d > " + _FLOOR + ")",
          "s0 AS (SELECT source, max(d) AS c FROM a0 GROUP BY source)"]
for _k in range(1, STREAM_PARTS):
    _steps.append(f"""a{_k} AS (SELECT f.event_id, f.source, f.d FROM f LEFT JOIN s{_k - 1} s ON f.source = s.source
                 WHERE f.k = {_k} AND f.d > coalesce(greatest(s.c, {_FLOOR}), {_FLOOR}))""")
    _steps.append(f"""s{_k} AS (SELECT coalesce(s.source, n.source) AS source,
                 CASE WHEN s.c IS NULL THEN n.c WHEN n.c IS NULL THEN s.c ELSE greatest(s.c, n.c) END AS c
                 FROM s{_k - 1} s FULL OUTER JOIN (SELECT source, max(d) AS c FROM a{_k} GROUP BY source) n
                 ON s.source = n.source)""")

register("stream_cutoffs", "WITH " + ",\n".join(_steps) + "\n" +
         " UNION ALL ".join(f"SELECT event_id, source FROM a{k}" for k in range(STREAM_PARTS)))(stream_cutoffs)


# --- STM-07 clean stream ------------------------------------------------------
CLEAN_BASE = dt.datetime(2026, 4, 30, 0, 0, 0)
CLEAN_BASE_MS = 1777507200000  # CLEAN_BASE as epoch milliseconds (UTC)


def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslens.functions.text import first_line
    from presslens.schemas import SCRAPED_ARTICLE
    from presslens.streaming.jobs import run_clean_stream
    root = shared_dir(spark, "stream-clean")
    d = table(spark, sf_dir, "documents")
    scraped = d.select("source", F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"),
                       first_line("text").alias("title"),
                       F.date_format(F.lit(CLEAN_BASE) + F.make_dt_interval(mins=F.col("doc_id").cast("int")),
                                     "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
                       "text")
    encode(scraped).write.text(f"{root}/in")
    store = KeyedStore(spark, f"{root}/store")
    q = run_clean_stream(decode(file_stream(spark, f"{root}/in"), SCRAPED_ARTICLE), store, f"{root}/ckpt",
                         f"{root}/feed", trigger={"availableNow": True})
    q.awaitTermination()
    feed = spark.read.schema("url string, date bigint, text string").json(f"{root}/feed/*/*")
    return feed.select("url", F.col("date").alias("date_ms"), F.md5("text").alias("text_md5"))


_CLEAN_SQL = S.general_clean(S.marker_rules("text", "source"))
register("stream_clean", f"""
WITH c AS (SELECT 'doc/' || CAST(doc_id AS VARCHAR) AS url, doc_id, {_CLEAN_SQL} AS ctext FROM documents)
SELECT url, CAST({CLEAN_BASE_MS} + doc_id * 60000 AS BIGINT) AS date_ms, md5(ctext) AS text_md5
FROM c WHERE length(ctext) > 150
""")(stream_clean)
