"""Streaming jobs: scored keyed sink (JOB-04, STM-02..05) and per-source
late-data cutoffs (STM-06).

All run as ``foreachBatch`` on a checkpointed query. Each micro-batch is
processed with ordinary DataFrame operators on the executors (the batch is
never collected) and written so that a replayed batch leaves what it left the first time: keyed
upserts where the later date wins, and feed directories named by query and batch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens import specs
from presslens.functions.text import doc_key, prompt_text
from presslens.operators.score import Scorer, score_articles
from presslens.operators.store import KeyedStore
from presslens.operators.windows import last_write_wins


def _start(df: DataFrame, fn, checkpoint: str, trigger: dict | None):
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(**trigger) if trigger else w
    return w.start()


def query_id(batch: DataFrame) -> str:
    """The id of the query that runs this batch: one for the life of its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def score_batch(batch: DataFrame, scorer: Scorer, store: KeyedStore, **score_kw) -> None:
    """STM-02/04: one micro-batch -> dedup by key (latest date wins) -> score ->
    sink document -> keyed upsert (a stored later date wins too). An empty batch writes nothing."""
    if batch.isEmpty():
        return
    keyed = batch.withColumn("_id", doc_key("url")).withColumn("__ord", F.unix_micros(F.col("date")))
    keyed = last_write_wins(keyed, "_id", "__ord").drop("__ord")
    scored = score_articles(keyed.withColumn("prompt", prompt_text("title", "text")), scorer, **score_kw)
    doc = scored.select("_id", "source", "url", "title", "date", F.col("text").alias("content"), "ai_labels")
    store.upsert(doc, newest_by="date")


def run_scored_stream(stream: DataFrame, scorer: Scorer, store: KeyedStore, checkpoint: str,
                      trigger: dict | None = None, **score_kw):
    """JOB-04: decoded article stream -> scored, keyed store. ``trigger`` as in
    ``DataStreamWriter.trigger`` (default: micro-batches until stopped)."""
    return _start(stream, lambda b, i: score_batch(b, scorer, store, **score_kw), checkpoint, trigger)


def cutoff_batch(batch: DataFrame, batch_id: int, state: KeyedStore, sink: KeyedStore, now: dt.datetime,
                 hours: int = specs.LOOKBACK_HOURS, query: str | None = None) -> None:
    """STM-06: keep articles newer than their source's cutoff, frozen for the
    batch (saved newest accepted, clamped to now - lookback); then advance the
    cutoffs. The state's version carries the batch of this query: a replayed batch whose state is
    committed is skipped, one that got as far as the sink is done again with the clock it began with."""
    query = query or query_id(batch)
    seen = state.meta().get(query, {})
    if seen.get("done", -1) >= batch_id:
        return
    if seen.get("begun") == batch_id:
        now = dt.datetime.fromisoformat(seen["now"])
    else:
        state.commit(meta={query: {**seen, "begun": batch_id, "now": now.isoformat()}})
    floor = F.lit(now) - F.expr(f"INTERVAL {int(hours)} HOURS")
    cur = state.read()
    st = (cur.select("source", F.col("cutoff").alias("__cutoff")) if cur is not None
          else batch.sparkSession.createDataFrame([], "source string, __cutoff timestamp"))
    # one row per source: AQE turns this into a broadcast join when the
    # measured state is small, a shuffle join otherwise
    acc = (batch.join(st, "source", "left")
           .filter(F.col("date") > F.coalesce(F.greatest("__cutoff", floor), floor)).drop("__cutoff")
           .withColumn("_id", doc_key("url")).withColumn("__ord", F.unix_micros(F.col("date")))
           .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        rows = last_write_wins(acc, "_id", "__ord").select("_id", "source", "url", "title", "date")
        sink.upsert(rows, newest_by="date")
        newest = acc.groupBy("source").agg(F.max("date").alias("cutoff"))
        state.upsert(newest, newest_by="cutoff", meta={query: {"done": batch_id}})
    finally:
        acc.unpersist()


def run_cutoff_stream(stream: DataFrame, state: KeyedStore, sink: KeyedStore, checkpoint: str,
                      now: Callable[[], dt.datetime] | None = None, trigger: dict | None = None):
    """``now`` is asked at every batch (default: the UTC clock), so the lookback moves with time."""
    clock = now or (lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    return _start(stream, lambda b, i: cutoff_batch(b, i, state, sink, clock()), checkpoint, trigger)


def clean_batch(batch: DataFrame, batch_id: int, store: KeyedStore, jsonl_path: str | None = None,
                query: str | None = None) -> None:
    """STM-07: one micro-batch of scraped rows -> JOB-01 clean feed -> keyed
    store (and, optionally, a JSON-lines feed with epoch-ms dates in a directory of the query and batch).
    Of rows with the same content the one of the earliest date stays, whatever order tasks read them in."""
    from presslens.operators.sinks import write_jsonl
    from presslens.plans.feed_clean import FEED_COLUMNS, clean_feed
    if batch.isEmpty():
        return
    order = F.struct("date", F.xxhash64(*batch.columns))
    feed = clean_feed(batch.withColumn("ord", order)).select(*FEED_COLUMNS)
    feed = feed.withColumn("_id", doc_key("url")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        store.upsert(feed)
        if jsonl_path:
            write_jsonl(feed.drop("_id"), f"{jsonl_path}/query={query or query_id(batch)}/batch={batch_id}", mode="overwrite")
    finally:
        feed.unpersist()


def run_clean_stream(stream: DataFrame, store: KeyedStore, checkpoint: str, jsonl_path: str | None = None,
                     trigger: dict | None = None):
    return _start(stream, lambda b, i: clean_batch(b, i, store, jsonl_path), checkpoint, trigger)
