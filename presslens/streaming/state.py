"""Streaming state in Spark's own store: cutoffs per source (STM-06, STM-04), live totals and means (STM-08, AGG-14/15).

The checkpoint holds the state beside the offsets, so a batch that is replayed after a failure starts from the
state, and with the clock, of its first attempt; nothing is rewritten but the keys that a batch touches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from presslens import specs
from presslens.functions.text import doc_key
from presslens.operators.aggregates import source_score
from presslens.operators.store import KeyedStore

LANES = 8


def _with_marks(lanes: int, columns: list[str]):
    """Rows as they are, and at the end of a task the newest date of each of its sources once for every lane."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        newest: dict = {}
        floor = None
        for pdf in batches:
            for source, date in pdf.dropna(subset=["date"]).groupby("source", dropna=False)["date"].max().items():
                source = None if pd.isna(source) else source
                newest[source] = max(date, newest[source]) if source in newest else date
            floor = pdf["__floor"].iloc[0] if len(pdf) else floor
            yield pdf
        marks = [(s, d, lane) for s, d in newest.items() for lane in range(lanes)]
        if marks:
            out = pd.DataFrame(marks, columns=["source", "date", "__lane"])
            out["__floor"], out["__mark"] = floor, True
            for c in columns:
                if c not in out:
                    out[c] = pd.Series([None] * len(out), dtype=object)
            yield out[columns]
    return run


def _advance(columns: list[str], hours: int):
    """One lane of a source: its rows newer than the cutoff the batch began with; then the cutoff moves."""
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        saved = pd.Timestamp(state.get[0]) if state.exists else None  # nanoseconds, UTC
        if state.hasTimedOut:
            if saved.value // 1_000_000 > state.getCurrentProcessingTimeMs() - hours * 3_600_000:
                state.setTimeoutDuration(hours * 3_600_000)
            else:
                state.remove()  # the floor is above it for good
            return
        newest = saved
        for pdf in batches:
            floor = pdf["__floor"].iloc[0]
            cutoff = floor if saved is None else max(saved, floor)
            new = pdf[pdf["date"] > cutoff]
            marks = new.loc[new["__mark"], "date"]
            if len(marks):
                newest = marks.max() if newest is None else max(newest, marks.max())
            yield new.loc[~new["__mark"], columns]
        if newest is not None:
            state.update((int(newest.value),))
            state.setTimeoutDuration(hours * 3_600_000)
    return run


def newer_than_cutoffs(stream: DataFrame, now: Column | None = None, hours: int = specs.LOOKBACK_HOURS, lanes: int = LANES) -> DataFrame:
    """STM-06: the articles of a stream (source, date, ...) newer than their source's cutoff, as a stream.

    The cutoff is frozen for a micro-batch: the newest date of the source in all batches before, but not below
    ``now`` (default: the batch's own clock, which a replay repeats) less ``hours``. Rows without a date are dropped.

    State is one date per (source, lane): rows go to ``lanes`` lanes by the hash of their columns, so a source with a
    third of all rows is not one task's, and every task sends the newest date it saw of a source to all lanes of it, which
    thus agree on the cutoff. A lane's state goes when the source was silent for the lookback; nothing changes by that, as
    the floor is above it then.
    """
    columns = stream.columns
    clock = F.current_timestamp() if now is None else now
    rows = stream.filter("date is not null").withColumns({
        "__lane": F.pmod(F.xxhash64(*columns), F.lit(lanes)).cast("int"),
        "__floor": (clock - F.expr(f"INTERVAL {int(hours)} HOURS")).cast("timestamp"), "__mark": F.lit(False)})
    marked = rows.mapInPandas(_with_marks(lanes, rows.columns), rows.schema)
    return marked.groupBy("source", "__lane").applyInPandasWithState(
        _advance(columns, hours), stream.schema, "cutoff long", "append", GroupStateTimeout.ProcessingTimeTimeout)


def run_cutoff_files(stream: DataFrame, path: str, checkpoint: str, now: Column | None = None, trigger: dict | None = None, **kw):
    """The accepted articles, keyed, into files under ``path``: each batch is entered once, however often it is tried.

    Timers run with the batches that bring data: batches without any, which a timer would ask for without end, are off.
    """
    accepted = newer_than_cutoffs(stream, now, **kw).withColumn("_id", doc_key("url"))
    w = accepted.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    conf, name = stream.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return (w.trigger(**trigger) if trigger else w).start()  # takes the session's settings with it
    finally:
        conf.set(name, before)


def live_sources(stream: DataFrame, by: str = "source", score: str = "pct", default: float = specs.DASH_DEFAULT_SCORE) -> DataFrame:
    """AGG-15 / AGG-14 over a stream: (``by``, n, total_score) kept in the state store, partial sums merged
    batch by batch (a hot source is summed in every task before it moves). ``finished`` makes means and totals of it.

    Every row counts when it arrives, however late its date: sums have no window to miss.
    """
    return stream.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sum(source_score(score, default)).alias("total_score"))


def run_live_sources(stream: DataFrame, store: KeyedStore, checkpoint: str, trigger: dict | None = None, **kw):
    """The sums of the sources a batch touched, into ``store`` (keyed by the source). Sums are whole, so a batch that is
    tried again leaves what it left the first time."""
    w = live_sources(stream, store.key, **kw).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    w = w.foreachBatch(lambda batch, _: store.upsert(batch) and None)
    return (w.trigger(**trigger) if trigger else w).start()


def finished(sums: DataFrame, by: str = "source", limit: int = specs.FEED_PAGE_SIZE) -> DataFrame:
    """(``by``, mean_score, n, total, pages) of the latest sums (a row a source)."""
    total = sums.agg(F.sum("n")).scalar()
    return sums.select(by, F.floor(F.col("total_score") / F.col("n") + F.lit(0.5)).cast("bigint").alias("mean_score"), "n",
                       total.alias("total"), F.ceil(total / F.lit(float(limit))).cast("bigint").alias("pages"))
