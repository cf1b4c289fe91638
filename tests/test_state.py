"""State in Spark's store: cutoffs per source and live sums, across batches, restarts and replays."""

import datetime as dt
import os
import shutil

from pyspark.sql import functions as F

from presslens.operators.aggregates import source_mean_score, totals
from presslens.operators.store import KeyedStore
from presslens.streaming.source import decode, encode, file_stream
from presslens.streaming.state import finished, run_cutoff_files, run_live_sources

NOW = dt.datetime(2026, 4, 30, 12, 0)
ARTICLE = "source string, url string, title string, date timestamp, text string"


def _at(minutes):
    return NOW + dt.timedelta(minutes=minutes)


# (source, url, minutes from now): hot.gr has most rows; floor is now - 2 h
BATCHES = [
    [("hot.gr", f"h{i}", -100 + i) for i in range(60)] + [("b.gr", "b1", -130), ("b.gr", "b2", -120), ("b.gr", "b3", -119), (None, "n1", -5)],
    [("hot.gr", f"late{i}", -90 + i) for i in range(40)] + [("hot.gr", "h60", -40), ("b.gr", "b4", -119), ("b.gr", "b5", -10), (None, "n2", -6), (None, "n3", -4)],
    [("hot.gr", "h61", -40), ("hot.gr", "h62", -39), ("c.gr", "c1", -60), ("b.gr", "b6", -11)]]


def _accepted(batches):
    """Plain rendering: per source the newest date of the batches before, not below the floor."""
    cutoff, out = {}, []
    for batch in batches:
        new = [(s, u, m) for s, u, m in batch if m > max(cutoff.get(s, -120), -120)]
        out += [u for _, u, _ in new]
        for s, _, m in new:
            cutoff[s] = max(cutoff.get(s, m), m)
    return sorted(out)


def _publish(spark, rows, path):
    encode(spark.createDataFrame([(s, u, "t", _at(m), "x") for s, u, m in rows], ARTICLE).repartition(3)).write.text(path)


def _run(spark, root, out="out", checkpoint="ckpt"):
    q = run_cutoff_files(decode(file_stream(spark, f"{root}/in/*")), f"{root}/{out}", f"{root}/{checkpoint}", F.lit(NOW), {"availableNow": True})
    q.awaitTermination(120)
    assert not q.isActive


def test_cutoffs_over_batches_and_restarts(spark, scratch):
    for k, rows in enumerate(BATCHES):
        _publish(spark, rows, f"{scratch}/in/{k}")
        _run(spark, scratch)  # a new query each time, the state in the checkpoint
    got = sorted(r["url"] for r in spark.read.parquet(f"{scratch}/out").collect())
    assert got == _accepted(BATCHES)
    _run(spark, scratch)  # nothing new
    assert spark.read.parquet(f"{scratch}/out").count() == len(got)


def test_a_batch_that_dies_is_done_again_from_its_state(spark, scratch):
    _publish(spark, BATCHES[0], f"{scratch}/in/0")
    _run(spark, scratch)
    _publish(spark, BATCHES[1], f"{scratch}/in/1")
    _run(spark, scratch)
    # as if the second batch had died before its commit: offsets written, no commit
    last = max(int(n) for n in os.listdir(f"{scratch}/ckpt/commits") if n.isdigit())
    for name in (f"{scratch}/ckpt/commits/{last}", f"{scratch}/ckpt/commits/.{last}.crc"):
        if os.path.exists(name):
            shutil.move(name, f"{scratch}/moved-{os.path.basename(name)}")
    _publish(spark, BATCHES[2], f"{scratch}/in/2")
    _run(spark, scratch)
    got = sorted(r["url"] for r in spark.read.parquet(f"{scratch}/out").collect())
    assert got == _accepted(BATCHES)


def test_live_means_equal_the_batch_query(spark, scratch):
    store = KeyedStore(spark, f"{scratch}/store", "source", buckets=2)
    rows = [("a", float(i % 7 * 10)) for i in range(40)] + [("b", None), ("b", 0.0), ("b", 33.0)]
    everything = []
    for k in range(3):
        part = rows[k::3]
        everything += part
        df = spark.createDataFrame([(s, f"{k}-{i}", "t", _at(-10_000 * k), None if v is None else str(v)) for i, (s, v) in enumerate(part)], ARTICLE)
        encode(df).write.text(f"{scratch}/in/{k}")
        stream = decode(file_stream(spark, f"{scratch}/in/*")).withColumn("pct", F.col("text").try_cast("double"))
        q = run_live_sources(stream, store, f"{scratch}/ckpt", {"availableNow": True})
        q.awaitTermination(120)
        assert not q.isActive
        so_far = spark.createDataFrame(everything, "source string, pct double")
        got = {r["source"]: r for r in finished(store.read()).collect()}
        assert {s: r["mean_score"] for s, r in got.items()} == {r["source"]: r["mean_score"] for r in source_mean_score(so_far).collect()}
        want = totals(so_far).first()
        assert all((r["total"], r["pages"]) == (want["total"], want["pages"]) for r in got.values())
    _again = finished(store.read()).count()
    assert _again == 2
