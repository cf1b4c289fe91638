"""Keyed store and streaming: crashes, replays, re-dated and late records."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from presslens.operators.score import LexiconScorer
from presslens.operators.store import KeyedStore
from presslens.streaming.jobs import clean_batch, cutoff_batch, run_clean_stream, run_scored_stream, score_batch
from presslens.streaming.source import decode, encode, file_stream

D = dt.datetime
ROWS = [("a.gr", "u1", "t1", D(2026, 4, 30, 10, 0), "the left and the"),
        ("a.gr", "u2", "t2", D(2026, 4, 30, 11, 0), "and and right"),
        ("b.gr", "u3", "t3", D(2026, 4, 30, 9, 0), "neutral words"),
        ("a.gr", "u1", "t1b", D(2026, 4, 30, 12, 0), "the the the")]  # u1 again, later
ARTICLE = "source string, url string, title string, date timestamp, text string"
SCORER = LexiconScorer(["the"], ["and"])


def _publish(spark, rows, path):
    encode(spark.createDataFrame(rows, ARTICLE)).write.mode("append").text(path)


def _run(spark, src, store, checkpoint):
    q = run_scored_stream(decode(file_stream(spark, src)), SCORER, store, checkpoint, trigger={"availableNow": True}, backoff=0)
    q.awaitTermination()


def _rows(store, *cols):
    return sorted(tuple(r[c] for c in cols) for r in store.read().collect())


def test_replay_into_the_same_store(spark, scratch):
    src, store = os.path.join(scratch, "in"), KeyedStore(spark, f"{scratch}/store")
    _publish(spark, ROWS, src)
    _run(spark, src, store, f"{scratch}/c1")
    first = _rows(store, "_id", "url", "title", "ai_labels")
    assert len(first) == 3 and [r[2] for r in first if r[1] == "u1"] == ["t1b"]  # latest date wins inside a batch
    version = store.version()
    _run(spark, src, store, f"{scratch}/c1")  # nothing new under the same checkpoint
    assert store.version() == version
    _run(spark, src, store, f"{scratch}/c2")  # a new checkpoint replays all
    assert _rows(store, "_id", "url", "title", "ai_labels") == first


def test_redated_and_older_records(spark, scratch):
    store = KeyedStore(spark, f"{scratch}/store")
    batch = lambda *rows: spark.createDataFrame(list(rows), ARTICLE)
    score_batch(batch(("a.gr", "u", "one", D(2026, 4, 29), "x"), ("a.gr", "v", "keep", D(2026, 4, 1), "x")), SCORER, store, backoff=0)
    score_batch(batch(("a.gr", "u", "two", D(2026, 4, 30), "x")), SCORER, store, backoff=0)
    assert _rows(store, "url", "title") == [("u", "two"), ("v", "keep")]  # another day, the same key
    score_batch(batch(("a.gr", "u", "late", D(2026, 4, 28), "x")), SCORER, store, backoff=0)
    assert _rows(store, "url", "title") == [("u", "two"), ("v", "keep")]
    score_batch(batch(("a.gr", "u", "same day", D(2026, 4, 30), "x")), SCORER, store, backoff=0)
    assert _rows(store, "url", "title") == [("u", "same day"), ("v", "keep")]


def test_malformed_payload_quarantined(spark, scratch):
    p = os.path.join(scratch, "bad")
    spark.createDataFrame([("not json",), ('{"url": "x", "date": 0}',)], "value string").write.text(p)
    rows = spark.read.text(p).transform(decode).collect()
    assert [r.url for r in rows] == ["x"]


def _articles(spark, rows):
    return spark.createDataFrame(rows, "source string, url string, title string, date timestamp")


def test_cutoff_batches_skip_replays_of_their_query_only(spark, scratch):
    state, sink = KeyedStore(spark, f"{scratch}/st", "source"), KeyedStore(spark, f"{scratch}/sk")
    now = D(2026, 4, 30, 0, 0)
    df = _articles(spark, [r[:4] for r in ROWS])
    early, late = df.filter("title <> 't1b'"), df.filter("title = 't1b'")
    cutoff_batch(early, 0, state, sink, now, query="q")
    v = state.version()
    cutoff_batch(early, 0, state, sink, now, query="q")  # replay: skipped
    assert state.version() == v
    cutoff_batch(late, 1, state, sink, now, query="q")
    assert {r.source: r.cutoff for r in state.read().collect()} == {"a.gr": D(2026, 4, 30, 12, 0), "b.gr": D(2026, 4, 30, 9, 0)}
    cutoff_batch(_articles(spark, [("b.gr", "u9", "late", D(2026, 4, 30, 8, 0))]), 2, state, sink, now, query="q")
    assert "u9" not in {r.url for r in sink.read().collect()}
    # another checkpoint counts its batches from 0: they are not skipped
    cutoff_batch(_articles(spark, [("c.gr", "u10", "new", D(2026, 4, 30, 8, 0))]), 0, state, sink, now, query="other")
    assert "u10" in {r.url for r in sink.read().collect()}


def test_cutoff_batch_is_done_again_with_its_clock(spark, scratch):
    state, sink = KeyedStore(spark, f"{scratch}/st", "source"), KeyedStore(spark, f"{scratch}/sk")
    rows = _articles(spark, [("a.gr", "u1", "t", D(2026, 4, 30, 10, 30))])
    state.commit(meta={"q": {"begun": 4, "now": "2026-04-30T12:00:00"}})  # died before its state was committed
    cutoff_batch(rows, 4, state, sink, D(2026, 5, 1), query="q")
    assert [r.url for r in sink.read().collect()] == ["u1"]
    cutoff_batch(rows, 5, state, sink, D(2026, 5, 1), query="q")  # the clock has moved on: too old now
    assert state.meta()["q"] == {"done": 5}


def test_clean_feed_replay_and_order(spark, scratch):
    store, feed = KeyedStore(spark, f"{scratch}/store"), f"{scratch}/feed"
    text = "word " * 60
    rows = [("a.gr", "u", "t", f"2026-04-{d:02d}T10:00:00Z", f"{text}{d}") for d in (3, 1, 2)]
    df = spark.createDataFrame(rows, "source string, url string, title string, date string, text string")
    for part in (df, df.repartition(3), df.orderBy(F.desc("date"))):  # replays, tasks in any order
        clean_batch(part, 7, store, feed, query="q")
        got = spark.read.json(f"{feed}/*/*").collect()
        assert len(got) == 1 and got[0]["text"].endswith("1") and store.read().count() == 1


def test_clean_stream_replayed_from_a_new_checkpoint(spark, scratch):
    from presslens.schemas import SCRAPED_ARTICLE
    rows = [("a.gr", f"u{i}", "t", "2026-04-01T10:00:00Z", "word " * 60) for i in range(3)]
    src, store = f"{scratch}/in", KeyedStore(spark, f"{scratch}/store")
    encode(spark.createDataFrame(rows, "source string, url string, title string, date string, text string")).write.text(src)
    for _ in range(2):  # the second run finds its batch done
        run_clean_stream(decode(file_stream(spark, src), SCRAPED_ARTICLE), store, f"{scratch}/ck", f"{scratch}/feed",
                         trigger={"availableNow": True}).awaitTermination()
        assert spark.read.json(f"{scratch}/feed/*/*").count() == 3 and store.read().count() == 3


SCHEMA = "_id string, title string, score double"


def test_store_upsert_and_patch(spark, scratch):
    s = KeyedStore(spark, f"{scratch}/kv")
    assert s.read() is None and s.version() == 0
    s.upsert(spark.createDataFrame([("a", "x", 1.0), ("b", "y", 2.0)], SCHEMA))
    s.upsert(spark.createDataFrame([("b", "y2", 3.0), ("c", "z", 4.0)], SCHEMA))
    assert _rows(s, "_id", "title", "score") == [("a", "x", 1.0), ("b", "y2", 3.0), ("c", "z", 4.0)]
    _, missing = s.patch(spark.createDataFrame([("a", None, 9.0), ("q", "n", 1.0)], SCHEMA))
    assert _rows(s, "_id", "title", "score")[0] == ("a", "x", 9.0)
    assert [r._id for r in missing.collect()] == ["q"]
    assert s.upsert(spark.createDataFrame([], SCHEMA)) == s.version() == 3


def test_upsert_rewrites_touched_buckets_only(spark, scratch):
    s = KeyedStore(spark, f"{scratch}/kv", buckets=8)
    s.upsert(spark.createDataFrame([(f"k{i}", "t", float(i)) for i in range(100)], SCHEMA))
    before = s._manifest()["paths"]
    s.upsert(spark.createDataFrame([("k5", "new", 0.0)], SCHEMA))
    after = s._manifest()["paths"]
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    assert s.read().count() == 100
    with pytest.raises(ValueError):
        KeyedStore(spark, f"{scratch}/kv", buckets=4).read()


def test_buckets_and_files_follow_the_rows(spark, scratch, monkeypatch):
    from presslens.operators import store
    monkeypatch.setattr(store, "BUCKET_ROWS", 50)
    monkeypatch.setattr(store, "FILE_ROWS", 10)
    s = KeyedStore(spark, f"{scratch}/kv")
    empty = spark.createDataFrame([], SCHEMA)
    assert s.upsert(empty) == 0 and s.read() is None and s.patch(empty)[0] == 0
    s.upsert(spark.createDataFrame([(f"k{i}", "t", float(i)) for i in range(190)], SCHEMA))
    paths = s._manifest()["paths"]
    assert len(paths) == 4 and s._manifest()["buckets"] == 4  # 190 rows, 50 a bucket
    files = [n for p in paths.values() for n in os.listdir(f"{scratch}/kv/{p}") if n.endswith(".parquet")]
    assert len(files) > 8  # several a bucket
    again = KeyedStore(spark, f"{scratch}/kv")  # the number is the store's own
    again.upsert(spark.createDataFrame([(f"k{i}", "u", 0.0) for i in range(0, 1000, 10)], SCHEMA))
    assert len(again._manifest()["paths"]) == 4 and again.read().count() == 190 + 81
    assert {r["title"] for r in again.read().where("score = 0").collect()} == {"u"}


@pytest.mark.parametrize("dies_at", ["in", "rows", "commit"])
def test_retry_after_a_crash(spark, scratch, monkeypatch, dies_at):
    s = KeyedStore(spark, f"{scratch}/kv")
    s.upsert(spark.createDataFrame([("a", "x", 1.0)], SCHEMA))
    update = spark.createDataFrame([("a", "y", 2.0), ("b", "z", 3.0)], SCHEMA)
    step = {"in": "_stage", "rows": "_put", "commit": "commit"}[dies_at]
    done, commit = getattr(KeyedStore, step), KeyedStore.commit

    def dying(self, *args, **kw):
        if step != "commit":
            done(self, *args, **kw)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedStore, step, dying)
        with pytest.raises(RuntimeError):
            s.upsert(update)
    assert _rows(s, "_id", "title") == [("a", "x")]  # nothing half done is seen
    s.upsert(update)
    assert _rows(s, "_id", "title") == [("a", "y"), ("b", "z")]
    assert commit is KeyedStore.commit and s.vacuum(keep=1) >= 2
    assert _rows(s, "_id", "title") == [("a", "y"), ("b", "z")]
    with pytest.raises(Exception):  # a second writer of the same version
        monkeypatch.setattr(KeyedStore, "version", lambda self: 1)
        s.commit()
