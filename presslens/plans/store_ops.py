"""Keyed store bindings (SNK-08) over the event view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.catalog import register
from presslens.operators.store import KeyedStore
from presslens.plans import sql as S
from presslens.session import shared_dir
from presslens.sources.tables import events_view


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_view(spark, sf_dir).select("_id", "event_id", "source", "title", "score")


def upsert_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store = all events; then click/purchase rows are re-scored (replace) and
    re-issued under new keys (insert) in one upsert."""
    store = KeyedStore(spark, shared_dir(spark, "store-upsert"))
    base = _base(spark, sf_dir)
    store.upsert(base)
    sel = base.filter(F.col("source").isin("click", "purchase"))
    rescored = sel.withColumn("score", F.least(F.col("score") * 2, F.lit(1.0)))
    inserted = sel.withColumn("_id", F.md5(F.concat(F.lit("new/"), F.col("event_id").cast("string"))))
    store.upsert(rescored.unionByName(inserted))
    return store.read().select("_id", "event_id", "source", F.round("score", 6).alias("score"))


def patch_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial update: error events get a new score (title untouched), signup
    events a new title; ids of purchase events re-keyed under 'missing/' are
    not found."""
    store = KeyedStore(spark, shared_dir(spark, "store-patch"))
    base = _base(spark, sf_dir)
    store.upsert(base)
    err = base.filter(F.col("source") == "error").select(
        "_id", F.lit(None).cast("string").alias("title"), F.lit(0.99).alias("score"))
    sig = base.filter(F.col("source") == "signup").select(
        "_id", F.concat(F.lit("renamed "), F.col("title")).alias("title"), F.lit(None).cast("double").alias("score"))
    ghost = base.filter(F.col("source") == "purchase").select(
        F.md5(F.concat(F.lit("missing/"), F.col("event_id").cast("string"))).alias("_id"),
        F.lit("x").alias("title"), F.lit(0.1).alias("score"))
    _, missing = store.patch(err.unionByName(sig).unionByName(ghost))
    cur = store.read().select("_id", "title", F.round("score", 6).alias("score"), F.lit("stored").alias("status"))
    nf = missing.select("_id", F.lit(None).cast("string").alias("title"), F.lit(None).cast("double").alias("score"),
                        F.lit("not_found").alias("status"))
    return cur.unionByName(nf)


register("upsert", f"""
WITH ev AS ({S.EVENTS}),
b AS (SELECT _id, event_id, source, score FROM ev),
sel AS (SELECT * FROM b WHERE source IN ('click', 'purchase')),
upd AS (SELECT _id, event_id, source, least(score * 2, 1.0) AS score FROM sel
        UNION ALL SELECT md5('new/' || CAST(event_id AS VARCHAR)), event_id, source, score FROM sel)
SELECT _id, event_id, source, round(score, 6) AS score FROM b WHERE _id NOT IN (SELECT _id FROM upd)
UNION ALL SELECT _id, event_id, source, round(score, 6) FROM upd
""")(upsert_q)

register("patch", f"""
WITH ev AS ({S.EVENTS})
SELECT _id,
       CASE WHEN source = 'signup' THEN 'renamed ' || title ELSE title END AS title,
       round(CASE WHEN source = 'error' THEN 0.99 ELSE score END, 6) AS score, 'stored' AS status FROM ev
UNION ALL
SELECT md5('missing/' || CAST(event_id AS VARCHAR)), NULL, NULL, 'not_found' FROM ev WHERE source = 'purchase'
""")(patch_q)
