"""Dedup, last-write-wins, exact samples, slices, split, per-group caps, unions
and resume anti-joins (WIN-01..07, SET-01..06, JOIN-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens import specs
from presslens.catalog import register
from presslens.functions.bands import cut
from presslens.functions.text import url_host
from presslens.operators.setops import new_items, union_all
from presslens.operators.windows import (cap_per_group, dedup_keep_first, last_write_wins,
                                         rank_slices, sample_exact, train_val_split)
from presslens.plans import sql as S
from presslens.sources.tables import articles, table

SAMPLE_PER_SOURCE = 20
SLICES = [(0, 99), (100, 149), (150, 199)]
SPLIT_FRAC = 0.9
CAP_PER_DOMAIN = 3

_HASH = "md5(CAST({k} AS VARCHAR) || ':' || '{seed}')"


def dedup_keep_first_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.md5("text").alias("text_md5"))
    return dedup_keep_first(d, "text_md5", "doc_id")


def last_write_wins_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return last_write_wins(e, "user_id", "event_id", valid=F.col("value").isNotNull())


def sample_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    return sample_exact(d, SAMPLE_PER_SOURCE, "source", "doc_id", specs.SEED)


def shuffle_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles(spark, sf_dir).select("doc_id", "score")
    neutral = a.filter(cut("score", specs.RANGE5_EVEN) == specs.RANGE5_EVEN["labels"][2])
    return rank_slices(neutral.select("doc_id"), SLICES, "doc_id", specs.SEED)


def train_val_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id")
    return train_val_split(d, SPLIT_FRAC, "doc_id", specs.SEED)


def cap_per_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", url_host("url").alias("host"))
    return cap_per_group(p, "host", "page_id", CAP_PER_DOMAIN)


def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source", "text")
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    u = union_all(d.withColumn("origin", F.lit("documents")), b.withColumn("origin", F.lit("benchmark")))
    return u.select("origin", "id", "source", F.length("text").alias("n_chars"))


def anti_join_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental labelling: articles whose title has no label yet (null-safe)."""
    a = articles(spark, sf_dir).select("doc_id", "title")
    done = a.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return new_items(a, done, "title").select("doc_id", "title")


_H = _HASH.format(k="doc_id", seed=specs.SEED)
_SLICE_CASE = " ".join(f"WHEN pos BETWEEN {lo} AND {hi} THEN {i}" for i, (lo, hi) in enumerate(SLICES))
_HOST = "replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), 'www.', '')"

register("dedup_keep_first", """
SELECT doc_id, source, text_md5 FROM (
  SELECT doc_id, source, md5(text) AS text_md5,
         row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1
""")(dedup_keep_first_q)

register("last_write_wins", """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
  FROM events WHERE value IS NOT NULL) WHERE rn = 1
""")(last_write_wins_q)

register("sample_per_source", f"""
SELECT doc_id, source FROM (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {_H}, doc_id) AS rn
  FROM documents) WHERE rn <= {SAMPLE_PER_SOURCE}
""")(sample_per_source)

register("shuffle_slices", f"""
WITH a AS ({S.ARTICLES}),
n AS (SELECT doc_id FROM a WHERE score > 0.4 AND score <= 0.6),
r AS (SELECT doc_id, row_number() OVER (ORDER BY {_H}, doc_id) - 1 AS pos FROM n)
SELECT doc_id, CAST(CASE {_SLICE_CASE} END AS INTEGER) AS slice FROM r
WHERE CASE {_SLICE_CASE} END IS NOT NULL
""")(shuffle_slices)

register("train_val_split", f"""
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {_H}, doc_id)
                      <= floor({SPLIT_FRAC} * count(*) OVER ()) THEN 'train' ELSE 'val' END AS split
FROM documents
""")(train_val_split_q)

register("cap_per_domain", f"""
SELECT page_id, host FROM (
  SELECT page_id, {_HOST} AS host, row_number() OVER (PARTITION BY {_HOST} ORDER BY page_id) AS rn
  FROM pages) WHERE rn <= {CAP_PER_DOMAIN}
""")(cap_per_domain)

register("union_sources", """
SELECT 'documents' AS origin, doc_id AS id, source, CAST(length(text) AS INTEGER) AS n_chars FROM documents
UNION ALL
SELECT 'benchmark' AS origin, item_id AS id, NULL AS source, CAST(length(text) AS INTEGER) AS n_chars FROM benchmark
""")(union_sources)

register("anti_join_resume", f"""
WITH a AS ({S.ARTICLES}),
done AS (SELECT DISTINCT a.title FROM a JOIN labels l ON a.doc_id = l.doc_id)
SELECT doc_id, title FROM a WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.title IS NOT DISTINCT FROM a.title)
""")(anti_join_resume)
