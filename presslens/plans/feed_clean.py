"""JOB-01 live clean feed, and the flagship query over the article view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens import specs
from presslens.catalog import register
from presslens.functions.bands import default_score_feed, lean_feed, pct
from presslens.functions.text import apply_marker_rules, general_clean
from presslens.operators.filters import drop_bad_dates, drop_missing, min_length
from presslens.operators.projections import materialize
from presslens.operators.windows import dedup_keep_first
from presslens.plans import sql as S
from presslens.sources.tables import articles

FEED_COLUMNS = ["source", "url", "title", "date", "text"]


def clean_feed(raw: DataFrame, dedup_key: str = "url", order: str = "ord",
               require=("title", "date", "url"), min_chars: int = specs.MIN_TEXT_CHARS,
               keep: tuple[str, ...] | None = None) -> DataFrame:
    """JOB-01: source cleaners -> general cleaner -> null/length/date filters ->
    keep-first dedup. Each cleaning step is its own projection (computed once
    per row); the dedup is the only shuffle, a partial aggregate, so repeated
    keys shrink map-side. ``dedup_key="text_md5"`` dedups on the cleaned text. Give ``keep`` where not all
    columns are wanted: the others then stay out of the shuffle."""
    df = materialize(raw, "text", general_clean(apply_marker_rules("text", "source")))
    df = drop_missing(df, [c for c in require if c in df.columns])
    df = min_length(df, "text", min_chars)
    if "date" in df.columns:
        df = drop_bad_dates(df, "date")
    if dedup_key == "text_md5":
        df = df.withColumn("text_md5", F.md5("text"))
    if dedup_key not in df.columns:
        raise ValueError(f"no dedup key {dedup_key}")
    if keep is not None:
        df = df.select(*dict.fromkeys((*keep, dedup_key, order)))
    return dedup_keep_first(df, dedup_key, order)


def feed_summary(feed: DataFrame) -> DataFrame:
    """Per source: articles, lean counts (MTH-03 on the feed default) and the
    dashboard mean score (AGG-15)."""
    s = feed.withColumn("__fs", default_score_feed("score"))
    s = s.withColumn("lean", lean_feed("__fs")).withColumn("pct", pct("__fs"))
    return s.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_articles"),
        F.count_if(F.col("lean") == "Left").alias("n_left"),
        F.count_if(F.col("lean") == "Center").alias("n_center"),
        F.count_if(F.col("lean") == "Right").alias("n_right"),
        F.floor(F.avg(F.coalesce(F.nullif(F.col("pct"), F.lit(0.0)), F.lit(50.0))) + F.lit(0.5))
         .cast("bigint").alias("mean_score"),
    )


def clean_feed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles(spark, sf_dir).select("ord", "source", "url", "title", "text", "score")
    feed = clean_feed(a, dedup_key="text_md5", require=("title", "url"), keep=("source", "score"))
    return feed_summary(feed)


_CLEANED = S.general_clean(S.marker_rules("text", "source"))

register("clean_feed", f"""
WITH a AS ({S.ARTICLES}),
c AS (SELECT ord, source, url, title, score, {_CLEANED} AS ctext FROM a),
f AS (SELECT *, md5(ctext) AS dkey FROM c
      WHERE title IS NOT NULL AND url IS NOT NULL AND length(ctext) > 150),
d AS (SELECT *, row_number() OVER (PARTITION BY dkey ORDER BY ord) AS rn FROM f),
s AS (SELECT source, {S.feed_score('score')} AS fs FROM d WHERE rn = 1)
SELECT source, count(*) AS n_articles,
       count(*) FILTER (WHERE {S.lean_feed('fs')} = 'Left') AS n_left,
       count(*) FILTER (WHERE {S.lean_feed('fs')} = 'Center') AS n_center,
       count(*) FILTER (WHERE {S.lean_feed('fs')} = 'Right') AS n_right,
       CAST(floor(avg(coalesce(nullif(fs * 100.0, 0.0), 50.0)) + 0.5) AS BIGINT) AS mean_score
FROM s GROUP BY source
""")(clean_feed_query)


# --- JOB-02 historical dataset build ----------------------------------------
PER_SOURCE = 30  # of the binding: the driver tables are small


def dataset_build(raw: DataFrame, per_source: int = specs.PER_SOURCE, seed: int = specs.SEED,
                  years=None, require=("title", "date", "url")) -> DataFrame:
    """JOB-02: cleaned union of article files -> null / length (/ year) filters
    -> exact seeded sample per source -> seeded shuffle."""
    from presslens.operators.filters import year_in
    from presslens.operators.windows import sample_exact, shuffle
    df = materialize(raw, "text", general_clean(apply_marker_rules("text", "source")))
    df = drop_missing(df, [c for c in require if c in df.columns])
    df = min_length(df, "text")
    if years is not None and "date" in df.columns:
        df = year_in(drop_bad_dates(df, "date"), "date", years)
    return shuffle(sample_exact(df, per_source, "source", "url", seed), "url", seed)


def dataset_build_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslens.operators.setops import union_all
    from presslens.sources.tables import table
    from presslens.functions.text import first_line
    d = articles(spark, sf_dir).select("source", "url", "title", "text")
    b = table(spark, sf_dir, "benchmark").select(
        F.lit("benchmark").alias("source"), F.concat(F.lit("bench/"), F.col("item_id").cast("string")).alias("url"),
        first_line("text").alias("title"), "text")
    out = dataset_build(union_all(d, b), PER_SOURCE, require=("title", "url"))
    return out.select("source", "url", F.length("text").alias("n_chars"))


register("dataset_build", f"""
WITH u AS (SELECT source, 'doc/' || CAST(doc_id AS VARCHAR) AS url, {S.first_line('text')} AS title, text FROM documents
           UNION ALL
           SELECT 'benchmark', 'bench/' || CAST(item_id AS VARCHAR), {S.first_line('text')}, text FROM benchmark),
c AS (SELECT source, url, title, {_CLEANED} AS text FROM u),
f AS (SELECT * FROM c WHERE title IS NOT NULL AND url IS NOT NULL AND length(text) > 150),
s AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5(url || ':{specs.SEED}'), url) AS rn FROM f)
SELECT source, url, CAST(length(text) AS INTEGER) AS n_chars FROM s WHERE rn <= {PER_SOURCE}
""")(dataset_build_q)
