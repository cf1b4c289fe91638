"""JOB-10 feed and per-source view over the event view (SRT-01/02, PRJ-04,
AGG-14/15/16, FLT-14), and the localised pick (PRJ-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslens.catalog import register
from presslens.functions.bands import default_score_feed, lean_feed, pct
from presslens.functions.dates import display_date
from presslens.operators.aggregates import source_mean_score, totals
from presslens.operators.filters import by_source
from presslens.operators.projections import feed_card, localized_array, localized_text
from presslens.operators.sort import page, recent
from presslens.plans import sql as S
from presslens.sources.tables import articles, events_view

PAGE_NO = 3


def _labelled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events_view(spark, sf_dir)
    return e.withColumn("ai_labels", F.struct(
        F.lit("").alias("reasoning"), F.array(F.col("source")).alias("primary_entities"),
        F.col("score").alias("bias")))


def _card(df: DataFrame) -> DataFrame:
    c = feed_card(df)
    return c.select("title", "source", "url", display_date("date", "date").alias("date_display"),
                    F.array_join("tags", ",").alias("tags"), "reasoning", "pol_lean",
                    F.round("pol_score", 6).alias("pol_score"))


def feed_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _card(page(_labelled_events(spark, sf_dir), PAGE_NO))


def feed_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _card(recent(_labelled_events(spark, sf_dir)))


def feed_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(events_view(spark, sf_dir))


def source_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-15 per source over the whole table (plus row counts)."""
    e = events_view(spark, sf_dir).withColumn("pct", pct(default_score_feed("score")))
    m = source_mean_score(e, "source", "pct")
    n = e.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return m.join(n, "source")


def source_mean_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-15, page variant: mean over the rows of one feed page, per source."""
    p = page(events_view(spark, sf_dir), PAGE_NO).withColumn("pct", pct(default_score_feed("score")))
    return source_mean_score(p, "source", "pct")


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-16: 'All' first, then each non-empty source in feed order (first
    appearance in newest-first order)."""
    e = events_view(spark, sf_dir).filter(F.col("source").isNotNull() & (F.col("source") != ""))
    # feed order is (date desc nulls last, _id asc); as one ascending key:
    # (date is null, -date, _id) - its minimum per source is the first appearance
    key = F.struct(F.col("date").isNull().alias("n"), (-F.unix_micros("date")).alias("d"), F.col("_id").alias("i"))
    first = e.groupBy("source").agg(F.min(key).alias("__f"))
    # one row per distinct source: a small table, one ordered window is fine
    w = Window.orderBy(F.col("__f").asc())
    ranked = first.select("source", F.row_number().over(w).alias("pos"))
    allrow = spark.range(1).select(F.lit("All").alias("source"), F.lit(0).alias("pos"))
    return allrow.unionByName(ranked.select("source", F.col("pos").cast("int").alias("pos")))


def source_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-14 with a concrete source and with 'All'."""
    e = events_view(spark, sf_dir)
    return by_source(e, "click").select("event_id").unionByName(
        by_source(e, "All").filter(F.col("source") == "view").select("event_id"))


def localized_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles(spark, sf_dir)
    words = F.split(F.col("title"), " ")
    rec = a.select(
        "doc_id", "lang",
        F.struct(F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.col("title")).alias("en"),
                 F.when(F.col("doc_id") % 2 == 0, F.lit(None)).otherwise(F.concat(F.lit("el:"), F.col("title"))).alias("el"))
         .alias("reasoning"),
        F.struct(F.when(F.col("doc_id") % 5 == 0, F.lit(None)).otherwise(F.slice(words, 1, 2)).alias("en"),
                 F.when(F.col("doc_id") % 4 == 0, F.array().cast("array<string>"))
                  .when(F.col("doc_id") % 4 == 1, F.lit(None)).otherwise(F.slice(words, 2, 2)).alias("el"))
         .alias("entities"))
    return rec.select("doc_id",
                      localized_text("reasoning", F.col("lang")).alias("reasoning_pick"),
                      localized_text("reasoning", "el").alias("reasoning_el"),
                      F.array_join(localized_array("entities", F.col("lang")), "|").alias("tags_pick"))


def display_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-04 / MTH-07 over the article view: empty titles and a 0 score take the defaults."""
    a = articles(spark, sf_dir)
    rec = a.select(F.nullif(F.regexp_replace("title", "^[A-Z].*", ""), F.lit("")).alias("title"),
                   "source", "url", F.lit(None).cast("timestamp").alias("date"),
                   F.struct(F.lit("").alias("reasoning"), F.lit(None).cast("array<string>").alias("primary_entities"),
                            F.col("score").alias("bias")).alias("ai_labels"))
    c = feed_card(rec)
    return c.select("title", "source", "url", F.array_join("tags", ",").alias("tags"), "reasoning",
                    "pol_lean", F.round("pol_score", 6).alias("pol_score"))


_EV_CARD = f"""
SELECT coalesce(nullif(title, ''), 'No Title') AS title, coalesce(nullif(source, ''), 'Unknown Source') AS source,
       coalesce(nullif(url, ''), '#') AS url, coalesce(strftime(date, '%Y-%m-%d %H:%M'), CAST(date AS VARCHAR)) AS date_display, source AS tags,
       'Analysis pending...' AS reasoning, {S.lean_feed(S.feed_score('score'))} AS pol_lean,
       round({S.feed_score('score')} * 100.0, 6) AS pol_score
FROM ev ORDER BY date DESC NULLS LAST, _id"""

register("feed_page", f"WITH ev AS ({S.EVENTS}) {_EV_CARD} LIMIT 25 OFFSET {(PAGE_NO - 1) * 25}")(feed_page)
register("feed_recent", f"WITH ev AS ({S.EVENTS}) {_EV_CARD} LIMIT 5")(feed_recent)
register("feed_totals", "SELECT count(*) AS total, CAST(ceil(count(*) / 25.0) AS BIGINT) AS pages FROM events")(
    feed_totals)

_MEAN = "CAST(floor(avg(coalesce(nullif(pct, 0.0), 50.0)) + 0.5) AS BIGINT)"
register("source_mean", f"""
WITH ev AS ({S.EVENTS}), p AS (SELECT source, {S.feed_score('score')} * 100.0 AS pct FROM ev)
SELECT source, {_MEAN} AS mean_score, count(*) AS n FROM p GROUP BY source
""")(source_mean)

register("source_mean_page", f"""
WITH ev AS ({S.EVENTS}),
pg AS (SELECT * FROM ev ORDER BY date DESC NULLS LAST, _id LIMIT 25 OFFSET {(PAGE_NO - 1) * 25}),
p AS (SELECT source, {S.feed_score('score')} * 100.0 AS pct FROM pg)
SELECT source, {_MEAN} AS mean_score FROM p GROUP BY source
""")(source_mean_page)

register("sources", f"""
WITH ev AS ({S.EVENTS}),
f AS (SELECT source, arg_max(_id, (date, -1)) AS x, max(date) AS d FROM ev WHERE source IS NOT NULL AND source <> '' GROUP BY source),
g AS (SELECT source, max(date) AS d FROM ev WHERE source IS NOT NULL AND source <> '' GROUP BY source),
h AS (SELECT g.source, g.d, min(ev._id) AS i FROM g JOIN ev ON ev.source = g.source AND ev.date = g.d GROUP BY g.source, g.d)
SELECT 'All' AS source, 0 AS pos
UNION ALL
SELECT source, CAST(row_number() OVER (ORDER BY d DESC, i) AS INTEGER) AS pos FROM h
""")(sources)

register("source_filter", """
SELECT event_id FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id FROM events WHERE event_type = 'view'
""")(source_filter)

_TITLE = S.first_line("text")
register("localized_pick", f"""
WITH a AS ({S.ARTICLES}),
r AS (SELECT doc_id, lang, CASE WHEN doc_id % 3 = 0 THEN '' ELSE title END AS r_en,
             CASE WHEN doc_id % 2 = 0 THEN NULL ELSE 'el:' || title END AS r_el,
             CASE WHEN doc_id % 5 = 0 THEN NULL ELSE string_split(title, ' ')[1:2] END AS e_en,
             CASE WHEN doc_id % 4 = 0 THEN [] WHEN doc_id % 4 = 1 THEN NULL ELSE string_split(title, ' ')[2:3] END AS e_el
      FROM a)
SELECT doc_id,
       coalesce(nullif(CASE WHEN lang = 'en' THEN r_en WHEN lang = 'el' THEN r_el END, ''), nullif(r_el, ''), nullif(r_en, ''), '') AS reasoning_pick,
       coalesce(nullif(r_el, ''), nullif(r_el, ''), nullif(r_en, ''), '') AS reasoning_el,
       coalesce(array_to_string(coalesce(CASE WHEN lang = 'en' THEN e_en WHEN lang = 'el' THEN e_el END, e_el, e_en, []), '|'), '') AS tags_pick
FROM r
""")(localized_pick)

register("display_defaults", f"""
WITH a AS ({S.ARTICLES})
SELECT coalesce(nullif(regexp_replace(title, '^[A-Z].*', ''), ''), 'No Title') AS title,
       coalesce(nullif(source, ''), 'Unknown Source') AS source, coalesce(nullif(url, ''), '#') AS url,
       '' AS tags, 'Analysis pending...' AS reasoning,
       {S.lean_feed(S.feed_score('score'))} AS pol_lean, round({S.feed_score('score')} * 100.0, 6) AS pol_score
FROM a
""")(display_defaults)
