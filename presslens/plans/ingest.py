"""JOB-03 incremental ingestion: sitemap filter, article cutoffs, state merge
(SRC-08, FLT-08..12, JOIN-04/05/07, WIN-06, AGG-17, DT-01/02/06)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens import specs
from presslens.catalog import register
from presslens.functions.dates import clamp_cutoff, parse_iso, parse_iso_or_date
from presslens.functions.text import url_host
from presslens.operators.aggregates import newest_per_source
from presslens.operators.filters import drop_stale_url_year, url_excludes
from presslens.operators.projections import materialize
from presslens.operators.joins import lookup_contains, lookup_equal, merge_state
from presslens.operators.windows import cap_per_group
from presslens.plans import sql as S
from presslens.sources.pages import origin
from presslens.sources.tables import events_view, table

def clamp_state(state: DataFrame, now: Column, hours: int = specs.LOOKBACK_HOURS) -> DataFrame:
    """DT-06: saved cutoffs never older than now - lookback."""
    return state.withColumn("cutoff", clamp_cutoff("cutoff", now, hours))


def sitemap_filter(entries: DataFrame, state: DataFrame, now: Column, order: str = "ord",
                   hours: int = specs.LOOKBACK_HOURS, xml_cap: int = specs.XML_CAP) -> DataFrame:
    """FLT-09/10/11 + WIN-06 over sitemap entries (loc, lastmod, ord).

    Excluded keywords drop; the cutoff is the first state domain contained in
    the entry's domain (state order), else now - lookback. With a lastmod the
    entry passes when it does not parse or is >= cutoff; without one, URLs
    with a past /YYYY/ drop, '.xml' sub-sitemaps pass at most ``xml_cap`` per
    domain in entry order, anything else passes.
    """
    default = now - F.expr(f"INTERVAL {int(hours)} HOURS")
    e = url_excludes(entries, "loc").withColumn("domain", F.replace(url_host("loc"), F.lit("www."), F.lit("")))
    e = lookup_contains(e, clamp_state(state, now, hours), "domain", "source", "cutoff", "state_ord",
                        default, out="cutoff")
    has_lm = F.col("lastmod").isNotNull() & (F.col("lastmod") != "")
    lm = parse_iso("lastmod")
    with_lm = e.filter(has_lm & (lm.isNull() | (lm >= F.col("cutoff"))))
    no_lm = drop_stale_url_year(e.filter(~has_lm), "loc", now)
    is_xml = F.lower("loc").endswith(".xml")
    xml = cap_per_group(no_lm.filter(is_xml), "domain", order, xml_cap)
    return with_lm.unionByName(no_lm.filter(~is_xml)).unionByName(xml).drop("cutoff")


def accept_articles(articles: DataFrame, state: DataFrame, now: Column,
                    hours: int = specs.LOOKBACK_HOURS) -> DataFrame:
    """FLT-12 + JOIN-05: parse the date (ISO, else first 20YY-MM-DD), drop what
    does not parse, keep dates strictly after the source's clamped cutoff."""
    default = now - F.expr(f"INTERVAL {int(hours)} HOURS")
    a = materialize(articles, "ts", parse_iso_or_date("date")).filter(F.col("ts").isNotNull())
    a = lookup_equal(a, clamp_state(state, now, hours), "source", "cutoff", default)
    return a.filter(F.col("ts") > F.col("cutoff")).drop("cutoff")


def next_state(state: DataFrame, accepted: DataFrame, now: Column, hours: int = specs.LOOKBACK_HOURS) -> DataFrame:
    """SNK-10: clamped saved cutoffs merged with the newest accepted per source."""
    return merge_state(clamp_state(state, now, hours), newest_per_source(accepted, "source", "ts"))


# --- bindings ----------------------------------------------------------------
SITEMAP_NOW = dt.datetime(2024, 1, 20, 0, 0, 0)
ARTICLE_NOW = dt.datetime(2024, 1, 25, 0, 0, 0)
PREVIOUS_RUN_END = dt.datetime(2024, 1, 24, 23, 0, 0)


def _sitemap_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as sitemap entries: lastmod from the event with the same id in
    several spellings (Z, naive, empty, junk); some locs become sub-sitemaps
    or dated paths."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("page_id"), F.col("ts").cast("timestamp").alias("ts"))
    j = p.join(e, "page_id", "left")
    pid, ts = F.col("page_id"), F.col("ts")
    lastmod = (F.when(pid % 11 == 1, F.concat(F.date_format(ts + F.expr("INTERVAL 3 HOURS"), "yyyy-MM-dd'T'HH:mm"), F.lit("+03:00")))
               .when(pid % 11 == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm'Z'"))
               .when(pid % 13 == 3, F.date_format(ts, "HH:mm"))
               .when(pid % 5 == 0, F.lit(""))
               .when(pid % 7 == 0, F.lit("yesterday"))
               .when(pid % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
               .when(pid % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
               .otherwise(F.lit(None)))
    loc = (F.when(pid % 4 == 0, F.concat(origin(F.col("url")), F.lit("/sitemap-"), pid.cast("string"), F.lit(".xml")))
           .when(pid % 6 == 1, F.concat(origin(F.col("url")), F.lit("/2023/"), pid.cast("string")))
           .otherwise(F.col("url")))
    return j.select(pid, pid.alias("ord"), loc.alias("loc"), lastmod.alias("lastmod"))


def _sitemap_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State derived from the pages: one registrable domain per row, saved
    cutoff spread by name length around the run's clock."""
    p = table(spark, sf_dir, "pages")
    dom = F.regexp_extract(url_host("url"), r"([^.]+\.example\.[a-z]+)$", 1)
    d = p.select(dom.alias("source")).filter(F.col("source") != "").distinct()
    cutoff = F.lit(SITEMAP_NOW - dt.timedelta(hours=12)) + F.make_dt_interval(hours=F.length("source"))
    return d.select("source", cutoff.alias("cutoff"), F.col("source").alias("state_ord"))


def sitemap_filter_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = sitemap_filter(_sitemap_entries(spark, sf_dir), _sitemap_state(spark, sf_dir), F.lit(SITEMAP_NOW))
    return kept.select("page_id", "loc", "domain")


def _event_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events_view(spark, sf_dir)
    v = F.col("event_id") % 7
    ts = F.col("date")
    date = (F.when(v == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(v == 1, F.concat(F.date_format(ts + F.expr("INTERVAL 3 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"),
                                   F.lit("+03:00")))
            .when(v == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
            .when(v == 3, F.concat(F.lit("published "), F.date_format(ts, "yyyy-MM-dd"), F.lit(" by staff")))
            .when(v == 4, F.concat(F.date_format(ts - F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm"), F.lit("-02:00")))
            .when(v == 5, F.date_format(ts, "HH:mm"))
            .otherwise(F.lit("yesterday")))
    return e.select("event_id", "source", date.alias("date"), F.col("date").alias("event_ts"))


def _previous_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved state = newest event per source before the previous run's end."""
    e = events_view(spark, sf_dir).filter(F.col("date") < F.lit(PREVIOUS_RUN_END))
    return e.groupBy("source").agg(F.max("date").alias("cutoff"))


def ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    acc = accept_articles(_event_articles(spark, sf_dir), _previous_state(spark, sf_dir), F.lit(ARTICLE_NOW))
    return acc.select("event_id", "source", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


def state_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit(ARTICLE_NOW)
    st = _previous_state(spark, sf_dir)
    acc = accept_articles(_event_articles(spark, sf_dir), st, now)
    return next_state(st, acc, now).select("source", F.date_format("cutoff", "yyyy-MM-dd HH:mm:ss").alias("cutoff"))


_HOST = "replace(replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), 'www.', ''), 'www.', '')"
_EXCL = " OR ".join(f"contains(lower(loc), {S.q(k)})" for k in specs.URL_EXCLUDE_KEYWORDS)
_ORIGIN = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"
_NOW = f"TIMESTAMP '{SITEMAP_NOW:%Y-%m-%d %H:%M:%S}'"
_ODD_LM = ("WHEN page_id % 11 = 1 THEN strftime(ts + INTERVAL 3 HOURS, '%Y-%m-%dT%H:%M') || '+03:00' "
           "WHEN page_id % 11 = 2 THEN strftime(ts, '%Y-%m-%dT%H:%MZ') WHEN page_id % 13 = 3 THEN strftime(ts, '%H:%M')")
_DOM = "regexp_extract(h, '([^.]+\\.example\\.[a-z]+)$', 1)"

register("sitemap_filter", f"""
WITH st AS (SELECT DISTINCT {_DOM} AS source FROM (SELECT {_HOST} AS h FROM pages) WHERE {_DOM} <> ''),
st2 AS (SELECT source, greatest({_NOW} - INTERVAL 12 HOURS + to_hours(length(source)), {_NOW} - INTERVAL 2 HOURS) AS cutoff FROM st),
p AS (SELECT p.page_id, p.url, CAST(e.ts AS TIMESTAMP) AS ts FROM pages p LEFT JOIN events e ON e.event_id = p.page_id),
en AS (SELECT page_id, page_id AS ord,
         CASE WHEN page_id % 4 = 0 THEN {_ORIGIN} || '/sitemap-' || CAST(page_id AS VARCHAR) || '.xml'
              WHEN page_id % 6 = 1 THEN {_ORIGIN} || '/2023/' || CAST(page_id AS VARCHAR) ELSE url END AS loc,
         CASE {_ODD_LM} WHEN page_id % 5 = 0 THEN '' WHEN page_id % 7 = 0 THEN 'yesterday'
              WHEN page_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
              WHEN page_id % 3 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS lastmod,
         CASE WHEN page_id % 11 IN (1, 2) THEN date_trunc('minute', ts) WHEN page_id % 13 = 3 THEN NULL
              WHEN page_id % 5 <> 0 AND page_id % 7 = 0 THEN NULL ELSE date_trunc('second', ts) END AS lm_ts FROM p),
e2 AS (SELECT *, replace(regexp_extract(loc, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), 'www.', '') AS domain
       FROM en WHERE NOT ({_EXCL})),
e3 AS (SELECT e2.*, coalesce((SELECT cutoff FROM st2 WHERE contains(e2.domain, st2.source) ORDER BY st2.source LIMIT 1),
                             {_NOW} - INTERVAL 2 HOURS) AS cutoff FROM e2),
y AS (SELECT *, TRY_CAST(nullif(regexp_extract(loc, '/([0-9]{{4}})/', 1), '') AS INTEGER) AS yr FROM e3),
k1 AS (SELECT page_id, loc, domain FROM y WHERE lastmod IS NOT NULL AND lastmod <> ''
         AND (lm_ts IS NULL OR lm_ts >= cutoff)),
nl AS (SELECT * FROM y WHERE (lastmod IS NULL OR lastmod = '') AND (yr IS NULL OR yr >= {SITEMAP_NOW.year})),
k2 AS (SELECT page_id, loc, domain FROM nl WHERE NOT ends_with(lower(loc), '.xml')),
k3 AS (SELECT page_id, loc, domain FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY ord) AS rn
                                         FROM nl WHERE ends_with(lower(loc), '.xml')) WHERE rn <= {specs.XML_CAP})
SELECT * FROM k1 UNION ALL SELECT * FROM k2 UNION ALL SELECT * FROM k3
""")(sitemap_filter_q)

_ANOW = f"TIMESTAMP '{ARTICLE_NOW:%Y-%m-%d %H:%M:%S}'"
_PREV = f"TIMESTAMP '{PREVIOUS_RUN_END:%Y-%m-%d %H:%M:%S}'"
_ACCEPT = f"""
WITH ev AS ({S.EVENTS}),
prev AS (SELECT source, greatest(max(date), {_ANOW} - INTERVAL 2 HOURS) AS cutoff FROM ev WHERE date < {_PREV} GROUP BY source),
a AS (SELECT event_id, source,
        CASE event_id % 7 WHEN 4 THEN date_trunc('minute', date) WHEN 0 THEN date_trunc('second', date) WHEN 1 THEN date_trunc('second', date)
             WHEN 2 THEN date_trunc('second', date) WHEN 3 THEN date_trunc('day', date) END AS ts FROM ev),
acc AS (SELECT a.event_id, a.source, a.ts FROM a LEFT JOIN prev ON a.source = prev.source
        WHERE a.ts IS NOT NULL AND a.ts > coalesce(prev.cutoff, {_ANOW} - INTERVAL 2 HOURS))
"""

register("ingest_incremental", _ACCEPT + "SELECT event_id, source, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM acc")(
    ingest_incremental)

register("state_merge", _ACCEPT + """,
nw AS (SELECT source, max(ts) AS newest FROM acc GROUP BY source)
SELECT coalesce(prev.source, nw.source) AS source,
       strftime(CASE WHEN prev.cutoff IS NULL THEN nw.newest WHEN nw.newest IS NULL THEN prev.cutoff
                     ELSE greatest(prev.cutoff, nw.newest) END, '%Y-%m-%d %H:%M:%S') AS cutoff
FROM prev FULL OUTER JOIN nw ON prev.source = nw.source
""")(state_merge)


def sitemap_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-13 over the page-derived sitemap entries, per domain."""
    from presslens.sources.sitemap import probe_sitemap
    e = _sitemap_entries(spark, sf_dir)
    e = e.withColumn("source", F.replace(url_host("loc"), F.lit("www."), F.lit("")))
    return probe_sitemap(e)


register("sitemap_probe", f"""
WITH p AS (SELECT p.page_id, p.url FROM pages p),
en AS (SELECT page_id AS ord,
         CASE WHEN page_id % 4 = 0 THEN {_ORIGIN} || '/sitemap-' || CAST(page_id AS VARCHAR) || '.xml'
              WHEN page_id % 6 = 1 THEN {_ORIGIN} || '/2023/' || CAST(page_id AS VARCHAR) ELSE url END AS loc FROM p),
e AS (SELECT *, replace(regexp_extract(loc, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), 'www.', '') AS source,
             ends_with(lower(loc), '.xml') AS sub FROM en),
a AS (SELECT source, min_by(loc, ord) AS loc FROM e WHERE NOT sub AND starts_with(loc, 'http') GROUP BY source),
s AS (SELECT source, min_by(loc, ord) AS loc FROM e WHERE sub GROUP BY source),
k AS (SELECT DISTINCT source FROM e)
SELECT k.source, coalesce(a.loc, s.loc) AS probe,
       CASE WHEN a.loc IS NOT NULL THEN 'article' WHEN s.loc IS NOT NULL THEN 'sitemap' END AS kind
FROM k LEFT JOIN a ON k.source = a.source LEFT JOIN s ON k.source = s.source
""")(sitemap_probe)


# --- SRC-09 listing URLs, SRC-08 sitemap scan ---------------------------------
LISTING_PAGES = (1, 799)


def listing_urls_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages for every host seen in the pages table, numbered like the
    archive crawl (pages 1..799), generated per host row without a join."""
    from presslens.sources.sitemap import listing_urls
    hosts = table(spark, sf_dir, "pages").select(url_host("url").alias("category")).distinct()
    return listing_urls(hosts, *LISTING_PAGES, template="https://%s/archive?page=%d")


def sitemap_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages published as a sitemap XML (loc, lastmod from the page's event),
    then read back through the XML source."""
    from presslens.session import shared_dir
    from presslens.sources.sitemap import read_sitemap
    e = _sitemap_entries(spark, sf_dir)
    path = shared_dir(spark, "sitemap")
    (e.select("loc", F.when(F.col("lastmod") != "", F.col("lastmod")).alias("lastmod"))
      .write.format("xml").option("rootTag", "urlset").option("rowTag", "url").save(path))
    return read_sitemap(spark, path, "url").select("loc", "lastmod")


register("listing_urls", f"""
SELECT h.category, CAST(r.page AS INTEGER) AS page, 'https://' || h.category || '/archive?page=' || CAST(r.page AS VARCHAR) AS url
FROM (SELECT DISTINCT {_HOST} AS category FROM pages) h, range({LISTING_PAGES[0]}, {LISTING_PAGES[1] + 1}) r(page)
""")(listing_urls_q)

register("sitemap_scan", f"""
WITH p AS (SELECT p.page_id, p.url, CAST(e.ts AS TIMESTAMP) AS ts FROM pages p LEFT JOIN events e ON e.event_id = p.page_id)
SELECT CASE WHEN page_id % 4 = 0 THEN {_ORIGIN} || '/sitemap-' || CAST(page_id AS VARCHAR) || '.xml'
            WHEN page_id % 6 = 1 THEN {_ORIGIN} || '/2023/' || CAST(page_id AS VARCHAR) ELSE url END AS loc,
       CASE {_ODD_LM} WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 7 = 0 THEN 'yesterday'
            WHEN page_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
            WHEN page_id % 3 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS lastmod
FROM p
""")(sitemap_scan)
