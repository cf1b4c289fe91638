"""Raw page bindings: h1 titles (regex), article extraction (rules + parser,
rows-only), link harvest (SRC-10..12, JOIN-09, FLT-17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens import specs
from presslens.catalog import register
from presslens.functions.text import url_host
from presslens.operators.filters import min_length, quality_flags, require_nonempty
from presslens.plans import sql as S
from presslens.sources.pages import ENTITIES, extract_articles, h1_title, harvest_links
from presslens.sources.tables import table


def page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", url_host("url").alias("host"), h1_title(F.col("html")).alias("title"))


def page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction with the per-host rules (+ the generic article rule), then
    the quality gate (FLT-16) and the length filter (FLT-02)."""
    pages = table(spark, sf_dir, "pages")
    arts = require_nonempty(extract_articles(pages).filter(F.col("rule").isNotNull()), ("title", "text"))
    q = quality_flags(arts)
    return min_length(q, "text", specs.MIN_TEXT_CHARS).select(
        "page_id", "source", "rule", "title", "date", F.length("text").alias("n_chars"),
        F.md5("text").alias("text_md5"), "title_check", "text_check")


def quality_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-19: per source, how many extracted pages pass each check."""
    arts = quality_flags(extract_articles(table(spark, sf_dir, "pages")).filter(F.col("rule").isNotNull()))
    return arts.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.count_if(F.col("title_check") == "OK").alias("title_ok"),
        F.count_if(F.col("date_check") == "OK").alias("date_ok"),
        F.count_if(F.col("text_check") == "OK").alias("text_ok"),
        F.count_if(F.col("text_check") == "TOO SHORT").alias("text_short"))


def link_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the <nav> (the articles of these pages hold none), in several relative spellings."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    to = F.element_at(F.array(*map(F.lit, ("/", "../", "./", "./a/../"))), (F.col("page_id") % 4 + 1).cast("int"))
    html = F.replace(F.replace(F.col("html"), F.lit('href="/'), F.concat(F.lit("href='"), to)), F.lit('">'), F.lit("'>"))
    return harvest_links(p.withColumn("html", html), "nav").select("page_id", "href", "link")


def _unescape_sql(e: str) -> str:
    for k, v in ENTITIES:
        e = f"replace({e}, {S.q(k)}, {S.q(v)})"
    return e


_TITLE_SQL = (f"nullif({S.strip(f'''regexp_replace({_unescape_sql("regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g')")}, {S.q(specs.WS)} || '+', ' ', 'g')''')}, '')")
_HOST = "replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), 'www.', '')"

register("page_title", f"SELECT page_id, {_HOST} AS host, {_TITLE_SQL} AS title FROM pages")(page_title)

# all text of the article but its heading, tags dropped, entities decoded, white space collapsed
_INNER = "regexp_extract(html, '(?is)<article[^>]*>(.*)</article>', 1)"
_BODY = f"regexp_replace(regexp_replace({_INNER}, '(?is)<h1[^>]*>.*?</h1>', ' ', 'g'), '<[^>]*>', ' ', 'g')"
_ONE_LINE = f"regexp_replace({_unescape_sql(_BODY)}, {S.q(specs.WS)} || '+', ' ', 'g')"
_TEXT = f"nullif({S.strip(_ONE_LINE)}, '')"
_EXTRACTED = f"SELECT page_id, {_HOST} AS source, {_TITLE_SQL} AS title, {_TEXT} AS body FROM pages"

register("page_articles", f"""
WITH a AS ({_EXTRACTED})
SELECT page_id, source, '' AS rule, title, '' AS date, CAST(length(body) AS INTEGER) AS n_chars, md5(body) AS text_md5,
       'OK' AS title_check, 'OK' AS text_check
FROM a WHERE title IS NOT NULL AND length(body) > {specs.MIN_TEXT_CHARS}
""")(page_articles)

register("quality_rollup", f"""
WITH a AS ({_EXTRACTED})
SELECT source, count(*) AS n_pages, count(title) AS title_ok, CAST(0 AS BIGINT) AS date_ok,
       count(*) FILTER (WHERE length(body) > {specs.MIN_TEXT_CHARS}) AS text_ok,
       count(*) FILTER (WHERE length(body) <= {specs.MIN_TEXT_CHARS}) AS text_short
FROM a GROUP BY source
""")(quality_rollup)

# links of the driver's pages are root-relative and stand in the <nav>; the binding spells some of them
# relative to the page
_PARENT = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]+/[^/]*$', '')"
_DIR = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '')"
register("link_harvest", f"""
WITH l AS (SELECT DISTINCT page_id, url, unnest(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1), '"/([^"]*)"', 1)) AS name
           FROM pages)
SELECT page_id, CASE page_id % 4 WHEN 0 THEN '/' WHEN 1 THEN '../' WHEN 2 THEN './' ELSE './a/../' END || name AS href,
       CASE page_id % 4 WHEN 0 THEN regexp_extract(url, '^[a-z]+://[^/]+', 0) || '/' WHEN 1 THEN {_PARENT} ELSE {_DIR} END || name AS link
FROM l
""")(link_harvest)
