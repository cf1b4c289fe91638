"""URL rules over raw pages: host roll-up (STR-08), keyword and stale-year
filters (FLT-09, FLT-11), year extraction (STR-09)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens import specs
from presslens.catalog import register
from presslens.functions.text import url_host, url_year
from presslens.operators.filters import drop_stale_url_year, url_excludes
from presslens.plans import sql as S
from presslens.sources.tables import table

# The run's clock is a parameter (never the wall clock) so results replay.
NOW = dt.datetime(2026, 5, 1, 12, 0, 0)


def host_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return p.groupBy(url_host("url").alias("host")).agg(F.count(F.lit(1)).alias("n_pages"))


def url_year_filter(spark: SparkSession, sf_dir: str, now: dt.datetime = NOW) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    kept = drop_stale_url_year(url_excludes(p, "url"), "url", F.lit(now))
    return kept.select("page_id", "url", url_host("url").alias("host"), url_year("url").alias("url_year"))


_HOST = "replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), 'www.', '')"
_YEAR = "TRY_CAST(nullif(regexp_extract(url, '/([0-9]{4})/', 1), '') AS INTEGER)"
_EXCL = " OR ".join(f"contains(lower(url), {S.q(k)})" for k in specs.URL_EXCLUDE_KEYWORDS)

register("host_rollup", f"""
SELECT {_HOST} AS host, count(*) AS n_pages FROM pages GROUP BY 1
""")(host_rollup)

register("url_year_filter", f"""
SELECT page_id, url, {_HOST} AS host, {_YEAR} AS url_year FROM pages
WHERE NOT ({_EXCL}) AND ({_YEAR} IS NULL OR {_YEAR} >= {NOW.year})
""")(url_year_filter)


# FLT-08 topic routing: rules are regex alternatives over the URL (data).
TOPIC_PATTERNS = [r"\.example\.com/en/", r"blog\.[a-z]+\.example\.net/", r"/fr/[0-9]+\?page="]


def url_topic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslens.operators.filters import url_matches
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_matches(p, "url", TOPIC_PATTERNS)


register("url_topic_filter", f"""
SELECT page_id, url FROM pages
WHERE regexp_matches(url, {S.q("|".join(f"(?:{p})" for p in TOPIC_PATTERNS))})
""")(url_topic_filter)
