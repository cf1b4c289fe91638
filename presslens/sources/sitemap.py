"""Sitemap sources (SRC-08, SRC-09, SRC-13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions.text import url_host


def read_sitemap(spark: SparkSession, path: str, row_tag: str = "sitemap") -> DataFrame:
    """SRC-08: sitemap or sitemap index (``row_tag`` = 'sitemap' or 'url') with
    the built-in XML source; ``lastmod`` is null when the file has none. Each
    entry keeps its position (``ord``) for encounter-order rules."""
    # explicit string schema: lastmod stays as written (unparseable values
    # must pass the filter), and a file without lastmod still has the column
    df = (spark.read.format("xml").option("rowTag", row_tag).schema("loc string, lastmod string")
          .load(path))
    return df.select("loc", "lastmod", F.monotonically_increasing_id().alias("ord"))


def listing_urls(categories: DataFrame, first: int, last: int, template: str = "%s?page=%d",
                 col: str = "category") -> DataFrame:
    """SRC-09: listing-page URLs, one per (category, page number); the page
    range is generated per row with ``sequence`` (no join)."""
    return categories.select(col, F.explode(F.sequence(F.lit(first), F.lit(last))).alias("page")).select(
        col, "page", F.format_string(template, F.col(col), F.col("page")).alias("url"))


def probe_sitemap(entries: DataFrame, source: str = "source", order: str = "ord") -> DataFrame:
    """SRC-13: per source, the first entry that is not a sub-sitemap and starts
    with 'http'; else the first sub-sitemap. One aggregate (min of (order, loc)
    per kind), so a source with many entries is reduced map-side."""
    loc = F.col("loc")
    is_sub = F.lower(loc).endswith(".xml")
    art = F.min(F.when(~is_sub & loc.startswith("http"), F.struct(F.col(order), loc)))
    sub = F.min(F.when(is_sub, F.struct(F.col(order), loc)))
    g = entries.groupBy(source).agg(art.alias("a"), sub.alias("s"))
    return g.select(source, F.coalesce(F.col("a.loc"), F.col("s.loc")).alias("probe"),
                    F.when(F.col("a").isNotNull(), "article").when(F.col("s").isNotNull(), "sitemap").alias("kind"))
