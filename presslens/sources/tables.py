"""Driver tables and the article/event views bound to them.

Views are lazy projections over the parquet scans, so Catalyst prunes the
columns a query does not use and pushes its filters into the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions.text import first_line

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def synthetic_score(key: str, mult: int, add: int = 0):
    """Deterministic stand-in label: ((key*mult + add) % 101) / 100 as double."""
    return ((F.col(key) * mult + add) % 101).cast("double") / F.lit(100.0)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article view A over ``documents``.

    _id = md5(doc_id), url = 'doc/<id>', title = first line, score and a second
    rater's score from fixed formulas, ``ord`` = doc_id (input order).
    """
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.md5(F.col("doc_id").cast("string")).alias("_id"),
        F.col("doc_id"),
        F.col("doc_id").alias("ord"),
        F.col("source"),
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"),
        first_line("text").alias("title"),
        F.col("text"),
        F.col("lang"),
        synthetic_score("doc_id", 37).alias("score"),
        synthetic_score("doc_id", 53, 11).alias("score_b"),
    )


def events_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event view E over ``events``: source = event_type, date = ts (UTC timestamp),
    score = least(value/100, 1)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id"),
        F.col("event_id").alias("ord"),
        F.md5(F.concat(F.lit("event/"), F.col("event_id").cast("string"))).alias("_id"),
        F.col("event_type").alias("source"),
        F.concat(F.lit("event/"), F.col("event_id").cast("string")).alias("url"),
        F.concat_ws(" ", F.col("event_type"), F.col("user_id").cast("string")).alias("title"),
        F.col("ts").cast("timestamp").alias("date"),
        F.col("user_id"),
        F.least(F.col("value") / F.lit(100.0), F.lit(1.0)).alias("score"),
        F.col("props"),
    )
