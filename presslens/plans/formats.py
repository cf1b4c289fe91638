"""Formats written and read back (SRC-03, 04, 06, SNK-03, 06), and operators that have
no other binding: year filter (FLT-04), centre band (FLT-06), unfinished predictions (FLT-15),
extracted pages (FLT-17), item cap (SRT-03), label flatten (PRJ-02)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.catalog import register
from presslens.operators.filters import extracted_only, pending_predictions, score_between, year_in
from presslens.operators.projections import flatten_labels
from presslens.operators.sinks import write_csv, write_jsonl
from presslens.operators.sort import cap_rows
from presslens.plans import sql as S
from presslens.session import shared_dir
from presslens.sources.files import read_json_auto, read_jsonl_tolerant
from presslens.sources.tables import articles, events_view, table

ARTICLE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()),
                        T.StructField("text", T.StringType())])


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", "text")


def _shown(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "source", F.md5("text").alias("text_md5"))


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "jsonl")
    write_jsonl(_docs(spark, sf_dir), path)
    return _shown(read_jsonl_tolerant(spark, path, ARTICLE))


def json_auto_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "json-auto")
    write_jsonl(_docs(spark, sf_dir), path)
    return _shown(read_json_auto(spark, path, ARTICLE))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "csv")
    write_csv(_docs(spark, sf_dir), path)
    back = spark.read.schema(ARTICLE).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return _shown(back)


_BACK = "SELECT doc_id, source, md5(text) AS text_md5 FROM documents"
register("jsonl_roundtrip", _BACK)(jsonl_roundtrip)
register("json_auto_roundtrip", _BACK)(json_auto_roundtrip)
register("csv_roundtrip", _BACK)(csv_roundtrip)


def events_of_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return year_in(events_view(spark, sf_dir), "date", (2023, 2024)).select("event_id", "source")


register("events_of_years", f"SELECT event_id, source FROM ({S.EVENTS}) WHERE year(date) IN (2023, 2024)")(events_of_years)


def centre_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_between(events_view(spark, sf_dir), "score", 0.4, 0.6).select("event_id", F.round("score", 6).alias("score"))


register("centre_band", f"SELECT event_id, round(score, 6) AS score FROM ({S.EVENTS}) WHERE score BETWEEN 0.4 AND 0.6")(centre_band)


def unfinished_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models: one is done with the documents labelled for quality, one with the toxic ones."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").isNotNull().alias("a_done"), (F.col("toxic") == 1).alias("b_done"))
    d = table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left")
    return pending_predictions(d, ("a", "b")).select("doc_id")


register("unfinished_predictions", """
SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels WHERE quality IS NOT NULL AND toxic = 1
""")(unfinished_predictions)


def dated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of hosts with a rule (all but the mobile ones) whose event gives a date."""
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("page_id"), F.col("ts").cast("string").alias("date"))
    p = table(spark, sf_dir, "pages").select("page_id", "url").join(e, "page_id", "left")
    rule = F.when(~F.col("url").contains("://m."), F.lit(""))
    return extracted_only(p.withColumn("rule", rule).withColumn("date", F.when(F.col("page_id") % 3 > 0, F.col("date")).otherwise(F.lit("")))).select("page_id")


register("dated_pages", """
SELECT page_id FROM pages p JOIN events e ON e.event_id = p.page_id
WHERE NOT contains(url, '://m.') AND page_id % 3 > 0 AND e.ts IS NOT NULL
""")(dated_pages)

ITEM_CAP = 100


def item_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    return cap_rows(p, ITEM_CAP, [F.col("url").asc(), F.col("page_id").asc()])


register("item_cap", f"SELECT page_id, url FROM pages ORDER BY url, page_id LIMIT {ITEM_CAP}")(item_cap)


def flat_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles(spark, sf_dir).select("doc_id", F.struct(
        F.col("title").alias("reasoning"), F.array("source", "lang").alias("primary_entities"), F.col("score").alias("bias")).alias("ai_labels"))
    f = flatten_labels(a, synthetic=False)
    return f.select("doc_id", "bias", "reasoning", F.array_join("primary_entities", ",").alias("entities"), "is_synthetic")


register("flat_labels", f"""
WITH a AS ({S.ARTICLES})
SELECT doc_id, score AS bias, title AS reasoning, source || ',' || lang AS entities, false AS is_synthetic FROM a
""")(flat_labels)
