"""JSON documents written and read in splits (SNK-05, SNK-07, SNK-11, SRC-04..06), and a feed file
loaded into the store (SNK-09, SRC-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.catalog import register
from presslens.operators.sinks import array_to_jsonl, load_feed, write_json_arrays, write_jsonl, write_split_json
from presslens.operators.store import KeyedStore
from presslens.plans.formats import ARTICLE, _BACK, _docs, _shown
from presslens.session import shared_dir
from presslens.sources.files import read_json_auto, read_split_json
from presslens.sources.tables import articles

FILES = 2  # at least; the writers add documents with the size of the table


def json_array_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "json-arrays")
    write_json_arrays(_docs(spark, sf_dir), path, "doc_id", FILES)
    return _shown(read_json_auto(spark, path, ARTICLE))


def split_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "split-json")
    write_split_json(_docs(spark, sf_dir), path, "doc_id", FILES)
    back = read_split_json(spark, path, ["doc_id", "source", "text"])
    return _shown(back.withColumn("doc_id", F.col("doc_id").cast("bigint")))


def array_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-11: an array converted to lines; records without a source are left behind."""
    src, dst = shared_dir(spark, "array"), shared_dir(spark, "array-lines")
    docs = _docs(spark, sf_dir).withColumn("source", F.when(F.col("doc_id") % 7 > 0, F.col("source")))
    write_json_arrays(docs, src, "doc_id", FILES)
    array_to_jsonl(spark, src, dst, ARTICLE)
    return _shown(spark.read.schema(ARTICLE).json(dst))


def sample_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-09: a feed file of JSON lines (dates in epoch milliseconds), loaded into the store by key, twice."""
    root = shared_dir(spark, "sample-load")
    feed = articles(spark, sf_dir).select("source", "url", "title", F.timestamp_millis(F.col("doc_id") * 60000).alias("date"))
    write_jsonl(feed, f"{root}/feed")
    store = KeyedStore(spark, f"{root}/store")
    for _ in range(2):
        load_feed(spark, f"{root}/feed", store, "source string, url string, title string, date bigint")
    return store.read().select("_id", "source", "title", F.unix_millis("date").alias("date_ms"))


register("json_array_roundtrip", _BACK)(json_array_roundtrip)
register("split_json_roundtrip", _BACK)(split_json_roundtrip)
register("array_lines", "SELECT doc_id, source, md5(text) AS text_md5 FROM documents WHERE doc_id % 7 > 0 AND source IS NOT NULL")(array_lines)
register("sample_load", """
SELECT md5('doc/' || CAST(doc_id AS VARCHAR)) AS _id, source, split_part(text, chr(10), 1) AS title,
       CAST(doc_id * 60000 AS BIGINT) AS date_ms FROM documents
""")(sample_load)
