"""Sinks (SNK-01, 03, 04, 06, 09, 11). Writers are partitioned Spark writes;
nothing is funnelled through the driver or a single task. JSON arrays and 'split'
documents (SNK-05/07) are written as so many files as asked, each one a whole document, and as more where
these would get large: one document needs one writer, a table of any size needs several."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslens.functions.dates import from_epoch_ms, to_epoch_ms
from presslens.operators.store import KeyedStore
from presslens.session import MOST_SHUFFLE_PARTITIONS
from presslens.streaming.source import encode

DOCUMENT_BYTES = 64 * 1024 * 1024  # of a JSON document, before another one is begun


def _ms_dates(df: DataFrame, date: str = "date") -> DataFrame:
    if date in df.columns and dict(df.dtypes)[date].startswith("timestamp"):
        return df.withColumn(date, to_epoch_ms(date))
    return df


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", date: str = "date") -> None:
    """SNK-03/04: JSON lines, UTF-8 kept, dates as epoch milliseconds;
    ``mode='append'`` adds files next to the existing ones."""
    _ms_dates(df, date).write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-06: CSV with header; quotes escaped by doubling, multi-line safe."""
    (df.write.mode(mode).option("header", True).option("escape", '"').option("quoteAll", False)
     .csv(path))


def _documents(df: DataFrame, value: Column, key: str, files: int, most: int, head: str, tail: str, path: str) -> None:
    """One text line a row, dealt to documents by the hash of ``key`` and in its order; the first line of a
    document opens it, the last one closes it. ``files`` documents, or more where one would get over ``most`` bytes: a
    document has one writer, so their number, not their size, grows with the table."""
    rows = df.select(F.col(key).alias("__k"), value.alias("__v"))
    size = rows.agg(F.sum(F.octet_length("__v") + 2)).first()[0] or 0  # with a separator and a line end
    files = max(files, -(-size // most))
    own = Window.partitionBy("part")
    at = F.row_number().over(own.orderBy("__k"))
    line = F.concat(F.when(at == 1, F.lit(head)).otherwise(F.lit("")), "__v", F.when(
        at == F.count(F.lit(1)).over(own), F.lit(tail)).otherwise(F.lit(",")))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("__k"), F.lit(files))).repartition(min(files, MOST_SHUFFLE_PARTITIONS), "part")
    (dealt.select("part", "__k", line.alias("value")).sortWithinPartitions("part", "__k").drop("__k")
     .write.partitionBy("part").text(path))


def write_json_arrays(df: DataFrame, path: str, key: str, files: int = 1, most: int = DOCUMENT_BYTES) -> None:
    """SNK-05: arrays of records, ``files`` of them, or more of about ``most`` bytes (``key``, which is unique, orders each)."""
    _documents(df, F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), key, files, most, "[", "]", path)


def write_split_json(df: DataFrame, path: str, key: str, files: int = 1, most: int = DOCUMENT_BYTES) -> None:
    """SNK-07: documents in split orient, ``files`` of them, or more of about ``most`` bytes: column names, then the rows as arrays."""
    names = json.dumps(list(df.columns), ensure_ascii=False)
    value = lambda c: F.regexp_replace(F.to_json(F.struct(F.col(c).alias("v")), {"ignoreNullFields": "false"}), r'^\{"v":|\}$', "")
    row = F.concat(F.lit("["), F.concat_ws(",", *[value(c) for c in df.columns]), F.lit("]"))
    _documents(df, row, key, files, most, f'{{"columns":{names},"data":[', "]}", path)


def publish_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """SNK-01: rows as JSON values on a Kafka topic (needs the connector)."""
    encode(df).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def load_feed(spark: SparkSession, jsonl_path: str, store: KeyedStore, schema) -> int:
    """SNK-09: feed file (epoch-ms dates) -> timestamps -> keyed append."""
    from presslens.functions.text import doc_key
    df = spark.read.schema(schema).json(jsonl_path)
    if "date" in df.columns:
        df = df.withColumn("date", from_epoch_ms("date"))
    return store.upsert(df.withColumn("_id", doc_key("url")))


def array_to_jsonl(spark: SparkSession, src: str, dst: str, schema, require: str = "source") -> None:
    """SNK-11: JSON-array file -> JSON lines, keeping rows that have ``require``
    (arrays stay arrays, so sets need no conversion)."""
    from presslens.sources.json_arrays import read_json_array
    read_json_array(spark, src, schema).filter(F.col(require).isNotNull()).write.mode("overwrite").json(dst)
