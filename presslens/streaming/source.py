"""Stream sources and payload decoding (SRC-01/02, STM-01)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.schemas import RAW_ARTICLE


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """SRC-01: Kafka topic as a stream of ``value`` bytes (needs the Kafka
    connector on the classpath; tests use ``file_stream`` with the same shape)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting).load())


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines files as a stream of ``value`` strings (Kafka-value stand-in)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def decode(stream: DataFrame, schema: T.StructType = RAW_ARTICLE) -> DataFrame:
    """SRC-02 / STM-01: value -> string -> typed article columns; the wire date
    (epoch ms) becomes a timestamp. Malformed payloads give all-null rows,
    which are quarantined by dropping rows without url and title (Q4)."""
    parsed = stream.select(F.from_json(F.col("value").cast("string"), schema).alias("a")).select("a.*")
    if "date" in parsed.columns and dict(parsed.dtypes)["date"] == "bigint":
        parsed = parsed.withColumn("date", F.timestamp_millis("date"))
    return parsed.filter(F.col("url").isNotNull() | F.col("title").isNotNull())


def encode(df: DataFrame, *keep: str) -> DataFrame:
    """SNK-01 shape: one JSON ``value`` per row (dates as epoch ms), beside the ``keep`` columns."""
    out = df
    if "date" in df.columns and dict(df.dtypes)["date"].startswith("timestamp"):
        out = out.withColumn("date", F.unix_millis(F.col("date").cast("timestamp")))
    own = [F.col(c) for c in out.columns if c not in keep]
    return out.select(*keep, F.to_json(F.struct(*own)).alias("value"))
