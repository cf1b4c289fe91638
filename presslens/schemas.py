"""Fixed schemas (FIXTURES F1, F2, F5, F8)."""

from pyspark.sql import types as T

RAW_ARTICLE = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("date", T.LongType()),      # epoch milliseconds on the wire
    T.StructField("text", T.StringType()),
])

SCRAPED_ARTICLE = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("date", T.StringType()),    # ISO text as scraped
    T.StructField("text", T.StringType()),
])

LABEL = T.StructType([
    T.StructField("reasoning", T.StringType()),
    T.StructField("primary_entities", T.ArrayType(T.StringType())),
    T.StructField("bias", T.DoubleType()),
    T.StructField("error", T.StringType()),
])

SINK_DOCUMENT = T.StructType([
    T.StructField("_id", T.StringType(), False),
    T.StructField("source", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("date", T.TimestampType()),
    T.StructField("content", T.StringType()),
    T.StructField("ai_labels", LABEL),
])
