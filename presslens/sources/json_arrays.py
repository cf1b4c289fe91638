"""JSON documents too large for one task (SRC-04..06): arrays of records, read in splits.

Spark's multi-line reader gives a whole file to one task as one value. Here a file is cut at a separator
character by the (splittable) text reader, and the borders of records are found from running
sums: the number of quotes before a piece tells whether it starts inside a string, then the
brackets outside strings tell its depth. Both are sums inside a split (a window) plus the totals of the
splits before it (a row a split), so no task reads more than its split and no row holds more
than a record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.session import shared_dir

_QUOTED = r'"[^"]*("|$)'
_TAIL = r'^[^"]*("|$)'  # the rest of a string that began before the piece


def _pieces(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(file, split, row, value, quotes, out, inn): the text between separators in order, its quotes, and how much
    deeper it leads if it starts outside a string, or inside one."""
    raw = spark.read.option("lineSep", sep).text(path).select(
        "value", F.input_file_name().alias("file"), F.input_file_block_start().alias("split"), F.monotonically_increasing_id().alias("row"))
    plain = F.regexp_replace("value", r"(?s)\\.", "")  # an escaped character is neither quote nor bracket
    deeper = lambda c: F.regexp_count(c, F.lit(r"[\[{]")) - F.regexp_count(c, F.lit(r"[\]}]"))
    raw = raw.withColumn("plain", plain).select(
        "file", "split", "row", "value", F.regexp_count("plain", F.lit('"')).alias("quotes"),
        deeper(F.regexp_replace("plain", _QUOTED, "")).alias("out"),
        deeper(F.regexp_replace(F.regexp_replace("plain", _TAIL, ""), _QUOTED, "")).alias("inn"))
    path = shared_dir(spark, "json-pieces")  # once, so that all later steps see the same splits
    raw.write.parquet(path)
    return spark.read.schema(raw.schema).parquet(path)


def _before(totals: DataFrame, value: str, out: str) -> DataFrame:
    """(file, split, out): the sum of ``value`` in the file's earlier splits (a row a split)."""
    order = Window.partitionBy("file").orderBy("split")
    return totals.select("file", "split", (F.sum(value).over(order) - F.col(value)).alias(out))


def json_records(spark: SparkSession, path: str, sep: str = "}", level: int = 1) -> DataFrame:
    """(file, rec, value, level_from, level_to, whole): the elements of the arrays at depth ``level`` as texts.

    ``sep`` is ``}`` for arrays of objects (an element ends where one closes at the level) or ``,`` for any
    elements (one ends at a comma at the level or above). ``level_from`` and ``level_to`` are the depths at which
    the text starts and ends; it holds what opens and closes the arrays around it. ``whole`` is false for what follows the
    last border of a file.
    """
    comma = sep == ","
    pieces = _pieces(spark, path, sep)
    here = Window.partitionBy("file", "split").orderBy("row")
    totals = pieces.groupBy("file", "split").agg(F.sum("quotes").alias("n"))
    final = totals.groupBy("file").agg(F.max("split").alias("final"))
    starts = _before(totals, "n", "quotes_before").join(final, "file")
    t = pieces.join(starts, ["file", "split"])
    run = F.col("quotes_before") + F.sum("quotes").over(here)
    t = t.withColumn("odd", (run - F.col("quotes")) % 2 == 1).withColumn("open", run % 2 == 1)  # in a string before, after
    eof = (F.col("split") == F.col("final")) & F.lead("row").over(here).isNull()  # no separator behind this one
    closes = F.lit(0) if comma else F.when(F.col("open") | eof, 0).otherwise(1)
    t = t.withColumn("net", F.when(F.col("odd"), F.col("inn")).otherwise(F.col("out")) - closes)
    depth = _before(t.groupBy("file", "split").agg(F.sum("net").alias("n")), "n", "depth_before")
    t = t.join(depth, ["file", "split"]).withColumn("depth", F.col("depth_before") + F.sum("net").over(here))
    ends = ~F.col("open") & ((F.col("depth") <= level) if comma else (F.col("depth") == level))
    t = t.withColumn("end", F.when(ends, 1).otherwise(0))
    counted = _before(t.groupBy("file", "split").agg(F.sum("end").alias("n")), "n", "recs_before")
    t = t.join(counted, ["file", "split"]).withColumn("rec", F.col("recs_before") + F.sum("end").over(here) - F.col("end"))
    one = t.groupBy("file", "rec").agg(F.array_sort(F.collect_list(F.struct("split", "row", "value", "depth", "net"))).alias("p"),
                                       F.max("end").alias("end"))
    last = F.element_at("p", -1)
    text = F.array_join(F.col("p.value"), sep)
    text = text if comma else F.concat(text, F.when(F.col("end") == 1, F.lit(sep)).otherwise(F.lit("")))
    return one.select("file", "rec", text.alias("value"), (F.col("p")[0]["depth"] - F.col("p")[0]["net"]).cast("int").alias("level_from"),
                      last["depth"].cast("int").alias("level_to"), (F.col("end") == 1).alias("whole"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Arrays of objects, any number of tasks a file. Strict: a record that does not parse, or a file that ends
    within one, fails the job."""
    found = json_records(spark, path)
    rest = F.col("value").rlike(r"^\s*(\[\s*\]|\])?\s*$")  # what stands behind the last record, or an empty array
    bad = F.when(~F.col("whole") & ~rest, F.raise_error(F.concat(F.lit("unfinished record in "), F.col("file"))).cast("string"))
    text = F.regexp_replace(F.coalesce(bad, F.col("value")), r"^[\s,\[]+", "")
    return (found.filter(F.col("whole") | ~rest).select(F.from_json(text, schema, {"mode": "FAILFAST"}).alias("r")).select("r.*"))


def read_split_rows(spark: SparkSession, path: str) -> DataFrame:
    """``row array<string>`` of documents in split orient (``{columns: [...], index: [...], data: [[...], ...]}``):
    the elements of the arrays at depth 2 that are arrays themselves."""
    found = json_records(spark, path, ",", 2)
    name = r'^\s*\{?\s*"(?:[^"\\]|\\.)*"\s*:\s*\['
    text = F.when(F.col("level_from") < 2, F.regexp_replace("value", name, "")).otherwise(F.col("value"))
    text = F.when(F.col("level_to") < 2, F.regexp_replace(text, r"\s*\]\s*\}?\s*$", "")).otherwise(text)
    text = F.trim(F.regexp_replace(text, r"^\s+|\s+$", ""))
    return found.select(text.alias("t")).filter(F.col("t").startswith("[")).select(F.from_json("t", "array<string>").alias("row"))
