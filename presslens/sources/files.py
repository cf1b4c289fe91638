"""File sources: tolerant JSONL, strict array-or-lines, split JSON, guarded scans,
nested lookup files (SRC-03..07, SRC-14/15). Arrays and split documents are read in splits
(``sources/json_arrays.py``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.sources.json_arrays import read_json_array, read_split_rows

CORRUPT = "_corrupt_record"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return False
    return fs.getContentSummary(p).getLength() > 0


def read_jsonl_tolerant(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC-03: JSON lines; blank and malformed lines are skipped, while a
    well-formed line whose values do not fit the schema is kept with nulls
    there. Top-level primitives are read as strings (never a mismatch) and
    cast with try_cast afterwards."""
    prim = (T.StringType, T.NumericType, T.BooleanType, T.TimestampType, T.DateType)
    wide = [T.StructField(f.name, T.StringType()) if isinstance(f.dataType, prim) else f for f in schema.fields]
    sch = T.StructType(wide + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", sch, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    ok = (spark.read.text(path).filter(F.trim("value") != "").select(parsed.alias("r")).select("r.*")
          .filter(F.col(CORRUPT).isNull()))
    return ok.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) if isinstance(f.dataType, prim)
                       else F.col(f.name) for f in schema.fields])


def read_json_auto(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC-04: a JSON array file or JSON lines, detected from the first
    non-blank character; strict (malformed input fails the job)."""
    first = (spark.read.text(path).select(F.ltrim(F.col("value")).alias("v"))
             .filter(F.col("v") != "").limit(1).collect())
    if first and first[0]["v"].startswith("["):
        return read_json_array(spark, path, schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_split_json(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """SRC-05: pandas 'split' orient ``{columns: [...], data: [[...], ...]}``;
    every value is read as a string (cast downstream)."""
    rows = read_split_rows(spark, path)
    return rows.select(*[F.get("row", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def guarded(spark: SparkSession, path: str, schema: T.StructType, reader) -> DataFrame:
    """SRC-07: missing or empty input -> empty frame with the schema (downstream no-op)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return reader(spark, path, schema)


def read_lookup(spark: SparkSession, path: str, array_field: str, element: str) -> DataFrame:
    """SRC-15: nested lookup file ``{array_field: [ {...}, ... ]}`` -> rows."""
    raw = spark.read.option("multiLine", True).schema(f"{array_field} array<struct<{element}>>").json(path)
    return raw.select(F.explode(array_field).alias("x")).select("x.*")
