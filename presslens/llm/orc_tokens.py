"""Token ids in ORC files.

Documents are dealt to shards by ranges of doc_id and sorted; each shard is one
ORC file of rows (shard, doc_id, at, n_tokens, ids): ``at`` counts the shard's ids before the document.
ORC run-length encodes the integers, keeps a row index in every stripe and, as asked for here, a
Bloom filter on doc_id in it: tasks read stripes in parallel, and a search by id reads
only the stripes and row groups that can hold it.

Defined cases: null and empty texts have the end id alone; a very long text is one row of its file, encoded whole;
rows without a doc_id come first; repeated ids keep all their rows, in the order of a hash of the text; an
empty table gives no rows; columns other than doc_id and text are left out.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslens.llm.common import partitions
from presslens.llm.tokens import definition, encoder

END_ID = 0
END = END_ID.to_bytes(4, "little")
FILE_SCHEMA = "shard int, doc_id long, at long, n_tokens long, ids array<int>"


def _encode(tokenizer, spaces: bool):
    def run(batches):
        enc, shard, at = encoder(tokenizer.value, spaces), TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, ids in enc.encode_rows(batch.column(1)):
                _, ends, data = ids.buffers()
                ends = np.frombuffer(ends, np.int64, len(ids) + 1) // 4
                values = np.insert(np.frombuffer(data or b"", "<i4")[:ends[-1]], ends[1:], END_ID)
                ends = ends + np.arange(len(ends))  # with the end ids
                n = np.diff(ends)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), shard, np.int32)), batch.column(0).slice(first, len(n)).cast(pa.int64()),
                     pa.array(at + ends[:-1]), pa.array(n), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))],
                    ["shard", "doc_id", "at", "n_tokens", "ids"])
                at += int(ends[-1])
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, spaces: bool = True, shards: int | None = None,
                 stripe_bytes: int = 64 << 20) -> None:
    """Writes ``docs`` (doc_id, text) as token files under ``path``, in ascending order of doc_id."""
    spark = docs.sparkSession
    text = spark.sparkContext.broadcast(definition(tokenizer))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    (docs.select("doc_id", "text").repartitionByRange(shards or partitions(spark), *order).sortWithinPartitions(*order)
     .mapInArrow(_encode(text, spaces), FILE_SCHEMA)
     .write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.create.index", "true").option("orc.row.index.stride", "1000")
     .option("orc.stripe.size", str(stripe_bytes)).option("compression", "zstd").orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(shard, doc_id, at, n_tokens, ids) of the files; filters on doc_id are pushed to stripes and row groups."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, before): the ids in all earlier files, from one narrow column of the files."""
    total = read_tokens(spark, path).groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    return total.select("shard", (F.sum("_n").over(Window.orderBy("shard")) - F.col("_n")).alias("before"))  # a row a file


def _checksums(batches):
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index("ids"))
        values, ends = np.asarray(lists.values).astype("<u4", copy=False), np.asarray(lists.offsets)
        crc = np.array([zlib.crc32(values[a:b]) for a, b in zip(ends, ends[1:])], np.int64)
        yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(4)], pa.array(crc, pa.int64())],
                                         ["shard", "doc_id", "at", "n_tokens", "ids_crc32"])


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    rows = read_tokens(spark, path).select("shard", "doc_id", "at", "n_tokens", "ids").mapInArrow(
        _checksums, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return (rows.join(F.broadcast(shard_starts(spark, path)), "shard")
            .select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))
