"""Keyed, idempotent document store on parquet (SNK-08, SRC-14, STM-04).

No table format is assumed. Rows live in buckets by a hash of their key, so a key has one place for
good. Every write goes to a directory of its own (``data/<unique attempt>``) and becomes visible by one atomic
rename of a manifest file that names the current directory of every bucket:

* readers follow the newest manifest alone and never see half a write;
* a job that dies leaves an unnamed directory, which a retry does not meet and ``vacuum`` removes;
* a write reads and rewrites only the buckets its keys fall in. Their number is what the first write's rows ask for; a
  bucket is written as several files, and by as many tasks, where it holds many rows.

A manifest can carry a few values of the writer (the stream's batch) that are committed with the rows.
One writer at a time: the second of two that commit the same version fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BUCKET = "__bucket"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


BUCKET_ROWS = 1 << 20  # of the first write, in a bucket
FILE_ROWS = 1 << 18  # of a write, in a file


class KeyedStore:
    """``buckets``: how many; by default what the first write asks for, BUCKET_ROWS rows each (kept in the manifest)."""

    def __init__(self, spark: SparkSession, root: str, key: str = "_id", buckets: int | None = None):
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets

    # -- manifests -------------------------------------------------------------
    def versions(self) -> list[int]:
        return [int(n[1:]) for n in _names(self.spark, f"{self.root}/manifest") if n[:1] == "m" and n[1:].isdigit()]

    def version(self) -> int:
        return max(self.versions(), default=0)

    def _manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"buckets": self.buckets, "paths": {}, "meta": {}}
        p, fs = _fs(self.spark, f"{self.root}/manifest/m{version:08d}")
        stream = fs.open(p)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        m = json.loads(text)
        if self.buckets not in (None, m["buckets"]) and m["buckets"] is not None:
            raise ValueError(f"the store has {m['buckets']} buckets, not {self.buckets}")
        return m

    def meta(self) -> dict:
        """The values committed with the newest version."""
        return self._manifest()["meta"]

    def commit(self, paths: dict | None = None, meta: dict | None = None) -> int:
        """A new version: the current one with other bucket directories or values."""
        last, jvm = self.version(), self.spark.sparkContext._jvm
        m = self._manifest(last)
        m["paths"].update(paths or {})
        m["meta"].update(meta or {})
        m["buckets"] = m["buckets"] or self.buckets  # told by the first write of rows
        tmp, fs = _fs(self.spark, f"{self.root}/manifest/.{uuid.uuid4().hex}")
        out = fs.create(tmp, True)
        out.write(bytearray(json.dumps(m).encode()))
        out.close()
        target = jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest/m{last + 1:08d}")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        context.rename(fs.makeQualified(tmp), fs.makeQualified(target), self.spark.sparkContext._gateway.new_array(rename, 0))
        return last + 1

    # -- reads -------------------------------------------------------------------
    def _read(self, paths: list[str]) -> DataFrame | None:
        if not paths:
            return None
        return self.spark.read.option("mergeSchema", "true").parquet(*[f"{self.root}/{p}" for p in paths])

    def read(self) -> DataFrame | None:
        """SRC-14: the current content (None when the store is empty)."""
        return self._read(list(self._manifest()["paths"].values()))

    # -- writes ------------------------------------------------------------------
    def _bucket(self, buckets: int):
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def _stage(self, df: DataFrame) -> tuple[DataFrame, int, list[str]]:
        """Incoming rows, written once as they come; the store's number of buckets (fixed by its first rows), and
        the buckets these rows fall in."""
        path = f"{self.root}/data/{uuid.uuid4().hex}-in"
        df.write.parquet(path)
        staged = self.spark.read.schema(df.schema).parquet(path)
        buckets = self._manifest()["buckets"]
        if buckets is None:
            rows = staged.count()
            if not rows:
                return staged, 0, []
            buckets = self.buckets = -(-rows // BUCKET_ROWS)
        own = staged.select(self._bucket(buckets).alias("b")).distinct().collect()  # a row a bucket
        return staged, buckets, sorted(str(r["b"]) for r in own)

    def _put(self, df: DataFrame, buckets: int, rows: int) -> dict[str, str]:
        """Rows written by bucket to a directory of their own, about FILE_ROWS of them a file: the path of each bucket in it."""
        path = f"data/{uuid.uuid4().hex}-rows"
        files = max(1, -(-rows // (FILE_ROWS * buckets)))  # of a bucket: dealt by another hash of the key
        part = F.pmod(F.xxhash64(F.lit("file"), self.key), F.lit(files))
        (df.withColumn(_BUCKET, self._bucket(buckets)).repartition(buckets * files, _BUCKET, part)
         .write.partitionBy(_BUCKET).parquet(f"{self.root}/{path}"))
        own = [n for n in _names(self.spark, f"{self.root}/{path}") if n.startswith(f"{_BUCKET}=")]
        return {n.split("=", 1)[1]: f"{path}/{n}" for n in own}

    def upsert(self, updates: DataFrame, newest_by: str | None = None, meta: dict | None = None) -> int:
        """Create-or-replace by key (one row per key: the caller dedups, e.g. WIN-02).

        With ``newest_by`` a stored row stays when its value there is greater, so an older record that
        arrives later does not replace a newer one. ``updates`` is computed once.
        """
        new, buckets, touched = self._stage(updates)
        if not touched:
            return self.commit(meta=meta) if meta else self.version()
        now = self._manifest()["paths"]
        old = self._read([now[b] for b in touched if b in now])
        if old is None:
            return self.commit(self._put(new, buckets, new.count()), meta)
        k = self.key
        if newest_by:
            stored = old.select(k, F.col(newest_by).alias("__stored"))
            new = (new.join(stored, k, "left").filter("__stored is null or " + f"`{newest_by}` >= __stored").drop("__stored"))
        kept = old.join(new.select(k), k, "left_anti")
        return self.commit(self._put(kept.unionByName(new, allowMissingColumns=True), buckets, old.count()), meta)

    def patch(self, changes: DataFrame) -> tuple[int, DataFrame]:
        """Partial update by key: a non-null column in ``changes`` replaces the
        stored value, null leaves it; keys not in the store come back as the
        not-found frame (the 404 case) and are not written."""
        k = self.key
        now = self._manifest()["paths"]
        if not now:
            return self.version(), changes.select(k)
        ch, buckets, touched = self._stage(changes)
        cur = self._read([now[b] for b in touched if b in now])
        if cur is None:
            return self.version(), ch.select(k)
        missing = ch.select(k).join(cur.select(k), k, "left_anti")
        new = ch.select(k, *[F.col(c).alias(f"__new_{c}") for c in ch.columns if c != k])
        j = cur.join(new, k, "left")
        cols = [F.coalesce(F.col(f"__new_{c}"), F.col(c)).alias(c) if f"__new_{c}" in j.columns else F.col(c)
                for c in cur.columns]
        return self.commit(self._put(j.select(*cols), buckets, cur.count())), missing

    def vacuum(self, keep: int = 2) -> int:
        """Deletes all manifests but the newest ``keep`` and every directory none of those names
        (no write may be under way); returns the number of directories."""
        versions = sorted(self.versions())
        used = {p.split("/")[1] for v in versions[-keep:] for p in self._manifest(v)["paths"].values()}
        for v in versions[:-keep]:
            p, fs = _fs(self.spark, f"{self.root}/manifest/m{v:08d}")
            fs.delete(p, False)
        gone = [n for n in _names(self.spark, f"{self.root}/data") if n not in used]
        for n in gone:
            p, fs = _fs(self.spark, f"{self.root}/data/{n}")
            fs.delete(p, True)
        return len(gone)
