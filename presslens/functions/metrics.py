"""Numeric and set metrics (MTH-08..10, ARR-01/02)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presslens.functions.text import _c, ColumnOrName


def hash_key(key: ColumnOrName, seed: int) -> Column:
    """Deterministic md5 shuffle key of (key, seed): same in Spark and DuckDB,
    independent of partitioning, so samples and splits reproduce exactly."""
    return F.md5(F.concat_ws(":", _c(key).cast("string"), F.lit(str(seed))))


def hash01(key: ColumnOrName, seed: int) -> Column:
    """Uniform [0, 1) from the first 8 hex digits of ``hash_key``."""
    h = F.conv(F.substring(hash_key(key, seed), 1, 8), 16, 10).cast("bigint")
    return h.cast("double") / F.lit(4294967296.0)


def target_score(key: ColumnOrName, lo: float, hi: float, seed: int) -> Column:
    """MTH-08: seeded uniform(lo, hi) per key, rounded to 2 decimals."""
    return F.round(F.lit(float(lo)) + F.lit(float(hi - lo)) * hash01(key, seed), 2)



def cosine(a: ColumnOrName, b: ColumnOrName) -> Column:
    """MTH-10: cosine similarity of two equal-length numeric arrays (null if a norm is 0)."""
    av, bv = _c(a), _c(b)
    dot = F.aggregate(F.zip_with(av, bv, lambda x, y: x.cast("double") * y.cast("double")),
                      F.lit(0.0), lambda acc, v: acc + v)
    na = F.sqrt(F.aggregate(av, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double")))
    nb = F.sqrt(F.aggregate(bv, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double")))
    return F.when((na == 0) | (nb == 0), F.lit(None).cast("double")).otherwise(dot / (na * nb))


def jaccard(a: ColumnOrName, b: ColumnOrName) -> Column:
    """ARR-01: |A n B| / |A u B| over sets; both empty -> 1.0."""
    av = F.array_distinct(empty_if_null(a))
    bv = F.array_distinct(empty_if_null(b))
    u = F.size(F.array_union(av, bv))
    return F.when(u == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(av, bv)).cast("double") / u.cast("double"))


def empty_if_null(c: ColumnOrName, element: str = "string") -> Column:
    """ARR-02: missing array -> []."""
    return F.coalesce(_c(c), F.array().cast(f"array<{element}>"))
