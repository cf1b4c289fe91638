"""Set operations (SET-01..06)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*dfs: DataFrame) -> DataFrame:
    """SET-01/02: UNION ALL by column name, missing columns filled with null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def common_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """SET-03: keys present on both sides (semi join, distinct)."""
    return a.select(key).join(b.select(key), key, "left_semi").distinct()


def entity_overlap(a, b):
    """SET-04: (intersection, union) of two array columns as sets."""
    return F.array_intersect(F.array_distinct(a), F.array_distinct(b)), F.array_union(a, b)


def new_items(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """SET-06 / JOIN-03: rows of ``df`` whose key is not in ``done``; null keys
    match null keys (None == None), input duplicates are kept."""
    d = done.select(F.col(key).alias("__done_key")).distinct()
    return df.join(d, df[key].eqNullSafe(d["__done_key"]), "left_anti")
