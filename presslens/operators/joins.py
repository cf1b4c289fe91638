"""Lookup and merge joins (JOIN-04/05/07).

Every lookup is an equi-join; which side is broadcast, if any, is left to Spark's own size estimates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_equal(df: DataFrame, table: DataFrame, key: str, value: str, default: Column | None = None,
                 out: str | None = None) -> DataFrame:
    """JOIN-05: ``table.get(df[key], default)`` as a left join (table keys unique)."""
    out = out or value
    t = table.select(F.col(key).alias("__lk"), F.col(value).alias("__lv"))
    j = df.join(t, df[key] == t["__lk"], "left").drop("__lk")
    v = F.col("__lv") if default is None else F.coalesce(F.col("__lv"), default)
    return j.withColumn(out, v).drop("__lv") if out != "__lv" else j


GRAM = 3  # characters of the substrings that lead from values to keys


def _grams(c: Column, n: Column) -> Column:
    """The different substrings of ``n`` characters."""
    cut = F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(c, i, n))
    return F.when(F.length(c) >= n, F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))


def lookup_contains(df: DataFrame, table: DataFrame, col: str, key: str, value: str, order: str,
                    default: Column | None = None, out: str = "matched") -> DataFrame:
    """JOIN-04: value of the first ``table`` row (by ``order``) whose ``key`` is a
    substring of ``df[col]``, else ``default``.

    Every key is looked up by its rarest substring of GRAM characters (a shorter key by itself): the distinct values of
    ``df[col]`` are cut into such substrings and counted, each key takes the one the fewest values hold, and an equi-join
    on it brings value and key together, to be verified by ``contains``. The best match of each value is joined
    back: equi-joins at any number of keys and rows, no row is repeated, and long values meet few keys but their own.
    """
    t = table.select(F.col(key).alias("__k"), F.struct(F.col(order).alias("o"), F.col(value).alias("v")).alias("__b"))
    t = t.filter("__k is not null").groupBy("__k").agg(F.min("__b").alias("__b"))
    size = F.least(F.length("__k"), F.lit(GRAM))
    sizes = t.select(F.collect_set(size)).scalar()  # GRAM + 1 at most
    values = df.select(F.col(col).alias("__s")).filter("__s is not null").distinct()
    held = values.withColumn("__n", F.explode(sizes)).select("__s", F.explode(_grams(F.col("__s"), F.col("__n"))).alias("__g"))
    often = held.groupBy("__g").agg(F.count(F.lit(1)).alias("__m"))
    rarest = (t.select("__k", "__b", F.explode(_grams(F.col("__k"), size)).alias("__g")).join(often, "__g")
              .groupBy("__k").agg(F.min(F.struct("__m", "__g")).alias("__r"), F.first("__b").alias("__b"))
              .select("__k", "__b", F.col("__r.__g").alias("__g")))
    best = (held.join(rarest, "__g").filter(F.contains(F.col("__s"), F.col("__k")))
            .groupBy("__s").agg(F.min("__b").alias("__b")))
    v = F.col("__b.v")
    return (df.join(best, F.col(col) == F.col("__s"), "left")
            .withColumn(out, v if default is None else F.coalesce(v, default)).drop("__s", "__b"))


def merge_state(state: DataFrame, newest: DataFrame, key: str = "source", value: str = "cutoff",
                newest_col: str = "newest") -> DataFrame:
    """JOIN-07: union of keys; the newer of saved and newest (nulls ignored)."""
    s = state.select(F.col(key), F.col(value).alias("__old"))
    n = newest.select(F.col(key), F.col(newest_col).alias("__new"))
    return s.join(n, key, "full_outer").select(key, F.greatest("__old", "__new").alias(value))


BLOCK_BITS = 5


def with_next(df: DataFrame, key: str, col: str, out: str) -> DataFrame:
    """(``key``, ``col``, ``out``): each row with ``col`` of every row whose integer ``key`` is one more, as an inner join.

    Rows meet in blocks of 2 ** BLOCK_BITS keys, and those of a block's first key go to the block before, too. So both sides of
    the join are the same rows dealt alike and Spark shuffles them once, where a join on the key and on the key less one
    shuffles ``col`` twice.
    """
    block = lambda k: F.shiftright(k, BLOCK_BITS)
    d = df.select(F.col(key).alias("__k"), F.col(col).alias("__v")).filter("__k IS NOT NULL")
    d = d.withColumn("__block", F.explode(F.array_distinct(F.array(block(F.col("__k")), block(F.col("__k") - 1)))))
    # one product over both sides: no part of it can be moved below one of them, which would make them differ
    home = (block(F.col("l.__k")) == F.col("l.__block")).cast("int")
    return d.alias("l").join(d.alias("r"), (F.col("l.__block") == F.col("r.__block")) & ((F.col("r.__k") - F.col("l.__k")) * home == 1)).select(
        F.col("l.__k").alias(key), F.col("l.__v").alias(col), F.col("r.__v").alias(out))
