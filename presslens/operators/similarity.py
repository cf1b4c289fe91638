"""Similarity of two texts without a model (AGG-05, MTH-10): TF-IDF vectors as rows, cosine as a join on terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.session import shared_dir

WORDS = r"\p{L}+"
COMMON_TERMS = 1 << 17  # at most, whose weights are broadcast
COMMON_KEYS = 1 << 18  # repeated ones that are broadcast


def _counted(pairs: DataFrame, a: str, b: str, pattern: str, out: str) -> DataFrame:
    """Adds ``out``: (t, a, b) for every term of a row's two texts, with its counts in them.

    Each text's terms are sorted, so equal ones stand together and a run's length is a count, and then the runs of both texts: memory
    is bounded by a row, where an aggregation over (row, term) holds all terms of a task.
    """
    def sorted_runs(d: DataFrame, side: str, first: bool, name: str) -> DataFrame:
        s, at = F.col(f"__s{name}"), F.col(f"__at{name}")  # staged: a column that is used more than once is evaluated once
        d = d.withColumn(f"__s{name}", F.sort_array(F.regexp_extract_all(F.lower(F.coalesce(F.col(side), F.lit(""))), F.lit(pattern), F.lit(0))))
        begins = F.transform(s, lambda t, i: F.when(~F.get(s, i - 1).eqNullSafe(t), i))
        d = d.withColumn(f"__at{name}", F.filter(begins, lambda i: i.isNotNull()))
        return d.withColumn(f"__runs{name}", F.transform(at, lambda i, k: F.struct(
            F.get(s, i).alias("t"), F.lit(first).alias("first"), (F.coalesce(F.get(at, k + 1), F.size(s)) - i).alias("n"))))

    d = sorted_runs(sorted_runs(pairs, a, True, "a"), b, False, "b")
    d, runs = d.withColumn("__runs", F.sort_array(F.concat("__runsa", "__runsb"))), F.col("__runs")

    def both(x: Column, k: Column) -> Column:  # a term's run in b stands before its run in a
        after = F.get(runs, k + 1)
        in_a = F.when(x["first"], x["n"]).when(after["t"] == x["t"], after["n"]).otherwise(0)
        whole = F.struct(x["t"].alias("t"), in_a.alias("a"), F.when(x["first"], 0).otherwise(x["n"]).alias("b"))
        return F.when(~F.get(runs, k - 1)["t"].eqNullSafe(x["t"]), whole)

    return d.withColumn(out, F.filter(F.transform(runs, both), lambda x: x.isNotNull())).drop(
        "__runs", *[f"__{k}{x}" for k in ("s", "at", "runs") for x in "ab"])


def _least_step(steps: list[tuple[int, int]], most: int) -> int:
    """The least step so that it and those above have ``most`` terms at most, from (step, terms)."""
    least, held = max((x for x, _ in steps), default=0) + 1, 0
    for x, n in sorted(steps, reverse=True):
        held += n
        if held > most:
            break
        least = x
    return least


def text_cosine(pairs: DataFrame, key: str, a: str, b: str, pattern: str = WORDS, out: str = "similarity") -> DataFrame:
    """(``key``, ``out``): the cosine of the TF-IDF vectors of the texts ``a`` and ``b`` of each row (rows of one ``key``
    count as one).

    Terms are the matches of ``pattern`` in lower case; a term's weight is its count times ln((1 + n) / (1 + d)) + 1, with n
    texts, d of which hold it (the texts of both columns; null ones are not counted). A vector is sparse rows
    (key, term, count in a, count in b), counted row by row; ``pairs`` is evaluated once, and its counts are written. Only rows
    whose key repeats are summed up. The weights of the COMMON_TERMS terms that the most texts hold, nearly all rows of
    usual texts, are broadcast: those rows are not shuffled, and their sums are partial before they are. The other terms'
    weights come by an equi-join, whose tasks hold the weights of their terms and sort nothing. 0 where a text is null or
    holds no term.
    """
    spark = pairs.sparkSession
    named = pairs.select(F.col(key).alias("__key"), F.col(a).alias("__ta"), F.col(b).alias("__tb"))
    counted = _counted(named, "__ta", "__tb", pattern, "__e").select(
        "__key", (F.col("__ta").isNotNull().cast("int") + F.col("__tb").isNotNull().cast("int")).alias("__n"), "__e")
    path = shared_dir(spark, "term-counts")  # once, for the weights and the sums
    counted.write.option("compression", "zstd").parquet(path)
    counted = spark.read.schema(counted.schema).parquet(path)

    def exploded(part: DataFrame) -> DataFrame:
        e = part.select("__key", F.explode("__e").alias("e"))
        return e.select("__key", F.col("e.t").alias("__t"), F.col("e.a").cast("long").alias("__a"), F.col("e.b").cast("long").alias("__b"))

    again = counted.groupBy("__key").agg(F.count(F.lit(1)).alias("__m")).filter("__m > 1 OR __key IS NULL").select(F.col("__key").alias("__own"))
    repeated = again.count()
    if 0 < repeated <= COMMON_KEYS:
        again = F.broadcast(again)

    def rows_of(part: DataFrame) -> DataFrame:
        if not repeated:
            return exploded(part)
        part = part.join(again, F.col("__key").eqNullSafe(F.col("__own")), "left").withColumn(
            "__again", F.col("__own").isNotNull() | F.col("__key").isNull())
        summed = exploded(part.filter("__again")).groupBy("__key", "__t").agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
        return exploded(part.filter("NOT __again")).unionByName(summed)

    n = counted.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    held = rows_of(counted).groupBy("__t").agg(F.sum(F.when(F.col("__a") > 0, 1).otherwise(0) + F.when(F.col("__b") > 0, 1).otherwise(0)).alias("__d"))
    path = shared_dir(spark, "term-weights")
    (held.select("__t", (F.log((F.lit(n) + 1) / (F.col("__d") + 1)) + 1).alias("__w"), F.floor(F.log2("__d") * 4).cast("int").alias("__step"))
     .write.option("compression", "zstd").parquet(path))
    weights = spark.read.schema("__t string, __w double, __step int").parquet(path)
    least = _least_step([tuple(r) for r in weights.groupBy("__step").count().collect()], COMMON_TERMS)  # 4 rows for each power of 2
    common = weights.filter(F.col("__step") >= least).select("__t", "__w")
    rare = weights.filter(F.col("__step") < least).select("__t", "__w")

    def sums(weighted: DataFrame, name: str) -> DataFrame:
        w2 = F.col("__w") * F.col("__w")
        return weighted.groupBy(F.col("__key").alias(f"__{name}")).agg(
            F.sum(F.col("__a") * F.col("__b") * w2).alias(f"__{name}_ab"), F.sum(F.col("__a") * F.col("__a") * w2).alias(f"__{name}_aa"),
            F.sum(F.col("__b") * F.col("__b") * w2).alias(f"__{name}_bb"))

    often = sums(rows_of(counted).join(F.broadcast(common), "__t"), "often")
    others = counted.filter(rare.select(F.count(F.lit(1)) > 0).scalar())  # without rare terms no row is looked at again
    others = rows_of(others).join(F.broadcast(common.select("__t")), "__t", "left_anti").join(rare.hint("shuffle_hash"), "__t")
    seldom = sums(others, "seldom")
    got = counted.select("__key").join(often, F.col("__key") == F.col("__often"), "left").join(seldom, F.col("__key") == F.col("__seldom"), "left")
    ab, aa, bb = (F.coalesce(F.col(f"__often_{x}"), F.lit(0.0)) + F.coalesce(F.col(f"__seldom_{x}"), F.lit(0.0)) for x in ("ab", "aa", "bb"))
    norm = F.sqrt(aa * bb)
    return got.select(F.col("__key").alias(key), F.when(norm > 0, ab / norm).otherwise(F.lit(0.0)).alias(out))
