"""Uniform sharding with exact shard sizes, by a hypergeometric communication matrix.

The shuffle of N rows over P partitions into S shards is drawn in two steps. First
how many rows go from each partition to each shard: the counts of a uniform
permutation, a P x S matrix of fixed row sums (the partitions' rows) and fixed
column sums (the shards' sizes, at most one apart). Then which rows: each
partition permutes its own rows and deals them by its row of the matrix, the rows
move, and each shard permutes what it received.

The matrix comes from halving: the rows of a run of partitions are split between its
two halves by a multivariate hypergeometric draw, then each half is halved in the same way
down to single partitions, so all runs of a level are drawn side by side. A draw
inverts the distribution by its term ratios from the mode outward, ten standard
deviations and 30 terms each way (what lies beyond is less than a double resolves).

DataFrame functions only. Draws and permutations are hashes of a seed and of
places in the written input, so reruns over the same files and lost executors
give the same shards.

Defined cases: every row is dealt, whatever its columns hold, nulls and very long
texts included; equal rows are separate rows; fewer rows than shards leave the last
shards empty; no rows give no rows; the result's own column names replace those
of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm.common import partitions, unused, written

_LOW = (1 << 33) - 1  # monotonically_increasing_id: partition above, row of the partition below
_UNIT = 1 << 53


def _uniform(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(_UNIT)) / F.lit(float(_UNIT))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def hypergeometric(total: Column, good: Column, draws: Column, uniform: Column) -> Column:
    """How many of ``draws`` out of ``total`` hit one of the ``good``, for a uniform number in [0, 1)."""
    one, d = F.lit(1), lambda c: c.cast("double")
    low = F.greatest(F.lit(0), draws - (total - good))
    high = F.least(draws, good)
    mode = F.greatest(low, F.least(high, F.floor((d(draws) + 1) * (d(good) + 1) / (d(total) + 2))))
    n = F.greatest(d(total), F.lit(1.0))
    spread = F.sqrt(d(draws) * d(good) / n * (F.lit(1.0) - d(good) / n) * (d(total) - d(draws))
                    / F.greatest(d(total) - 1, F.lit(1.0)))
    reach = F.ceil(spread * 10) + 30
    span = F.struct(mode.alias("mode"), F.greatest(low, mode - reach).alias("from"), F.least(high, mode + reach).alias("to"))

    def invert(s: Column) -> Column:
        up = F.transform(F.sequence(s["mode"], s["to"]), lambda k: F.struct(k.alias("k"), F.lit(True).alias("up")))
        down = F.when(s["from"] < s["mode"], F.transform(
            F.sequence(s["mode"] - one, s["from"], F.lit(-1).cast("long")), lambda k: F.struct(k.alias("k"), F.lit(False).alias("up"))))
        steps = F.concat(up, F.coalesce(down, F.array().cast("array<struct<k:bigint,up:boolean>>")))

        def weight(w: Column, x: Column) -> Column:  # of x's outcome, from that of the one nearer to the mode
            k = d(x["k"])
            rise = (d(good) - k + 1) * (d(draws) - k + 1) / (k * (d(total) - d(good) - d(draws) + k))
            fall = (k + 1) * (d(total) - d(good) - d(draws) + k + 1) / ((d(good) - k) * (d(draws) - k))
            back = x["k"] == s["mode"] - one  # the first one down starts from the mode again
            return (F.when(x["k"] == s["mode"], F.lit(1.0)).when(x["up"], w * rise)
                    .otherwise(F.when(back, F.lit(1.0)).otherwise(w) * fall))

        zero = F.lit(0.0)
        sums = F.aggregate(steps, F.struct(zero.alias("w"), zero.alias("sum")), lambda a, x: _let(
            weight(a["w"], x), lambda w: F.struct(w.alias("w"), (a["sum"] + w).alias("sum"))), lambda a: a["sum"])
        start = F.struct(zero.alias("w"), zero.alias("sum"), s["mode"].alias("k"), F.lit(False).alias("done"))
        return _let(sums * uniform, lambda goal: F.aggregate(steps, start, lambda a, x: F.when(a["done"], a).otherwise(_let(
            weight(a["w"], x), lambda w: F.struct(w.alias("w"), (a["sum"] + w).alias("sum"), x["k"].alias("k"),
                                                  (a["sum"] + w > goal).alias("done")))), lambda a: a["k"]))

    return _let(span, invert)


def multivariate(sizes: Column, draws: Column, *seeds: Column) -> Column:
    """Counts by kind of ``draws`` items out of ``sizes`` items of each kind: one conditional draw a kind."""
    zero = F.lit(0).cast("long")
    total = F.aggregate(sizes, zero, lambda a, x: a + x)
    start = F.struct(draws.alias("n"), total.alias("t"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(
        F.sequence(zero, F.size(sizes).cast("long") - 1), start,
        lambda a, j: _let(sizes[j.cast("int")], lambda size: _let(
            hypergeometric(a["t"], size, a["n"], _uniform(*seeds, j)),
            lambda x: F.struct((a["n"] - x).alias("n"), (a["t"] - size).alias("t"), F.concat(a["out"], F.array(x)).alias("out")))),
        lambda a: a["out"])


def communication_matrix(counts: DataFrame, shards: int, seed: int = 42) -> DataFrame:
    """(part, sent array<long>) for ``counts`` (part, n): how many rows each partition sends to each shard."""
    spark = counts.sparkSession
    whole = counts.agg(F.array_sort(F.collect_list(F.struct("part", "n"))).alias("run"), F.sum("n").alias("n"))  # a row a partition
    n = F.col("n")
    sizes = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda j: F.floor((n + shards - 1 - j) / shards))
    nodes = whole.where("n > 0").select("run", sizes.alias("sizes"))
    levels = (max(1, counts.count()) - 1).bit_length()
    rows = lambda run: F.aggregate(run, F.lit(0).cast("long"), lambda a, x: a + x["n"])
    for level in range(levels):
        half = F.floor(F.size("run") / 2).cast("int")
        left, right = F.slice("run", 1, half), F.slice("run", half + 1, F.size("run"))
        drawn = multivariate(F.col("sizes"), rows(left), F.lit(seed), F.lit(level), F.col("run")[0]["part"])
        halves = _let(drawn, lambda x: F.array(
            F.struct(left.alias("run"), x.alias("sizes")),
            F.struct(right.alias("run"), F.zip_with("sizes", x, lambda a, b: a - b).alias("sizes"))))
        whole_node = F.array(F.struct("run", "sizes"))
        nodes = nodes.select(F.explode(F.when(F.size("run") > 1, halves).otherwise(whole_node)).alias("x")).select("x.run", "x.sizes")
        if level % 6 == 5:  # 64 times the runs: to more tasks
            nodes = nodes.repartition(partitions(spark), F.col("run")[0]["part"])
    return nodes.select(F.col("run")[0]["part"].alias("part"), F.col("sizes").alias("sent"))


def shard_rows(rows: DataFrame, shards: int = 16, seed: int = 42) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1) and ``slot``, the place in the shard, gapless from 0.

    Shard sizes are the rows over the shards, the first ones one larger where that leaves a rest.
    """
    spark = rows.sparkSession
    kept = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    rows = rows.select(*kept)
    part, local, place = (unused(rows, c) for c in ("_part", "_local", "_place"))
    # each partition permutes its rows; writing them fixes partitions and places
    dealt = rows.withColumn(local, F.monotonically_increasing_id()).withColumn(part, F.spark_partition_id())
    dealt = dealt.sortWithinPartitions(F.xxhash64(F.lit(seed), local), local).withColumn(place, F.monotonically_increasing_id())
    dealt = written(dealt, "dealt")
    counts = dealt.groupBy(F.col(part).alias("part")).agg(F.count("*").alias("n"))
    matrix = written(communication_matrix(counts, shards, seed), "matrix").withColumnRenamed("part", part)
    ends = F.aggregate("sent", F.array().cast("array<bigint>"), lambda a, x: F.concat(
        a, F.array(x + F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)))))
    matrix = matrix.select(part, ends.alias("_ends"))
    row = F.col(place).bitwiseAND(F.lit(_LOW))
    sent = dealt.join(matrix, part).withColumn("shard", F.size(F.filter("_ends", lambda e: e <= row)))
    # the shards' rows move, and range partitions permute them again
    again = F.xxhash64(F.lit(seed + 1), F.col(part), F.col(local))
    got = (sent.select(*kept, "shard", again.alias(local), F.col(place))
           .repartitionByRange(partitions(spark), "shard", local, place).sortWithinPartitions("shard", local, place)
           .drop(local, place).withColumn(part, F.spark_partition_id()).withColumn(place, F.monotonically_increasing_id()))
    got = written(got, "moved")
    totals = got.groupBy(part).agg(F.count("*").alias("_n"))
    before = totals.select(part, (F.sum("_n").over(Window.orderBy(part)) - F.col("_n")).alias("_before"))
    n = F.lit(got.count())
    # a row a range partition: the rows before it
    at = F.col("_before") + F.col(place).bitwiseAND(F.lit(_LOW))
    small, rest = F.floor(n / shards), n % shards
    first = F.col("shard") * small + F.least(F.col("shard").cast("long"), rest)
    return got.join(F.broadcast(before), part).select(*kept, "shard", (at - first).alias("slot"))


def write_shards(rows: DataFrame, path: str, shards: int = 16, seed: int = 42) -> None:
    """Writes ``rows`` sharded under ``path``, a directory ``shard=<number>`` each, in files sorted by slot."""
    placed = written(shard_rows(rows, shards, seed), "placed")
    (placed.repartitionByRange(partitions(rows.sparkSession), "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
