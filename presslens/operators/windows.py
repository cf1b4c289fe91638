"""Row-selection operators with implicit order (WIN-01..07).

Scale notes
-----------
* Keep-first / last-write-wins are aggregations (``min``/``max`` of a struct led
  by the order key), not full-group windows: the partial aggregate collapses a
  hot key to one row per map task before the shuffle. They carry the columns they return, so project first.
* Exact-N samples, slices and splits follow the order of an md5 hash of (key, seed). Where a group's
  sample ends - the hash and key of its last row - is found by radix selection: counts per (group, hash
  prefix) tell the one bucket that holds the n-th key, and only that bucket's keys are ranked. The rows
  themselves are then filtered where they are. A sample by group shuffles what may be in it unless Spark
  broadcasts the ends by itself.
* So a group that holds a third of all rows sends no task more than one bucket of its keys, and slices of
  any length need neither a ranking nor a broadcast of their keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.functions.metrics import hash_key

_H = "__h"
_RN = "__rn"
DIGITS, ALL_DIGITS = 3, 4  # hex digits of a bucket: of each group, of a table without groups
BOUNDS = 1024  # buckets of groups whose last end thins the rows before they are joined


def _cols(df: DataFrame, exclude=()) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def dedup_keep_first(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """WIN-01: one row per key, the one with the smallest ``order`` (ties: smallest row)."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = _cols(df, keys + [order])
    packed = F.min(F.struct(F.col(order), *[F.col(c) for c in rest])).alias("__first")
    return (df.groupBy(*keys).agg(packed)
            .select(*keys, *[F.col(f"__first.{c}").alias(c) for c in [order] + rest])
            .select(*df.columns))


def last_write_wins(df: DataFrame, key: str | list[str], order: str,
                    valid: Column | None = None) -> DataFrame:
    """WIN-02: per key the row with the largest ``order`` among rows passing ``valid``."""
    if valid is not None:
        df = df.filter(valid)
    keys = [key] if isinstance(key, str) else list(key)
    rest = _cols(df, keys + [order])
    packed = F.max(F.struct(F.col(order), *[F.col(c) for c in rest])).alias("__last")
    return (df.groupBy(*keys).agg(packed)
            .select(*keys, *[F.col(f"__last.{c}").alias(c) for c in [order] + rest])
            .select(*df.columns))


def _keys_at(df: DataFrame, wanted, by: str | None, key: str, seed: int) -> DataFrame:
    """(__g, __p, __h, __k): the keys at 0-based positions of each group's (or the whole table's) hash order.

    ``wanted(total)`` gives the array of positions for a group's number of rows. Radix selection: counts by the hash's
    first hex digits, then the rank inside the buckets that hold a wanted position.
    """
    group = [F.lit(0) if by is None else F.col(by)]
    keys = df.select(group[0].alias("__g"), hash_key(key, seed).alias(_H), F.col(key).alias("__k"))
    keys = keys.withColumn("__b", F.substring(_H, 1, ALL_DIGITS if by is None else DIGITS))
    # at most 16**digits rows a group
    inner = Window.partitionBy("__g")
    table = keys.groupBy("__g", "__b").agg(F.count(F.lit(1)).alias("__n"))
    table = (table.withColumn("__from", F.sum("__n").over(inner.orderBy("__b")) - F.col("__n"))
             .withColumn("__all", F.sum("__n").over(inner)))
    held = F.filter(wanted(F.col("__all")), lambda p: (p >= F.col("__from")) & (p < F.col("__from") + F.col("__n")))
    edges = (table.withColumn("__ps", held).filter(F.size("__ps") > 0)
             .select(F.col("__g").alias("__eg"), F.col("__b").alias("__eb"), "__from", "__ps"))
    rank = F.row_number().over(Window.partitionBy("__g", "__b").orderBy(_H, "__k")) - 1
    inside = keys.join(edges, F.col("__g").eqNullSafe(F.col("__eg")) & (F.col("__b") == F.col("__eb")))
    return (inside.withColumn("__p", rank + F.col("__from")).filter(F.array_contains("__ps", F.col("__p")))
            .select("__g", "__p", _H, "__k"))


def sample_exact(df: DataFrame, n: int, by: str | None, key: str, seed: int) -> DataFrame:
    """WIN-03: exactly min(n, group size) rows per group (null is a group), chosen by the seeded
    hash order (ties broken by ``key``, which is unique); reproducible across partitionings.

    ``df`` is scanned for its keys (their counts by bucket, then the bucket where each group's sample ends), then for its
    rows, each compared with the end of its group. Any number of groups works the same way: the ends are joined by an equi-join,
    which Spark broadcasts where they are small and whose hot groups AQE splits otherwise. Rows beyond the last
    end of all groups in their group's bucket (of BOUNDS) go before the join, so few groups shuffle little more than
    the sample.
    """
    if n <= 0:
        return df.limit(0)
    last = _keys_at(df, lambda total: F.array(F.least(F.lit(n), total) - 1), by, key, seed)
    end = F.max(F.struct(_H, "__k")).alias("__end")  # one row a group
    place = F.struct(hash_key(key, seed).alias(_H), F.col(key).alias("__k"))
    if by is None:
        return df.filter(F.coalesce(place <= last.agg(end).scalar(), F.lit(False)))
    ends = last.groupBy("__g").agg(end)
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(BOUNDS)).cast("int")
    last = ends.groupBy(bucket("__g").alias("__b")).agg(F.max("__end").alias("__last"))  # BOUNDS rows at most
    last = last.agg(F.map_from_entries(F.collect_list(F.struct("__b", "__last"))).alias("__m")).select(
        F.transform(F.sequence(F.lit(0), F.lit(BOUNDS - 1)), lambda b: F.col("__m")[b]))
    rows = df.filter(place <= F.get(last.scalar(), bucket(F.col(by))))
    return rows.join(ends, F.col(by).eqNullSafe(F.col("__g"))).filter(place <= F.col("__end")).drop("__g", "__end")


def rank_slices(df: DataFrame, bounds: list[tuple[int, int]], key: str, seed: int,
                label: str = "slice") -> DataFrame:
    """WIN-04: seeded shuffle, then disjoint positional slices [lo, hi] (0-based,
    inclusive). Only the keys at the slices' ends are looked up; every row, whose key is unique, is then
    compared with them where it is."""
    at = sorted({p for pair in bounds for p in pair})
    ends = _keys_at(df, lambda _: F.array(*[F.lit(p).cast("bigint") for p in at]), None, key, seed)
    ends = ends.agg(F.map_from_entries(F.collect_list(F.struct("__p", F.struct(_H, "__k")))))  # two entries a slice
    rows = df.withColumn("__place", F.struct(hash_key(key, seed).alias(_H), F.col(key).alias("__k"))).withColumn("__ends", ends.scalar())
    place, end = F.col("__place"), lambda p: F.try_element_at("__ends", F.lit(p).cast("bigint"))
    expr = None
    for i, (lo, hi) in enumerate(bounds):  # an end beyond the last row: none before it, all up to it
        cond = F.coalesce(place >= end(lo), F.lit(False)) & F.coalesce(place <= end(hi), F.lit(True))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return rows.withColumn(label, expr).filter(F.col(label).isNotNull()).drop("__place", "__ends")


def shuffle(df: DataFrame, key: str, seed: int) -> DataFrame:
    """WIN-07: total order by the seeded hash (range-partitioned sort)."""
    return df.withColumn(_H, hash_key(key, seed)).orderBy(_H, key).drop(_H)


def train_val_split(df: DataFrame, frac: float, key: str, seed: int,
                    label: str = "split", digits: int = 4) -> DataFrame:
    """WIN-05: rows ranked by the seeded hash; rank <= floor(frac * n) -> 'train',
    else 'val'. ``key`` must be unique.

    Two scans of the keys find the last row of 'train': counts by the hash's first
    ``digits`` hex characters (at most 16**digits rows) tell its bucket, the bucket's keys the row. Rows are
    then labelled where they are.
    """
    keys = df.select(hash_key(key, seed).alias(_H), F.col(key).alias("__k"))
    bucket = F.substring(F.col(_H), 1, digits)
    # bounded (<= 16**digits rows): an ordered window over the bucket table is fine
    table = keys.groupBy(bucket.alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    table = table.withColumn("__upto", F.sum("__n").over(Window.orderBy("__b")))
    train = F.floor(F.lit(float(frac)) * F.sum("__n").over(Window.partitionBy(F.lit(1))))
    edge = table.withColumn("__need", train - F.col("__upto") + F.col("__n")).filter(
        (F.col("__need") > 0) & (F.col("__need") <= F.col("__n"))).select("__b", "__need")  # one row, or none of frac 0
    rank = F.row_number().over(Window.partitionBy("__b").orderBy(_H, "__k"))
    last = (keys.withColumn("__b", bucket).join(F.broadcast(edge), "__b").withColumn(_RN, rank)
            .filter(F.col(_RN) == F.col("__need")).agg(F.max(F.struct(_H, "__k"))))
    place = F.struct(hash_key(key, seed).alias(_H), F.col(key).alias("__k"))
    return df.withColumn(label, F.when(place <= last.scalar(), F.lit("train")).otherwise(F.lit("val")))


def cap_per_group(df: DataFrame, by: str, order: str, k: int) -> DataFrame:
    """WIN-06: first ``k`` rows per group in ``order`` (the group limit runs
    partially before the shuffle, so at most k rows per task and group move)."""
    w = Window.partitionBy(by).orderBy(order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) <= k).drop(_RN)


def with_offset(df: DataFrame, order: str, weight: Column | None = None, name: str = "pos") -> DataFrame:
    """Adds the sum of ``weight`` (default: the number) of all rows before this one in ``order``
    (which must be unique), without a single-partition window: range-sort, sum per sorted
    partition (a table with one row per partition), and add each row's offset inside its partition. The
    sorted, tagged rows are checkpointed to the shared folder so both passes see the same layout."""
    from presslens.session import cut_lineage
    weight = F.lit(1).cast("bigint") if weight is None else weight
    tagged = cut_lineage(df.withColumn("__w", weight).orderBy(order).withColumn("__pid", F.spark_partition_id()))
    per = tagged.groupBy("__pid").agg(F.sum("__w").alias("__n"))
    offs = per.withColumn("__off", F.coalesce(F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.sum("__w").over(Window.partitionBy("__pid").orderBy(order)) - F.col("__w")
    return (tagged.withColumn("__in", inside).join(F.broadcast(offs.select("__pid", "__off")), "__pid")
            .withColumn(name, F.col("__off") + F.col("__in")).drop("__pid", "__in", "__w", "__off"))


def with_position(df: DataFrame, order: str, name: str = "pos") -> DataFrame:
    """0-based global position in ``order`` (must be unique)."""
    return with_offset(df, order, None, name)


def align_by_position(a: DataFrame, b: DataFrame, order_a: str, order_b: str) -> DataFrame:
    """JOIN-02: pair the i-th row of ``a`` with the i-th row of ``b``."""
    return with_position(a, order_a).join(with_position(b, order_b), "pos")
