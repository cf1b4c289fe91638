"""Aggregations (AGG-01..21). All are hash/sort aggregates with map-side
partial aggregation, so a hot group is pre-reduced before the shuffle.

Scalars (min/max/std) needed to lay out histogram and density grids are one-row
aggregates read back to the driver: one row, independent of the data size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens import specs
from presslens.functions.text import _c, ColumnOrName


def mae(df: DataFrame, a: str, b: str) -> DataFrame:
    """AGG-01: mean absolute error and matched count; (null, 0) when nothing matched."""
    return df.agg(F.avg(F.abs(F.col(a) - F.col(b))).alias("mae"),
                  F.count(F.lit(1)).alias("n_matched"))


def verdict(value: ColumnOrName, bands=specs.MAE_VERDICTS, otherwise=specs.MAE_VERDICT_ELSE) -> Column:
    """AGG-20: verdict band on a scalar metric (bounds exclusive)."""
    x = _c(value)
    expr = None
    for hi, name in bands:
        expr = F.when(x < hi, name) if expr is None else expr.when(x < hi, name)
    return expr.otherwise(otherwise)



def macro_f1_from_cells(cells: DataFrame, labels: list[str], by: list[str], n: str = "n") -> DataFrame:
    """AGG-02 from a confusion table (by..., y_true, y_pred, n): TP/FP/FN per
    class, every class in ``labels`` counted (absent ones score 0, 0/0 -> 0),
    averaged per group. Works on the small cell table, not on rows."""
    hit = F.col("y_true") == F.col("y_pred")
    rows = cells.select(*by, F.explode(F.array(
        F.struct(F.col("y_true").alias("cls"), F.when(hit, F.col(n)).otherwise(0).alias("tp"),
                 F.lit(0).cast("bigint").alias("fp"), F.when(~hit, F.col(n)).otherwise(0).alias("fn")),
        F.struct(F.col("y_pred").alias("cls"), F.lit(0).cast("bigint").alias("tp"),
                 F.when(~hit, F.col(n)).otherwise(0).alias("fp"), F.lit(0).cast("bigint").alias("fn")),
    )).alias("e")).select(*by, "e.*").filter(F.col("cls").isNotNull())
    per = rows.groupBy(*by, "cls").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    grid = cells.select(*by).distinct().select(*by, F.explode(F.array(*[F.lit(x) for x in labels])).alias("cls"))
    full = grid.join(per, [*by, "cls"], "left").na.fill(0, ["tp", "fp", "fn"])
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), F.nullif(2 * F.col("tp") + F.col("fp") + F.col("fn"), F.lit(0))),
                    F.lit(0.0))
    return full.groupBy(*by).agg(F.avg(f1.cast("double")).alias("macro_f1"))


def confusion(df: DataFrame, y_true: str, y_pred: str, labels: list[str], by: list[str] | None = None) -> DataFrame:
    """AGG-03: confusion matrix in long form (by..., y_true, y_pred, n) over the
    fixed label order, zero cells included; one grouped pass for all groups."""
    by = by or []
    counts = df.groupBy(*by, F.col(y_true).alias("y_true"), F.col(y_pred).alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n"))
    cells = F.explode(F.array(*[F.struct(F.lit(t).alias("y_true"), F.lit(p).alias("y_pred"))
                                for t in labels for p in labels])).alias("c")
    base = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    grid = base.select(*by, cells).select(*by, "c.*")
    return grid.join(counts, [*by, "y_true", "y_pred"], "left").select(
        *by, "y_true", "y_pred", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def order_bits(v: Column) -> Column:
    """A long that does not fall where the double ``v`` rises: sign, 12 bits of exponent and 50 of mantissa (NaN last)."""
    a = F.abs(v)
    finite = (a > 0) & (a < F.lit(float("inf")))
    size = F.when(finite, a).otherwise(F.lit(1.0))
    near = F.floor(F.log2(size))  # may miss by one beside a power of two
    left = size / F.pow(F.lit(2.0), near)
    e = near + F.when(left >= 2, 1).when(left < 1, -1).otherwise(0)
    mantissa = (size / F.pow(F.lit(2.0), e) - 1) * F.lit(float(1 << 50))
    bits = (e + 1075) * F.lit(1 << 50) + F.floor(mantissa)
    top = F.lit(1 << 62)
    bits = F.when(F.isnan(v), top + 1).when(a == 0, F.lit(0)).when(finite, bits).otherwise(top)
    return F.when(v < 0, -bits).otherwise(bits).cast("bigint")


LEVELS = (42, 20)  # bits below a bucket: 2^20 buckets, then 2^22 in each, then 2^22 values


def values_at(counts: DataFrame, by: str, wanted) -> DataFrame:
    """(``by``, at map<position, value>): the values at 0-based positions of each group's sorted values.

    ``counts`` has (``by``, v double, n) a row a value; ``wanted(total)`` gives the array of positions for a group of so
    many. Radix selection on the order-preserving bits: counts by bucket tell which buckets hold a position, those
    alone are counted by finer buckets, and the last ones by value. No ordered window sees more than 2^22 rows.
    """
    rows = counts.withColumn("__key", order_bits(F.col("v")))
    group = Window.partitionBy(by)
    edges, above, inner = None, 0, group
    for level in LEVELS:
        b = F.shiftright(F.col("__key"), level).alias("__b")
        if edges is None:
            table = rows.groupBy(by, b).agg(F.sum("n").alias("__n"))
            table = table.withColumn("__from", F.lit(0)).withColumn("__ps", wanted(F.sum("__n").over(group)))
        else:
            table = _inside(rows, edges, by, above).groupBy(by, "__in", "__from", "__ps", b).agg(F.sum("n").alias("__n"))
            inner = Window.partitionBy(by, "__in")
        edges, above = _holding(table, inner.orderBy("__b")).select(by, F.col("__b").alias("__in"), "__from", "__ps"), level
    last = _inside(rows, edges, by, above).withColumnRenamed("n", "__n")
    last = _holding(last, Window.partitionBy(by, "__in").orderBy("v"))
    hits = last.select(by, "v", F.explode("__ps").alias("__p"))
    return hits.groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("__p", "v"))).alias("at"))  # a few a group


def _inside(rows: DataFrame, edges: DataFrame, by: str, bits: int) -> DataFrame:
    """Rows of the buckets that hold a position (at most one a position and group: of fixed size)."""
    e = F.broadcast(edges.withColumnRenamed(by, "__by"))
    return rows.join(e, (F.col(by) == F.col("__by")) & (F.shiftright(F.col("__key"), bits) == F.col("__in"))).drop("__by")


def _holding(table: DataFrame, order) -> DataFrame:
    """Rows whose run of positions holds wanted ones, with these and the position they start from."""
    start = F.col("__from") + F.sum("__n").over(order) - F.col("__n")
    t = table.withColumn("__from", start)
    held = F.filter("__ps", lambda p: (p >= F.col("__from")) & (p < F.col("__from") + F.col("__n")))
    return t.withColumn("__ps", held).filter(F.size("__ps") > 0)


def describe(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """AGG-09: per column of ``cols`` (``metric``) count, mean, sample std, min, 25/50/75 % (linear), max.

    One aggregate for the moments of all columns and one for their counts by value, from which the percentiles are
    selected (``values_at``): exact, without a global sort, nothing written. ``approx=True`` uses sketches instead.
    """
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v")) for c in cols]))
                     .alias("e")).select("e.*")
    moments = long.groupBy("metric").agg(F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
                                         F.min("v").alias("min"), F.max("v").alias("max"),
                                         *([F.percentile_approx("v", [0.25, 0.5, 0.75], 10000).alias("q")] if approx else []))
    names = ("p25", "p50", "p75")
    shown = ["metric", "count", "mean", "std", "min", *names, "max"]
    if approx:
        return moments.select("*", *[F.col("q")[i].alias(n) for i, n in enumerate(names)]).select(*shown)
    counts = long.filter("v is not null").groupBy("metric", "v").agg(F.count(F.lit(1)).alias("n"))
    place = lambda total, q: (total - 1) * F.lit(q)
    ends = lambda total: F.array_distinct(F.flatten(F.array(*[
        F.array(F.floor(place(total, q)), F.ceil(place(total, q))) for q in (0.25, 0.5, 0.75)])))
    picked = values_at(counts, "metric", ends)
    out = moments.join(picked, "metric", "left")
    for name, q in zip(names, (0.25, 0.5, 0.75)):
        at = place(F.col("count"), q)
        low, high = (F.try_element_at("at", f(at)) for f in (F.floor, F.ceil))
        out = out.withColumn(name, low + (high - low) * (at - F.floor(at)))
    return out.select(*shown)


def counts_by(df: DataFrame, by: str, dim: DataFrame | None = None, name: str = "n") -> DataFrame:
    """AGG-10/11 (+JOIN-12): rows per value; with ``dim`` (ord, by) every
    dimension value is kept, zero when absent."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias(name))
    if dim is None:
        return counts
    return dim.join(counts, by, "left").select(
        "ord", by, F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name))


def _scalars(df: DataFrame, col: str) -> dict:
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.stddev_samp(col).alias("sd"),
               F.count(col).alias("n")).collect()[0]
    return r.asDict()


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """AGG-12: equal-width bins over [min, max], last bin closed; empty bins kept."""
    x = F.col(col).cast("double")
    dim = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    ends = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()  # within the plan: no job here
    lo, hi = ends.getField("lo"), ends.getField("hi")
    width = F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)
    b = F.least(F.floor((x - lo) / width * F.lit(bins)) + 1, F.lit(bins)).cast("int")
    counts = df.filter(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return dim.join(F.broadcast(counts), "bin", "left").select(  # a row a bin at most
        "bin", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


KDE_BINS = 100  # a bandwidth
KDE_REACH = 38.6  # bandwidths beyond which a kernel is 0 in double precision


def kde(df: DataFrame, col: str, points: int = 200) -> DataFrame:
    """AGG-13: Gaussian kernel density on ``points`` grid values over [min, max],
    Scott bandwidth h = std * n^(-1/5).

    Values fall into bins of h / KDE_BINS; a bin keeps the sums of the powers of its values' distances u from its middle
    (at most 0.005 in bandwidths). With the Hermite polynomials He, exp(-(z-u)^2/2) = exp(-z^2/2) * sum He_k(z) u^k / k!, so the five
    sums of a bin give its kernels at any grid point; what is cut off is under u^5 He_5(z) / 120 of a kernel,
    10^-11 of its peak. One aggregate over the rows, one over (bin, grid point) pairs within reach, whose number depends on
    neither the rows nor, beyond a bin each, the range.
    """
    s = _scalars(df, col)
    lo, hi, sd, n = s["lo"], s["hi"], s["sd"], s["n"]
    spark = df.sparkSession
    if not n or sd is None or sd == 0:
        return spark.createDataFrame([], "g int, x double, density double")
    lo, hi = float(lo), float(hi)
    h = float(sd) * float(n) ** (-0.2)
    step = (hi - lo) / (points - 1)
    width = h / KDE_BINS
    x = F.col(col).cast("double")
    b = F.floor((x - F.lit(lo)) / F.lit(width))
    middle = F.lit(lo) + (F.col("b") + 0.5) * F.lit(width)
    rows = df.filter(x.isNotNull()).select(x.alias("x"), b.alias("b")).select("b", ((F.col("x") - middle) / F.lit(h)).alias("u"))
    u = F.col("u")
    bins = rows.groupBy("b").agg(F.count(F.lit(1)).cast("double").alias("m0"), *[
        (F.sum(power) / F.lit(float(math.factorial(k)))).alias(f"m{k}") for k, power in enumerate((u, u * u, u * u * u, u * u * u * u), 1)])
    near = lambda at: F.least(F.greatest((at - F.lit(lo)) / F.lit(step), F.lit(0.0)), F.lit(float(points - 1)))
    reach = KDE_REACH * h
    bins = bins.select("*", middle.alias("c")).select(
        "*", F.ceil(near(F.col("c") - reach)).cast("int").alias("from"), F.floor(near(F.col("c") + reach)).cast("int").alias("to"))
    hit = bins.filter("from <= to").select("*", F.explode(F.sequence("from", "to")).alias("g"))
    z = (F.lit(lo) + F.col("g") * F.lit(step) - F.col("c")) / F.lit(h)
    hit = hit.withColumn("z", z)
    z = F.col("z")
    kernel = F.exp(z * z * -0.5) * (F.col("m0") + F.col("m1") * z + F.col("m2") * (z * z - 1) + F.col("m3") * z * (z * z - 3)
                                    + F.col("m4") * ((z * z - 6) * z * z + 3))
    sums = hit.groupBy("g").agg(F.sum(kernel).alias("s"))
    norm = 1.0 / (n * h * math.sqrt(2 * math.pi))
    grid = spark.range(points).select(F.col("id").cast("int").alias("g"), (F.lit(lo) + F.col("id") * F.lit(step)).alias("x"))
    return grid.join(F.broadcast(sums), "g", "left").select(  # a row a point
        "g", "x", (F.coalesce(F.col("s"), F.lit(0.0)) * F.lit(norm)).alias("density"))


def source_score(score: ColumnOrName, default: float = specs.DASH_DEFAULT_SCORE) -> Column:
    """The 0-100 score that a mean takes: 0 and null count as the default."""
    return F.coalesce(F.nullif(_c(score), F.lit(0.0)), F.lit(float(default)))


def source_mean_score(df: DataFrame, by: str = "source", score: str = "pct",
                      default: float = specs.DASH_DEFAULT_SCORE) -> DataFrame:
    """AGG-15: per source mean of the 0-100 score with 0/null counted as the
    default, rounded half-up."""
    return df.groupBy(by).agg(F.floor(F.avg(source_score(score, default)) + F.lit(0.5)).cast("bigint").alias("mean_score"))


def totals(df: DataFrame, limit: int = specs.FEED_PAGE_SIZE) -> DataFrame:
    """AGG-14: total rows and pages = ceil(total / limit)."""
    return df.agg(F.count(F.lit(1)).alias("total")).select(
        "total", F.ceil(F.col("total") / F.lit(float(limit))).cast("bigint").alias("pages"))


def newest_per_source(df: DataFrame, by: str = "source", ts: str = "date") -> DataFrame:
    """AGG-17."""
    return df.groupBy(by).agg(F.max(ts).alias("newest"))


def success_counts(df: DataFrame, error: str = "error") -> DataFrame:
    """AGG-18: rows without an error, and all rows."""
    return df.agg(F.count_if(F.col(error).isNull()).alias("ok"), F.count(F.lit(1)).alias("total"))
