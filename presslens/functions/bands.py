"""Score bands and classes (MTH-01..07) built from band specs (data)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens import specs
from presslens.functions.text import _c, ColumnOrName


def ideology_class(c: ColumnOrName, edges=specs.IDEOLOGY_EDGES,
                   labels=specs.IDEOLOGY_CLASSES) -> Column:
    """MTH-01: 7-class ideology on a numeric or numeric-string score.

    Values <= edge[i] fall in class i, beyond the last edge in the last class;
    non-numeric -> null. NaN is greater than every number, so it lands in the
    top class, as a float comparison chain does.
    """
    x = _c(c).try_cast("double")
    expr = None
    for e, lab in zip(edges, labels):
        expr = F.when(x <= e, lab) if expr is None else expr.when(x <= e, lab)
    return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(labels[-1]))


def cut(c: ColumnOrName, spec=specs.RANGE5_EVEN) -> Column:
    """MTH-02: right-closed bins with the lowest edge included; outside -> null."""
    x = _c(c)
    edges, labels = spec["edges"], spec["labels"]
    expr = F.when((x >= edges[0]) & (x <= edges[1]), labels[0])
    for lo, hi, lab in zip(edges[1:-1], edges[2:], labels[1:]):
        expr = expr.when((x > lo) & (x <= hi), lab)
    return expr



def band_dimension(spark: SparkSession, spec=specs.RANGE5_EVEN, name: str = "band") -> DataFrame:
    """The band spec as a tiny (ord, band) dimension table for zero-filled counts."""
    rows = [(i + 1, lab) for i, lab in enumerate(spec["labels"])]
    return spark.createDataFrame(rows, f"ord int, {name} string")


def class_dimension(spark: SparkSession, labels=specs.IDEOLOGY_CLASSES, name: str = "cls") -> DataFrame:
    rows = [(i + 1, lab) for i, lab in enumerate(labels)]
    return spark.createDataFrame(rows, f"ord int, {name} string")


def lean_feed(c: ColumnOrName, lo_hi=specs.LEAN_FEED) -> Column:
    """MTH-03: < lo Left, > hi Right, else Center."""
    x = _c(c)
    lo, hi = lo_hi
    return F.when(x > hi, "Right").when(x < lo, "Left").otherwise("Center")


def lean_analyzer(c: ColumnOrName, lo_hi=specs.LEAN_ANALYZER) -> Column:
    """MTH-04: <= lo Left, >= hi Right, else Center."""
    x = _c(c)
    lo, hi = lo_hi
    return F.when(x <= lo, "Left").when(x >= hi, "Right").otherwise("Center")


def lean_dash(c: ColumnOrName, lo_hi=specs.LEAN_DASH) -> Column:
    """MTH-05: on 0-100, <= lo Left, <= hi Center, else Right."""
    x = _c(c)
    lo, hi = lo_hi
    return F.when(x <= lo, "Left").when(x <= hi, "Center").otherwise("Right")


def pct(c: ColumnOrName) -> Column:
    """MTH-06: score x 100 as double."""
    return _c(c) * F.lit(100.0)


def pct_int(c: ColumnOrName) -> Column:
    """MTH-06: int(score * 100), truncating (0.29 -> 28 in IEEE doubles);
    NaN / out of range -> null instead of failing the task."""
    return (_c(c) * F.lit(100.0)).try_cast("int")


def default_score_feed(c: ColumnOrName, default: float = specs.FEED_DEFAULT_SCORE) -> Column:
    """MTH-07 (feed): ``x || default``: 0, null and NaN become the default; -1 stays."""
    x = _c(c).cast("double")
    return F.coalesce(F.nullif(F.nanvl(x, F.lit(0.0)), F.lit(0.0)), F.lit(float(default)))


def default_score_analyzer(c: ColumnOrName, default: float = specs.FEED_DEFAULT_SCORE) -> Column:
    """MTH-07 (analyzer): missing or the -1 failure sentinel -> default."""
    x = _c(c).cast("double")
    return F.when(x.isNull() | (x == -1.0), F.lit(float(default))).otherwise(x)
