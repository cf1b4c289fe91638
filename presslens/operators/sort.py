"""Sorts, pages and limits (SRT-01..05). Paging keeps a bounded top-(offset+limit)
of every task and of groups of tasks, never a full sort of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens import specs


def page(df: DataFrame, page_no=1, limit=specs.FEED_PAGE_SIZE,
         order: list[Column] | None = None) -> DataFrame:
    """SRT-01: page ``page_no`` (1-based) of ``limit`` rows, newest first with
    ``_id`` as tie-break. 0 / None / non-numeric page or limit -> defaults."""
    def as_int(x, default):
        try:
            v = int(x)
        except (TypeError, ValueError):
            return default
        return v or default
    p, n = as_int(page_no, 1), as_int(limit, specs.FEED_PAGE_SIZE)
    order = order or [F.col("date").desc_nulls_last(), F.col("_id").asc()]
    return top_k(df, n, order, offset=max(p - 1, 0) * n)


def top_k(df: DataFrame, k: int, order: list[Column], offset: int = 0, spread: int = 64) -> DataFrame:
    """Rows ``offset .. offset+k-1`` in ``order`` (which must be a total order).

    A merge of the best offset+k rows of every task would give one task that many rows
    from each; so the tasks are first merged in ``spread`` parts (a window group limit, which also runs
    before its shuffle), and the last task gets the best of those.
    """
    m = offset + k
    w = Window.partitionBy("__tk").orderBy(*order)
    first = (df.withColumn("__tk", F.pmod(F.spark_partition_id(), F.lit(spread)))
             .withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= m)
             .drop("__tk", "__rn"))
    return first.orderBy(*order).offset(offset).limit(k)


def page_after(df: DataFrame, after: tuple | None = None, limit: int = specs.FEED_PAGE_SIZE, date: str = "date",
               key: str = "_id") -> DataFrame:
    """SRT-01 by cursor: the ``limit`` rows that follow the row (date, key) ``after`` (None: the first ones), newest first,
    rows without a date last, ``key`` as tie-break.

    The cursor is the last row of the page before, so a page costs the same however deep it lies: its date is a filter
    on the scan, and over files sorted by date (``lay_out_by_date``) only those that can hold the page are read.
    """
    if after is not None:
        d, k = after
        tie = F.col(key) > F.lit(k)
        if d is None:
            df = df.filter(F.col(date).isNull() & tie)
        else:
            # said once more without the key, as a plain range that reaches the scan
            older = (F.col(date) <= F.lit(d)) | F.col(date).isNull()
            df = df.filter(older & ((F.col(date) < F.lit(d)) | F.col(date).isNull() | tie))
    return top_k(df, limit, [F.col(date).desc_nulls_last(), F.col(key).asc()])


def cursor_of(page: DataFrame, date: str = "date", key: str = "_id") -> tuple | None:
    """(date, key) of the last row of a page; None of an empty one."""
    last = page.orderBy(F.col(date).asc_nulls_first(), F.col(key).desc()).select(date, key).first()
    return tuple(last) if last else None


def lay_out_by_date(df: DataFrame, path: str, date: str = "date", files: int | None = None) -> None:
    """Parquet sorted by date over files: each file (and row group) covers a range of dates of its own."""
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, F.col(date).desc()).sortWithinPartitions(F.col(date).desc()).write.parquet(path)


def recent(df: DataFrame, n: int = specs.RECENT_SIZE) -> DataFrame:
    """SRT-02."""
    return page(df, 1, n)


def cap_rows(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """SRT-03: item cap per run, deterministic by ``order``."""
    return df.orderBy(*order).limit(n)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """SRT-05."""
    return df.limit(n)
