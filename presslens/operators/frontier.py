"""Breadth-first expansion over links (SRC-08, JOB-03: sitemaps that point to sitemaps).

A level is what the last one links to, less all that was met before, at most so many per
host. Each level is an equi-join, a distinct, an anti-join and a group limit, written to the shared folder once: the
next level reads it there, cycles end in the anti-join, and a lost executor repeats a part of one level.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.operators.windows import cap_per_group
from presslens.session import shared_dir


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def expand_frontier(roots: DataFrame, links: DataFrame, max_depth: int, per_host: int | None = None) -> DataFrame:
    """(url, host, depth) of all that can be reached from ``roots`` (url, host) over ``links`` (src, dst, host of dst).

    ``per_host`` caps what a level takes of one host (the first in the order of url); a url that was cut off there may
    come in on a deeper level. Ends when a level is empty or ``max_depth`` steps are done. Null urls lead nowhere.
    """
    level = _kept(roots.filter("url is not null").groupBy("url").agg(F.min("host").alias("host")).withColumn("depth", F.lit(0)), "frontier")
    levels = [level]
    for depth in range(1, max_depth + 1):
        met = reduce(DataFrame.union, [x.select("url") for x in levels])
        new = (links.join(level.select(F.col("url").alias("src")), "src").filter("dst is not null")
               .groupBy(F.col("dst").alias("url")).agg(F.min("host").alias("host")).join(met, "url", "left_anti"))
        if per_host is not None:
            new = cap_per_group(new, "host", "url", per_host)
        level = _kept(new.withColumn("depth", F.lit(depth)), "frontier")
        if level.isEmpty():
            break
        levels.append(level)
    return reduce(DataFrame.union, levels)
