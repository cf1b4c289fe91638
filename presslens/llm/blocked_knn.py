"""Nearest neighbours by a block matrix join.

Queries and candidates are cut into blocks of rows, each row scaled to unit
length and quantised to int8. For a block of queries and one of candidates the
product of the int8 matrices gives all cosines at once, each with a bound of its
quantisation error; pairs whose upper bound reaches the k-th best lower bound
(of this tile, or the k-th best found so far) are recomputed in double
precision from the original vectors and kept in a heap per query. The heaps of
all tasks meet in a top-k by query.

The search is exact: a bound never excludes one of the k nearest.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite
component take no part, nor do rows without an id; vectors of different lengths are
not compared; a candidate with the query's id is the query's own row; ties go to the
smaller id; a repeated query row is answered once; no rows give an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm.common import partitions, written
from presslens.llm.vectors import cosines, matrix, pack, pack_matrix, unit, usable


def _blocks(rows: int):
    """Rows (id, vec) of a partition -> blocks of at most ``rows`` vectors of one length."""
    def run(batches):
        for pdf in batches:
            dims = pdf["vec"].map(len)
            for dim, part in pdf.groupby(dims):
                for i in range(0, len(part), rows):
                    own = part.iloc[i:i + rows]
                    yield pd.DataFrame({"dim": [dim], "n": [len(own)], "ids": [pack(own["id"].to_numpy("<i8"))],
                                        "vecs": [pack_matrix(np.stack(own["vec"].to_numpy()).astype(np.float64))]})
    return run


def quantise(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales and error norms of unit rows: row = scale * codes + a rest of that norm."""
    scale = np.abs(m).max(axis=1) / 127.0
    codes = np.rint(m / scale[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(m - codes * scale[:, None], axis=1)


def bounds(q: tuple, c: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Approximate cosines of all pairs of two quantised blocks, and what they can be off by."""
    (qc, qs, qe), (cc, cs, ce) = q, c
    # sums of int8 products are exact in float32 below 2^24, so the fast product of floats serves
    kind = np.float32 if qc.shape[1] * 127 * 127 < 1 << 24 else np.float64
    near = (qc.astype(kind) @ cc.astype(kind).T) * (qs[:, None] * cs[None, :]).astype(kind)
    off = (1 + qe)[:, None] * ce[None, :] + qe[:, None] * (1 + 2 * ce)[None, :] + 1e-6
    return near, off.astype(kind)


def _search(k: int, held: int = 1 << 20):
    def run(batches):
        heaps: dict[int, list] = {}

        def flush():
            rows = [(q, -v, s) for q, h in heaps.items() for s, v in h]
            heaps.clear()
            return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

        for pdf in batches:
            for dim, q_ids, q_vecs, c_ids, c_vecs in zip(pdf["dim"], pdf["q_ids"], pdf["q_vecs"], pdf["ids"], pdf["vecs"]):
                qi, ci = np.frombuffer(q_ids, "<i8"), np.frombuffer(c_ids, "<i8")
                qm, cm = matrix(q_vecs, dim), matrix(c_vecs, dim)
                near, off = bounds(quantise(unit(qm)), quantise(unit(cm)))
                own = qi[:, None] == ci[None, :]
                low, high = near - off, near + off
                low[own], high[own] = -4, -4
                floor = np.array([heaps[x][0][0] if len(heaps.get(x, ())) >= k else -3.0 for x in qi])
                if len(ci) > k:
                    floor = np.maximum(floor, np.partition(low, len(ci) - k, axis=1)[:, len(ci) - k])
                a, b = np.nonzero(high >= (floor - 1e-6)[:, None])
                for i in range(0, len(a), 1 << 16):
                    x, y = a[i:i + (1 << 16)], b[i:i + (1 << 16)]
                    for q, v, s in zip(qi[x].tolist(), ci[y].tolist(), cosines(qm[x], cm[y]).tolist()):
                        h = heaps.setdefault(q, [])
                        if len(h) < k:
                            heapq.heappush(h, (s, -v))
                        elif (s, -v) > h[0]:
                            heapq.heapreplace(h, (s, -v))
            if len(heaps) > held:
                yield flush()
        yield flush()
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            query_rows: int = 512, candidate_rows: int = 2048, group_rows: int = 1 << 16) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the ``k`` rows of largest cosine for each query row.

    Candidates stay in groups of ``group_rows`` or, of few, so many groups that all tasks have some; each group gets a
    copy of the query blocks, and the group is the key of an equi-join.
    """
    rows = written(vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"),
                                  F.coalesce(is_query, F.lit(False)).alias("q"))
                   .where(usable(F.col("vec")) & F.col("id").isNotNull()), "vectors")
    n, tasks = rows.count(), partitions(vectors.sparkSession)
    groups = max(-(-n // group_rows), min(2 * tasks, -(-n // candidate_rows)), 1)
    schema = "dim int, n int, ids binary, vecs binary"
    queries = (rows.where("q").dropDuplicates(["id", "vec"]).select("id", "vec").mapInPandas(_blocks(query_rows), schema)
               .select("dim", F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs"),
                       F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp")))
    cands = (rows.select("id", "vec").mapInPandas(_blocks(candidate_rows), schema)
             .withColumn("grp", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int")))
    # dealt by number: small groups are not put together again
    cands, queries = (x.repartition(tasks, "dim", "grp") for x in (cands, queries))
    found = cands.join(queries, ["dim", "grp"]).select("dim", "q_ids", "q_vecs", "ids", "vecs").mapInPandas(
        _search(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
