"""SimHash near-duplicates found with BK-trees.

A document's fingerprint is the bitwise majority of the 64-bit hashes of its word
shingles. Distinct fingerprints (equal ones fall together before anything else) are
dealt to shards; each shard's BK-tree has a fingerprint at every node and keys a
node's children by their integer Hamming distance to it, so a search of radius r from a node at
distance d follows only the edges d-r .. d+r. Trees are broadcast while all of them together stay under a
size that is checked, and joined by shard beyond it.

Dealing: with radius r, two linked fingerprints agree in one of r+1 bit blocks at
least. Each fingerprint goes to r+1 shards, one for each block's value, and is looked up
in those alone. A shard too large for one tree (many fingerprints with one block value) is
split into several, and its members are looked up in each of them as separate work. Every lookup returns a
spanning forest of the links it finds, not the links themselves.

Defined cases: a null text, an empty one and one of white space have no words; their
fingerprint is zero and links like any other. Fewer words than a shingle make one shingle.
Repeated rows share a fingerprint; a group without any non-null id has a null component. Other columns are left alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import components, small_batches, written

SEED = 42


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit SimHash of a text (A-Z lower-cased, words by ASCII white space)."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    ends = (ends - 1).tolist()[min(shingle, len(words)) - 1:]
    h = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(ends))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 14):
        part = h[i:i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column | str, shingle: int = 3) -> Column:
    """The fingerprint as a (signed) long."""
    @F.pandas_udf("long")
    def make(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(x, shingle) for x in texts], np.uint64).view(np.int64))
    return make(text)


class BKTree:
    """A BK-tree over distinct 64-bit values, as arrays: value, parent and edge of every node."""

    def __init__(self, values: np.ndarray, parent: np.ndarray | None = None, edge: np.ndarray | None = None):
        self.values = values
        n = len(values)
        if parent is None:
            parent, edge = np.full(n, -1, np.int32), np.zeros(n, np.uint8)
            rest, at = np.arange(1, n), np.zeros(max(n - 1, 0), np.int64)
            while len(rest):  # all values go one level down at a time
                d = np.bitwise_count(values[rest] ^ values[at]).astype(np.int64)
                _, first, group = np.unique(at * 65 + d, return_index=True, return_inverse=True)
                child = rest[first]
                parent[child], edge[child] = at[first], d[first]
                at = child[group]
                more = at != rest
                rest, at = rest[more], at[more]
        self.parent, self.edge = parent, edge
        self.child = np.full((n, 65), -1, np.int32)  # by edge: the Hamming distance to the parent
        kids = np.flatnonzero(parent >= 0)
        self.child[parent[kids], edge[kids]] = kids

    def dump(self) -> bytes:
        return self.values.astype("<u8").tobytes() + self.parent.astype("<i4").tobytes() + self.edge.tobytes()

    @classmethod
    def load(cls, data: bytes) -> BKTree:
        n = len(data) // 13
        return cls(np.frombuffer(data, "<u8", n), np.frombuffer(data, "<i4", n, 8 * n),
                   np.frombuffer(data, np.uint8, n, 12 * n))

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) index pairs at most ``radius`` apart."""
        q, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        found_q, found_n = [], []
        while len(q):
            d = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
            near = d <= radius
            found_q.append(q[near])
            found_n.append(node[near])
            next_q, next_n = [], []
            for e in range(-radius, radius + 1):
                to = d + e
                ok = np.flatnonzero((to > 0) & (to <= 64))
                kid = self.child[node[ok], to[ok]]
                ok, kid = ok[kid >= 0], kid[kid >= 0]
                next_q.append(q[ok])
                next_n.append(kid)
            q, node = np.concatenate(next_q), np.concatenate(next_n).astype(np.int64)
        return np.concatenate(found_q), np.concatenate(found_n)


def forest(a: np.ndarray, b: np.ndarray, n: int, label: np.ndarray | None = None) -> np.ndarray:
    """Labels of 0..n-1 after joining every a[i] with b[i]: the smallest index of the set."""
    label = np.arange(n) if label is None else label
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while (label[label] != label).any():
            label = label[label]


def _plant(pdf: pd.DataFrame) -> pd.DataFrame:
    tree = BKTree(np.sort(pdf["fp"].to_numpy(np.int64).view(np.uint64)))
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "chunk": [pdf["chunk"].iloc[0]],
                         "chunks": [pdf["chunks"].iloc[0]], "tree": [tree.dump()]})


def _search(radius: int, queries_at_once: int = 1024):
    def run(batches):
        for pdf in batches:
            for data, other in zip(pdf["members"], pdf["tree"]):
                tree = BKTree.load(other)
                queries = np.frombuffer(data, "<u8", len(data) // 13)
                same = data == other
                n = len(queries)
                label = np.arange(n if same else n + len(tree.values))
                for i in range(0, n, queries_at_once):
                    q, node = tree.within(queries[i:i + queries_at_once], radius)
                    label = forest(q + i, node if same else node + n, len(label), label)
                values = queries if same else np.concatenate([queries, tree.values])
                tied = np.flatnonzero(label != np.arange(len(label)))
                yield pd.DataFrame({"fp": values[tied].view(np.int64), "root": values[label[tied]].view(np.int64)})
    return run


def link_fingerprints(fps: DataFrame, radius: int = 2, tree_size: int = 4096,
                      broadcast_bytes: int = 32 << 20) -> DataFrame:
    """(fp, component) of all distinct fingerprints that link with another; component: the smallest of the set."""
    fps = written(fps.select("fp").distinct(), "fps")
    total = fps.count()
    shards = -(-total // tree_size) or 1
    widths = [64 // (radius + 1) + (i < 64 % (radius + 1)) for i in range(radius + 1)]
    blocks, low = [], 0
    for i, w in enumerate(widths):
        value = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << w) - 1))
        blocks.append(F.pmod(F.xxhash64(F.lit(i), value), F.lit(shards)) * (radius + 1) + i)
        low += w
    members = fps.select("fp", F.explode(F.array(*blocks)).alias("shard"))
    large = members.groupBy("shard").count().where(F.col("count") > 2 * tree_size)  # total / tree_size rows at most
    members = (members.join(large, "shard", "left")
               .withColumn("chunks", F.coalesce(F.ceil(F.col("count") / tree_size), F.lit(1)).cast("long"))
               .withColumn("chunk", F.pmod(F.xxhash64("fp", F.lit(7)), "chunks")))
    trees = written(members.select("shard", "chunk", "chunks", "fp").groupBy("shard", "chunk").applyInPandas(
        _plant, "shard long, chunk long, chunks long, tree binary"), "trees")
    lookups = trees.select("shard", F.col("tree").alias("members"),
                           F.explode(F.sequence("chunk", F.col("chunks") - 1)).alias("chunk"))
    targets = trees.select("shard", "chunk", "tree")
    if (trees.agg(F.sum(F.length("tree"))).first()[0] or 0) <= broadcast_bytes:
        targets = F.broadcast(targets)
    edges = lookups.join(targets, ["shard", "chunk"]).select("members", "tree").mapInPandas(
        _search(radius), "fp long, root long")
    return components(edges.distinct()).select(F.col("node").alias("fp"), "component")


def near_duplicate_groups(fps: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``fps`` (``id_col``, fp, any more) with component_id: the smallest id among all documents
    reachable by links. ``fps`` is read several times; pass a written table."""
    firsts = fps.groupBy("fp").agg(F.min(id_col).alias("_first"))
    group = firsts.join(link_fingerprints(firsts, **options), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    group = written(group, "groups")
    least = group.groupBy("component").agg(F.min("_first").alias("component_id"))
    return fps.join(group.select("fp", "component").join(least, "component").drop("component"), "fp")


def keep_one(docs: DataFrame, shingle: int = 3, **options) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with the smallest doc_id (nulls
    last), the first of repeated rows."""
    small_batches(docs.sparkSession)
    keyed = written(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("uid"),
                                fingerprint_column("text", shingle).alias("fp")), "keyed")
    groups = near_duplicate_groups(keyed.select("fp", F.col("doc.doc_id").alias("doc_id"), "uid"), "uid", **options)
    kept = groups.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "uid")).getField("uid").alias("uid"))
    return keyed.join(kept.select("uid"), "uid", "left_semi").select("doc.*")
