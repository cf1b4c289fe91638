"""Prefix trie of conversations, built from ternary search trees.

Turns (role, text) are dictionary-encoded: every distinct one gets a number. Equal conversations
fall together first, then the distinct sequences of numbers are sorted and dealt to range
shards. Each shard inserts its sequences into a ternary search tree, the middle one first and
then the middle ones of both halves, so that the branches over the sorted
numbers are balanced, and walks the nodes from last to first, without recursion, to add up members, leaves and
savings below each.

Only nodes above a shard's first or last sequence can also be in another shard. They
carry a digest of their path: equal digests merge. A merged node's subtree is what its shards
found, less what they found below merged children, plus those children's merged subtrees;
the sums over the small tree of merged nodes double their reach every round.

Long conversations are cut into segments of a fixed number of turns, each with a digest of all that
comes before it, so that neither a row nor a shard ever holds a whole one. A segment's
root is the last node of the segment before, and the two merge like boundary nodes.

Defined cases: null roles and texts become empty; a null turn number comes first; turns of equal
number go by role, then text; repeated rows are repeated turns; rows without a conv_id belong to no
conversation; texts of any length count; an empty table gives no nodes; other columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm.common import partitions, word_count, written

SEGMENT = 256  # turns
_SHARD_IDS = 1 << 18  # turn numbers a search tree is built of at most, but for one sequence more
_IDS_CHUNK = 4096  # conversation ids in one row on their way to a hash

_NODES = ("key string, up string, real boolean, open boolean, depth long, conv_id long, parent_conv_id long, n_convs long, "
          "n_children long, n_leaves long, saved_tokens long, words long, ending string")


def encode_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos from 0, tid, words) of turns (conv_id, turn, role, text): places in the conversation, turn numbers
    and the words of their texts."""
    spark, empty = turns.sparkSession, F.lit("")
    rows = turns.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"),
        F.monotonically_increasing_id().alias("tie"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "tie"]
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    # a conversation of many turns may cover several range partitions: its rows in the ones before count first
    t = written(rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
                .select("conv_id", digest.alias("digest"), word_count(F.col("text")).alias("words"),
                        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")), "turns")
    held = t.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = (held.withColumn("before", F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n"))
              .where("before > 0").select("conv_id", "part", "before"))  # at most one a range partition
    place = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy("row")) - 1
    t = t.withColumn("place", place).join(F.broadcast(before), ["conv_id", "part"], "left")
    numbers = written(t.select("digest").distinct().select("digest", F.monotonically_increasing_id().alias("tid")), "dictionary")
    return written(t.join(numbers, "digest").select(
        "conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).cast("long").alias("pos"), "tid", "words"), "encoded")


def _segments(encoded: DataFrame, conversations: DataFrame, segment: int) -> DataFrame:
    """(conv_id, seg, ids, words, length, before, after): ``before`` and ``after`` are digests of all up to
    the segment and with it (the empty string at the start; ``after`` only of full segments)."""
    rows = encoded.join(conversations, "conv_id")
    parts = rows.groupBy("conv_id", F.floor(F.col("pos") / segment).alias("seg")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "tid", "words"))).alias("turns"), F.first("length").alias("length"))
    parts = parts.select("conv_id", "seg", F.col("turns.tid").alias("ids"), F.col("turns.words").alias("words"), "length")
    none = F.array().cast("array<bigint>")
    bare = conversations.where("length = 0").select(
        "conv_id", F.lit(0).cast("long").alias("seg"), none.alias("ids"), none.alias("words"), "length")
    parts = written(parts.union(bare), "segments")
    # sums of hashes of (place, content) tell what comes before; one narrow row a segment
    content = F.concat_ws(",", F.col("ids").cast("array<string>"))
    long = parts.where(F.col("length") >= segment).select("conv_id", "seg", "length", *[
        F.xxhash64(F.lit(k), F.col("seg"), F.sha2(content, 256)).cast("decimal(38,0)").alias(f"h{k}") for k in (1, 2)])
    order = Window.partitionBy("conv_id").orderBy("seg")
    told = lambda *h: F.concat_ws(":", *[x.cast("string") for x in h])
    sums = [F.sum(f"h{k}").over(order) for k in (1, 2)]
    long = long.select("conv_id", "seg", told(*[s - F.col(f"h{k}") for k, s in zip((1, 2), sums)]).alias("before"), told(*sums).alias("after"))
    long = long.withColumn("before", F.when(F.col("seg") == 0, F.lit("")).otherwise(F.col("before")))
    full = F.size("ids") == segment
    short = parts.where(F.col("length") < segment).select("*", F.lit("").alias("before"), F.lit(None).cast("string").alias("after"))
    return short.union(parts.where(F.col("length") >= segment).join(long, ["conv_id", "seg"])
                       .withColumn("after", F.when(full, F.col("after"))).select(*short.columns))


class SearchTree:
    """A ternary search tree over sequences of numbers: for every node its symbol, smaller and larger siblings,
    first child, parent, and the sums of what was inserted through it. Node 0 is the root."""

    def __init__(self):
        self.symbol, self.lower, self.higher, self.child, self.parent = [-1], [-1], [-1], [-1], [-1]
        self.depth, self.members, self.least, self.words, self.children = [0], [0], [None], [0], [0]
        self.ending: dict[int, str] = {}

    def _new(self, symbol: int, words: int, parent: int) -> int:
        for column, value in ((self.symbol, symbol), (self.lower, -1), (self.higher, -1), (self.child, -1), (self.parent, parent),
                              (self.depth, self.depth[parent] + 1), (self.members, 0), (self.least, None), (self.words, words), (self.children, 0)):
            column.append(value)
        self.children[parent] += 1
        return len(self.symbol) - 1

    def _step(self, node: int, symbol: int, words: int) -> int:
        at = self.child[node]
        if at < 0:
            self.child[node] = self._new(symbol, words, node)
            return self.child[node]
        while symbol != self.symbol[at]:
            side = self.lower if symbol < self.symbol[at] else self.higher
            if side[at] < 0:
                side[at] = self._new(symbol, words, node)
                return side[at]
            at = side[at]
        return at

    def insert(self, ids, words, members: int, least: int, ending: str | None) -> list[int]:
        """Inserts a sequence; the nodes of its path."""
        path, node = [0], 0
        for symbol, w in zip(ids, words):
            node = self._step(node, symbol, w)
            path.append(node)
        for node in path:
            self.members[node] += members
            if self.least[node] is None or least < self.least[node]:
                self.least[node] = least
        if ending is not None:
            self.ending[path[-1]] = ending
        return path

    def totals(self) -> tuple[list[int], list[int]]:
        """Leaves and savings in the subtree of every node; a child always comes after its parent."""
        leaves = [0 if c else 1 for c in self.children]
        saved = [(m - 1) * w for m, w in zip(self.members, self.words)]
        for node in range(len(leaves) - 1, 0, -1):
            leaves[self.parent[node]] += leaves[node]
            saved[self.parent[node]] += saved[node]
        return leaves, saved


def median_order(n: int) -> list[int]:
    """0..n-1, the middle first, then the middles of both halves, and so on."""
    out, todo = [], [(0, n)]
    while todo:
        lo, hi = todo.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            out.append(mid)
            todo += [(mid + 1, hi), (lo, mid)]
    return out


def _path_keys(before: str, ids, after: str | None) -> list[str]:
    """Digests of the paths to a sequence's nodes."""
    h, out = hashlib.blake2b(before.encode(), digest_size=16), [before]
    for i in ids:
        h.update(int(i).to_bytes(8, "little", signed=True))
        out.append(h.hexdigest())
    if after is not None:
        out[-1] = after
    return out


def _subtree(rows: list, first: bool, last: bool, segment: int) -> pd.DataFrame:
    """The nodes under one digest of a shard; its first and last sequences may go on in the shards beside."""
    tree, seg = SearchTree(), rows[0].seg
    keys: dict[int, str] = {}
    unfinished: set[int] = set()
    if seg:
        keys[0] = rows[0].before
        unfinished.add(0)
    for i in median_order(len(rows)):
        r = rows[i]
        path = tree.insert(r.ids.tolist(), r.words.tolist(), r.n, r.conv_id, r.ending)
        if r.more or (first and i == 0) or (last and i == len(rows) - 1):
            keys.update(zip(path, _path_keys(r.before, r.ids, r.after)))
            if r.more:
                unfinished.update(path)
    leaves, saved = tree.totals()
    n = len(leaves)
    parent = np.array(tree.parent)
    real = np.array([not (seg and i == 0) for i in range(n)])
    known = [keys.get(i) for i in range(n)]
    return pd.DataFrame({
        "key": known, "up": [keys.get(p) if p >= 0 else None for p in tree.parent], "real": real,
        "open": [i in unfinished for i in range(n)], "depth": np.array(tree.depth, np.int64) + seg * segment,
        "conv_id": np.array(tree.least, np.int64),
        "parent_conv_id": pd.array([tree.least[p] if p >= 0 else None for p in parent], dtype="Int64"),
        "n_convs": np.where(real, tree.members, 0), "n_children": tree.children, "n_leaves": leaves, "saved_tokens": saved,
        "words": tree.words, "ending": [tree.ending.get(i) for i in range(n)]})


def _shards(segment: int):
    def build(rows: list):
        start = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i].before != rows[start].before:
                yield _subtree(rows[start:i], start == 0, i == len(rows), segment)
                start = i

    def run(batches):
        rows, held = [], 0
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if rows and held + len(r.ids) > _SHARD_IDS:
                    yield from build(rows)
                    rows, held = [], 0
                rows.append(r)
                held += len(r.ids) + 1
        yield from build(rows)
    return run


def _merge(nodes: DataFrame) -> DataFrame:
    """The nodes with digests, one row each, with whole subtree sums."""
    real = F.col("real")
    own = lambda c: F.sum(F.when(real, F.col(c)).otherwise(0))
    m = written(nodes.where("key is not null").groupBy("key").agg(
        F.max("up").alias("up"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.max("words").alias("words"),
        F.max("ending").alias("ending"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        own("n_leaves").alias("up_leaves"), own("saved_tokens").alias("up_saved"), F.count(F.when(real, 1)).alias("copies"),
        F.count(F.when(real & (F.col("n_children") == 0), 1)).alias("bare"), F.max("open").alias("open"))
        .withColumn("open", F.col("open") | (F.col("copies") > 1)), "merged")
    below = m.where("open and up is not null").groupBy(F.col("up").alias("key")).agg(
        F.sum("up_leaves").alias("_leaves"), F.sum("up_saved").alias("_saved"), F.sum(F.col("copies") - 1).alias("_again"))
    zero = F.lit(0)
    m = m.join(below, "key", "left").withColumn("n_children", F.col("n_children") - F.coalesce("_again", zero))
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0)
    m = m.withColumn("n_leaves", F.when(F.col("open"), F.col("n_leaves") - F.col("bare") + leaf - F.coalesce("_leaves", zero)).otherwise(F.col("n_leaves")))
    m = m.withColumn("saved_tokens", F.when(F.col("open"), F.col("saved_tokens") + (F.col("copies") - 1) * F.col("words")
                                            - F.coalesce("_saved", zero)).otherwise(F.col("saved_tokens")))
    m = written(m.select("key", "up", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ending", "open"), "merged")
    # open nodes so far have what lies below without their open children: reach 1, 2, 4, ... steps down
    sums = m.where("open").select("key", F.col("up").alias("far"), "n_leaves", "saved_tokens")
    while sums.where("far is not null").take(1):
        more = sums.where("far is not null").groupBy(F.col("far").alias("key")).agg(F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"))
        jump = sums.select(F.col("key").alias("far"), F.col("far").alias("next"))
        reached = sums.where("far is not null").select("key", "far").join(jump, "far").select("key", "next")
        sums = written(sums.join(more, "key", "left").join(reached, "key", "left").select(
            "key", F.col("next").alias("far"), (F.col("n_leaves") + F.coalesce("_leaves", zero)).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("_saved", zero)).alias("saved_tokens")), "sums")
    whole = sums.select("key", F.col("n_leaves").alias("_leaves"), F.col("saved_tokens").alias("_saved"))
    return written(m.join(whole, "key", "left").withColumn("n_leaves", F.coalesce("_leaves", "n_leaves"))
                   .withColumn("saved_tokens", F.coalesce("_saved", "saved_tokens")).drop("_leaves", "_saved", "open"), "merged")


def _join_ids(batches):
    for pdf in batches:
        endings, ids = pdf["ending"].tolist(), pdf["conv_id"].tolist()
        out, start = [], 0
        for i in range(1, len(ids) + 1):
            if i == len(ids) or endings[i] != endings[start] or i - start == _IDS_CHUNK:
                out.append((endings[start], ids[start], ",".join(map(str, ids[start:i]))))
                start = i
        yield pd.DataFrame(out, columns=["ending", "first", "ids"])


def _hash_ids(batches):
    at, h = None, None
    for pdf in batches:
        out = []
        for ending, ids in zip(pdf["ending"], pdf["ids"]):
            if ending == at:
                h.update(b",")
            else:
                if h is not None:
                    out.append((at, h.hexdigest()))
                at, h = ending, hashlib.sha256()
            h.update(ids.encode())
        yield pd.DataFrame(out, columns=["ending", "ends_sha256"])
    if h is not None:
        yield pd.DataFrame([(at, h.hexdigest())], columns=["ending", "ends_sha256"])


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(ending, ends_sha256) of (ending, conv_id): ids in order, joined piece by piece, then streamed through one hash."""
    n = partitions(ends.sparkSession)
    pieces = (ends.repartitionByRange(n, "ending", "conv_id").sortWithinPartitions("ending", "conv_id")
              .mapInPandas(_join_ids, "ending string, first long, ids string"))
    return pieces.repartition(n, "ending").sortWithinPartitions("ending", "first").select("ending", "ids").mapInPandas(
        _hash_ids, "ending string, ends_sha256 string")


def prefix_trie(encoded: DataFrame, conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The trie of turn sequences ``encoded`` (conv_id, pos, tid, words) of ``conversations`` (conv_id, length).

    Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (words
    that its subtree stores once instead of once a member) and ends_sha256 (of the ids of the members that end here).
    """
    spark = encoded.sparkSession
    n = partitions(spark)
    last = F.col("length") <= (F.col("seg") + 1) * segment
    path: Column = F.sha2(F.concat_ws("|", F.col("before"), F.concat_ws(",", F.col("ids").cast("array<string>"))), 256)
    segs = written(_segments(encoded, conversations, segment).select(
        "conv_id", "seg", "ids", "words", "before", "after", last.alias("last"), path.alias("path")), "paths")
    distinct = segs.groupBy("path").agg(
        *[F.first(c).alias(c) for c in ("seg", "ids", "words", "before", "after")], F.count("*").alias("n"),
        F.min("conv_id").alias("conv_id"), F.max(~F.col("last")).alias("more"), F.max("last").alias("ends"))
    distinct = distinct.select("seg", "ids", "words", "before", "after", "n", "conv_id", "more",
                               F.when(F.col("ends"), F.col("path")).alias("ending"))
    nodes = written(distinct.repartitionByRange(n, "before", "ids").sortWithinPartitions("before", "ids")
                    .mapInPandas(_shards(segment), _NODES), "nodes")
    merged = _merge(nodes)
    names = merged.select(F.col("key").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ending"]
    inner = nodes.where("key is null")
    hung = inner.where("up is not null").drop("parent_conv_id").select("up", *[c for c in out if c != "parent_conv_id"])
    hung = hung.union(merged.select(*hung.columns)).join(names, "up", "left")
    whole = written(inner.where("up is null").select(*out).union(hung.select(*out)), "whole")
    hashes = _end_hashes(segs.where("last").select(F.col("path").alias("ending"), "conv_id"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest()).alias("ends_sha256")
    kept = [c for c in out if c != "ending"]
    ended = whole.where("ending is not null").join(hashes, "ending").select(*kept, "ends_sha256")
    return ended.union(whole.where("ending is null").select(*kept, nothing))


def lengths(encoded: DataFrame) -> DataFrame:
    """(conv_id, length) of encoded conversations."""
    return encoded.groupBy("conv_id").agg(F.count("*").alias("length"))


def conversation_trie(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The prefix trie of turns (conv_id, turn, role, text) as they are."""
    encoded = encode_turns(turns)
    return prefix_trie(encoded, lengths(encoded), segment)


def splice_heads(encoded: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that share openings: each starts with the first h turns of the one whose id is the multiple of
    ``every`` below (towards 0), h being the crc32 of its decimal id modulo ``most``, then has its own after its first h.

    Returns encoded turns and (conv_id, length), conversations left without turns included.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h")
    heads = encoded.where((F.col("conv_id") % every == 0) & (F.col("pos") < most - 1)).withColumnRenamed("conv_id", "base")
    held = heads.groupBy("base").agg(F.count("*").alias("held"))
    convs = lengths(encoded).select("conv_id", "length", h, (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    convs = convs.join(held, "base", "left").withColumn("taken", F.least("h", F.coalesce("held", F.lit(0))))
    convs = written(convs.select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(
        F.lit(0), F.col("length") - F.col("h"))).alias("length")), "spliced")
    own = encoded.join(convs.select("conv_id", "h", "taken"), "conv_id").where("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "tid", "words")
    first = convs.join(heads, "base").where("pos < h").select("conv_id", "pos", "tid", "words")
    return own.union(first), convs.select("conv_id", "length")
