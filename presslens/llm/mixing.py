"""Mixing sources to target weights.

Each source's documents, in a seeded order, form one stream of words cut into
blocks of a fixed length. A source gets a number of slots in the mixture, dealt
over the output shards by a multinomial draw; its slot j takes block
``perm(j mod n)`` of its ``n`` blocks, ``perm`` being a pseudorandom
permutation of the source's own (a Feistel network, computed at a point). Slots and blocks
meet in an equi-join on (source, block), so no source is gathered or scanned in
order, and a hot source is spread over all tasks by its block numbers.

Defined cases: null or empty texts hold no words, take no slot and come out
with nothing taken; a very long text covers many blocks, each taken by itself; a null source is a source of its own, the last
one; repeated rows are separate documents, equal keys of the stream's order going by id and size; other columns, of whatever
name, are left alone; an empty table gives an empty mixture.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import partitions, prefix_sums, word_count, written

WEIGHTS = (5.0, 2.0, 1.0)
_MASK = (1 << 64) - 1


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """64-bit finaliser (two multiply-xorshift rounds) of x under a key."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def _keys(seed: int, sid: int) -> list[int]:
    return [int(k) for k in np.random.Generator(np.random.PCG64([seed & _MASK, sid])).integers(1 << 62, size=4)]


def permute(index: np.ndarray, n: int, keys: list[int], inverse: bool = False) -> np.ndarray:
    """Images of ``index`` under a permutation of 0..n-1 (Feistel, walking cycles back into range)."""
    half = np.uint64(max(1, ((max(n - 1, 1)).bit_length() + 1) // 2))
    low = np.uint64((1 << int(half)) - 1)
    x = index.astype(np.uint64)
    todo = np.ones(len(x), bool)
    while todo.any():
        left, right = x[todo] >> half, x[todo] & low
        for k in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ (_mix(left, k) & low), left
            else:
                left, right = right, left ^ (_mix(right, k) & low)
        x[todo] = (left << half) | right
        todo = x >= np.uint64(n)
    return x.astype(np.int64)


def source_targets(sized: DataFrame, ratio: float = 1.5, most: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """(source, sid, source_size, target) of ``sized`` (source, size).

    Sources by code point, null last, take the weights in turn and share ``ratio``
    times all sizes; no target exceeds ``most`` times its source, and the excess goes
    to the others by weight until none is above.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = prefix_sums(per.withColumn("_one", F.lit(1)), [F.col("source").asc_nulls_last()], "_one", "sid", "sources")
    which = F.array(*map(F.lit, weights))
    per = per.withColumn("_w", F.get(which, (F.col("sid") % len(weights)).cast("int"))).withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
    # sources fill up in the order of cap by weight: before each, what the full ones take and what the others weigh
    per = written(prefix_sums(per, [F.col("_cap") / F.col("_w"), "sid"], ["_cap", "_w"], ["_spent", "_gone"], "caps"), "weights")
    size, weight = per.agg(F.sum("source_size"), F.sum("_w")).first()
    level = (F.lit(ratio * (size or 0)) - F.col("_spent")) / (F.lit(weight) - F.col("_gone"))
    # the first one that does not fill up sets the level for all that follow
    level = per.where(level * F.col("_w") < F.col("_cap")).agg(F.min_by(level, F.struct(F.col("_cap") / F.col("_w"), "sid"))).first()[0]
    share = F.lit(level) * F.col("_w") if level is not None else F.col("_cap")
    return per.select("source", "sid", "source_size", F.least("_cap", share).alias("target"))


_SHARDS_AT_ONCE = 1 << 12


def _draw(slots: int, shards: int, rng: np.random.Generator):
    """A multinomial draw of slots over equal shards, the shards that get any in turn: (shards, their slots) by runs of shards."""
    while shards > 0 and slots:
        own = min(shards, _SHARDS_AT_ONCE)
        here = int(rng.binomial(slots, own / shards)) if own < shards else slots
        got = rng.multinomial(here, np.full(own, 1.0 / own))
        yield np.flatnonzero(got), got[got > 0]
        slots, shards = slots - here, shards - own


def _deal(block: int, shards: int, seed: int):
    def deal(batches):
        for pdf in batches:
            for sid, size, target in zip(pdf["sid"], pdf["source_size"], pdf["target"]):
                if size <= 0:
                    continue
                n = -(-size // block)
                passes = int(target // size)
                rest, short = target - passes * size, n * block - size
                at = int(permute(np.array([n - 1]), n, _keys(seed, sid), inverse=True)[0])  # the short block's turn
                words = lambda q: q * block - (short if at < q else 0)
                q = min((q for q in range(int(rest // block), int(rest // block) + 3) if q <= n),
                        key=lambda q: abs(words(q) - rest), default=0)
                slots = passes * n + q
                rng = np.random.Generator(np.random.PCG64([seed & _MASK, sid, 1]))
                done = 0
                for run, (which, got) in enumerate(_draw(slots, shards, rng)):
                    ends = done + np.cumsum(got)
                    yield pd.DataFrame({"sid": sid, "blocks": n, "shard": run * _SHARDS_AT_ONCE + which, "first": ends - got, "n": got})
                    done = int(ends[-1]) if len(ends) else done
    return deal


def _slots(seed: int):
    def run(batches):
        for pdf in batches:
            for sid, n, shard, first, count in pdf[["sid", "blocks", "shard", "first", "n"]].itertuples(index=False):
                j = np.arange(first, first + count)
                yield pd.DataFrame({"sid": sid, "shard": shard, "slot": j, "pass": j // n,
                                    "block": permute(j % n, n, _keys(seed, sid))})
    return run


def mix(docs: DataFrame, block_words: int = 64, shard_slots: int = 8192, seed: int = 42, ratio: float = 1.5,
        most: float = 2.0, weights=WEIGHTS, id_cols: tuple = ("doc_id",)) -> tuple[DataFrame, DataFrame]:
    """The mixture of ``docs`` (``id_cols``, text, source).

    Returns ``(sized, spans)``. ``sized`` has a row per document: ``id_cols``, size, source_size,
    target and a row number ``uid``. ``spans`` has a row for every stretch of a document in the
    mixture: shard, slot (of its source), sid (the source), pass (0 for its first use), block, uid, word_from, word_to
    (words of the document, from 0). Per shard, slots in the order of xxhash64(shard, sid, slot) are the shard's shuffled content.

    Per source the slots' words differ from its target by half a block at most. The draw is the multinomial
    one given the sources' totals: per source, its slots over the shards.
    """
    ids = list(id_cols)
    rows = written(docs.select(*ids, "source", word_count(F.col("text")).alias("size"))
                   .withColumn("uid", F.monotonically_increasing_id()), "sized")
    targets = written(source_targets(rows, ratio, most, weights), "targets")
    t = targets.withColumnRenamed("source", "_source")
    rows = rows.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    key = F.xxhash64(*ids, F.lit(seed))
    rows = prefix_sums(rows.withColumn("_key", key), ["sid", "_key", *ids, "size"], "size", "_at", "stream")
    starts = prefix_sums(targets.select("sid", "source_size"), ["sid"], "source_size", "_s0", "starts").select("sid", "_s0")
    sized = written(rows.join(starts, "sid").withColumn("at", F.col("_at") - F.col("_s0")).drop("_at", "_s0", "_key"), "rows")

    total = targets.agg(F.sum("target")).first()[0] or 0.0
    shards = max(1, int(total // (block_words * shard_slots)))
    dealt = targets.select("sid", "source_size", "target").mapInPandas(
        _deal(block_words, shards, seed), "sid long, blocks long, shard long, first long, n long")
    slots = dealt.repartition(partitions(docs.sparkSession), "sid", "shard").mapInPandas(
        _slots(seed), "sid long, shard long, slot long, pass long, block long")
    b = F.lit(block_words)
    pieces = (sized.where("size > 0")
              .select("sid", "uid", "at", "size", F.explode(F.sequence(
                  F.floor(F.col("at") / b), F.floor((F.col("at") + F.col("size") - 1) / b))).alias("block"))
              .select("sid", "block", "uid",
                      F.greatest(F.lit(0), F.col("block") * b - F.col("at")).alias("word_from"),
                      F.least("size", (F.col("block") + 1) * b - F.col("at")).alias("word_to")))
    # slots come of few dealt rows, so their size is not known before: no broadcast
    spans = slots.join(pieces.hint("merge"), ["sid", "block"])
    return sized, spans


def taken_words(sized: DataFrame, spans: DataFrame) -> DataFrame:
    """``sized`` with ``taken``: the words of each document in the mixture, repeats counted."""
    got = spans.groupBy("uid").agg(F.sum(F.col("word_to") - F.col("word_from")).alias("taken"))
    return sized.join(got, "uid", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """Documents as the mixture holds them, with the columns of ``docs``.

    A document comes out once for each pass that takes any of its blocks; its text is then the
    whole text, or the taken stretches of it one after another when the pass takes a part.
    n_chars, where there is one, is the new text's length; other columns repeat.
    """
    keyed = written(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("doc_uid")), "mixin")
    sized, spans = mix(keyed.select("doc_uid", "doc.text", "doc.source"), id_cols=("doc_uid",), **options)
    runs = (spans.groupBy("uid", "pass").agg(
        F.array_sort(F.collect_list(F.struct("word_from", "word_to"))).alias("runs"),
        F.sum(F.col("word_to") - F.col("word_from")).alias("n_words")))
    runs = runs.join(sized.select("uid", "doc_uid", "size"), "uid").select("doc_uid", "runs", "n_words", "size")
    both = keyed.join(runs, "doc_uid")
    # a stretch = so many words after a start; words are taken with the white space between them
    words = F.expr(r"regexp_extract_all(doc.text, '[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*', 0)")

    def stretches(w: Column) -> Column:
        return F.transform("runs", lambda r: F.slice(w, (r["word_from"] + 1).cast("int"), (r["word_to"] - r["word_from"]).cast("int")))

    # the words are bound once, outside the function of the stretches: inside, each stretch would match the whole text again
    cut = F.transform(F.array(words), lambda w: F.regexp_replace(F.array_join(F.flatten(stretches(w)), ""), r"[\x20\x09-\x0D]+$", ""))[0]
    whole = F.col("n_words") == F.col("size")
    out = both.select("doc", F.when(whole, F.col("doc.text")).otherwise(cut).alias("taken"))
    new = {"text": F.col("taken"), "n_chars": F.length("taken").cast("long")}
    return out.select(*[new.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])
