"""Interpolated modified Kneser-Ney scoring (order 2) from memory-mapped sorted arrays.

Training counts in Spark: tasks sum up what their partition holds in sorted arrays and
send one row per shard, not one per n-gram; a shard's task merges them and writes a file to the shared folder.

* words: sorted 64-bit hashes, with counts; a word's number is its place in all shards
* pairs: sorted 64-bit keys, with counts. The key is a one-to-one scrambling of (number of the
  word before, number of the word), so pairs of a frequent word fall in all shards
* per word: the number of different words before it, and the discount mass of its pairs

Workers map the files into memory and look up the words and pairs of a few documents at a
time, so the model need not fit in memory and is read where it is touched. Words are runs of anything
but ASCII white space with A-Z lower-cased; every text ends with an end token, which is also what
stands before its first word.

P(w|v) = max(c(vw) - D(c(vw)), 0) / c(v) + mass(v) / c(v) * P(w),
P(w) = max(a(w) - E(a(w)), 0) / A + (E mass / A) / (V + 1),
with D and E the discounts for counts of 1, 2 and 3 or more, c pair counts, a the numbers of
different words before, and V + 1 outcomes: the words, the end and one for all unknown words. After an
unknown word the probability is P(w).

Defined cases: null texts are empty and hold the end alone; repeated rows count each time; with nothing to
learn from every token has the probability 1 (of one outcome); texts are read whole, a very long one looked up by itself.
Columns of the added names are replaced.
"""

from __future__ import annotations

import os
import re
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import unused, worker_state
from presslens.session import shared_dir

END = xxhash.xxh64_intdigest(b" ")  # of no word, as words hold no space
SHARD_BYTES = 24 << 20  # of training text for each shard
_HELD = 1 << 22  # entries a task holds before it sends them on
_AT_ONCE = 1 << 20  # tokens looked up together
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)


def words_of(text: str | None) -> np.ndarray:
    """Hashes of the words and the end."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    return np.append(h, np.uint64(END))


def scramble(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One-to-one: (32-bit number, 32-bit number) -> 64 bits."""
    x = (before.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _S)) * _M1
        x = (x ^ (x >> _S)) * _M2
    return x ^ (x >> _S)


def unscramble(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    m1, m2 = (np.uint64(pow(int(m), -1, 1 << 64)) for m in (_M1, _M2))
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _S)) * m2
        x = (x ^ (x >> _S)) * m1
    x = x ^ (x >> _S)
    return (x >> np.uint64(32)).astype(np.int64), (x & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _sum(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    k = np.concatenate(keys)
    u, at = np.unique(k, return_inverse=True)
    return u, np.bincount(at, np.concatenate(counts), len(u)).astype(np.int64)


def _by_shard(keys: np.ndarray, bits: int) -> np.ndarray:
    """Borders of the shards (the top ``bits`` bits) in sorted keys."""
    tops = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, tops), [len(keys)]))


def _count(keys_of, bits: int):
    """Counts of what ``keys_of`` makes of a partition's texts: (shard, keys, counts) rows."""
    def send(held):
        keys, counts = _sum(*zip(*held))
        border = _by_shard(keys, bits)
        for s in range(1 << bits):
            a, b = border[s], border[s + 1]
            if b > a:
                yield pd.DataFrame({"shard": [s], "keys": [keys[a:b].tobytes()], "counts": [counts[a:b].astype("<u4").tobytes()]})

    def run(batches):
        held, size = [], 0
        for pdf in batches:
            for some in _portions(pdf["text"]):
                u, n = np.unique(keys_of(some), return_counts=True)
                held.append((u, n))
                size += len(u)
                if len(held) >= 8:
                    held = [_sum(*zip(*held))]
                    size = len(held[0][0])
                if size > _HELD:
                    yield from send(held)
                    held, size = [], 0
        if held:
            yield from send(held)
    return run


def _portions(texts):
    """Lists of token hash arrays, about _AT_ONCE tokens each (a longer text alone)."""
    some, size = [], 0
    for text in texts:
        some.append(words_of(text))
        size += len(some[-1])
        if size >= _AT_ONCE:
            yield some
            some, size = [], 0
    if some:
        yield some


def _save(folder: str, name: str, data: np.ndarray) -> None:
    """Whole files only: a task that is run twice replaces the file by its like."""
    part = os.path.join(folder, f".{name}.{uuid.uuid4().hex}")
    with open(part, "wb") as f:
        f.write(data.tobytes())
    os.replace(part, os.path.join(folder, name))


def _map(folder: str, name: str, kind: str) -> np.ndarray:
    """The file mapped into memory, once a worker; nothing, for now, where there is no file or an empty one."""
    path = os.path.join(folder, name)
    if not os.path.exists(path) or not os.path.getsize(path):
        return np.zeros(0, kind)
    return worker_state(f"map_{path}", lambda: np.memmap(path, kind, "r"))


def discounts(n: list[int]) -> tuple[float, float, float]:
    """D1, D2 and D3+ from the numbers of n-grams seen 1, 2, 3 and 4 times; within 0 and the count."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    d = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return tuple(min(max(x, 0.0), k + 1.0) for k, x in enumerate(d))


def _discount(c: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.where(c <= 0, 0.0, np.where(c == 1, d[0], np.where(c == 2, d[1], d[2])))


@dataclass
class Model:
    """Where the arrays are and the few numbers beside them."""

    folder: str
    bits: int
    starts: list  # numbers of the words in the shards before, and of all
    tokens: int
    pair_d: tuple = (0.0, 0.0, 0.0)
    word_d: tuple = (0.0, 0.0, 0.0)
    pairs: int = 0  # different pairs: A
    word_mass: float = 0.0

    @property
    def words(self) -> int:
        return self.starts[-1]

    def array(self, name: str, shard: int, kind: str) -> np.ndarray:
        return _map(self.folder, f"{name}-{shard}", kind)

    def _find(self, name: str, keys: np.ndarray):
        """Per shard with sorted ``keys``: (shard, slice of keys, places, found)."""
        border = _by_shard(keys, self.bits)
        for s in range(1 << self.bits):
            a, b = border[s], border[s + 1]
            own = self.array(name, s, "<u8")
            if b > a and len(own):
                at = np.minimum(np.searchsorted(own, keys[a:b]), len(own) - 1)
                yield s, slice(a, b), at, own[at] == keys[a:b]

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Number (-1: unknown), count, words before and pair mass of each word."""
        u, back = np.unique(hashes, return_inverse=True)
        out = np.full(len(u), -1, np.int64), np.zeros(len(u), np.int64), np.zeros(len(u), np.int64), np.zeros(len(u))
        for s, part, at, ok in self._find("word", u):
            out[0][part] = np.where(ok, at + self.starts[s], -1)
            for k, (name, kind) in enumerate((("count", "<i8"), ("before", "<u4"), ("mass", "<f8"))):
                own = self.array(name, s, kind)
                if len(own):
                    out[k + 1][part] = np.where(ok, own[at], 0)
        return tuple(x[back] for x in out)

    def pair_counts(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = np.zeros(len(word), np.int64)
        known = np.flatnonzero((before >= 0) & (word >= 0))
        u, back = np.unique(scramble(before[known], word[known]), return_inverse=True)
        n = np.zeros(len(u), np.int64)
        for s, part, at, ok in self._find("pair", u):
            n[part] = np.where(ok, self.array("times", s, "<i8")[at], 0)
        out[known] = n[back]
        return out

    def log10(self, some: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """Of each text: tokens, known tokens, base score and score."""
        flat, lengths = np.concatenate(some), np.array([len(x) for x in some])
        number, count, before, mass = self.numbers(flat)
        first = np.cumsum(lengths) - lengths
        prev = np.arange(len(flat)) - 1
        prev[first] = first + lengths - 1  # the end stands before the first word
        outcomes = self.words + 1
        if self.pairs:
            p = np.maximum(before - _discount(before, self.word_d), 0) / self.pairs + self.word_mass / self.pairs / outcomes
        else:
            p = np.full(len(flat), 1.0 / outcomes)
        c = self.pair_counts(number[prev], number)
        have = np.maximum(count[prev], 1)
        pair = np.maximum(c - _discount(c, self.pair_d), 0) / have + mass[prev] / have * p
        score = np.log10(np.where(count[prev] > 0, pair, p))
        base = np.log10((count + 0.5) / (self.tokens + 0.5 * outcomes))
        add = lambda x: np.add.reduceat(x, first)
        return lengths, add((count > 0).astype(np.int64)), add(base), add(score)


def _merge(folder: str, bits: int, name: str, times: str, kind: str):
    """Joins a shard's rows, writes its sorted arrays and tells how many entries and tokens there are."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        keys, n = _sum([np.frombuffer(x, "<u8") for x in pdf["keys"]], [np.frombuffer(x, "<u4") for x in pdf["counts"]])
        _save(folder, f"{name}-{key[0]}", keys.astype("<u8"))
        _save(folder, f"{times}-{key[0]}", n.astype(kind))
        few = [int((n == k).sum()) for k in (1, 2, 3, 4)]
        return pd.DataFrame({"shard": [key[0]], "n": [len(keys)], "tokens": [int(n.sum())], "few": [few]})
    return run


def _pairs_of(model: Model):
    def run(some: list[np.ndarray]) -> np.ndarray:
        number = model.numbers(np.concatenate(some))[0]
        lengths = np.array([len(x) for x in some])
        first = np.cumsum(lengths) - lengths
        prev = np.arange(len(number)) - 1
        prev[first] = first + lengths - 1
        return scramble(number[prev], number)
    return run


def _spread(model: Model):
    """Of a shard of pairs: per word, the pairs it ends (column 1) and the discount mass of those it begins."""
    def run(batches):
        starts = np.array(model.starts)
        for pdf in batches:
            for shard in pdf["shard"]:
                before, word = unscramble(np.asarray(model.array("pair", shard, "<u8")))
                mass = _discount(np.asarray(model.array("times", shard, "<i8")), model.pair_d)
                for kind, who, weight in (("before", word, None), ("mass", before, mass)):
                    u, at = np.unique(who, return_inverse=True)
                    total = np.bincount(at, weight, len(u))
                    border = np.searchsorted(u, starts)
                    for s, (a, b) in enumerate(zip(border, border[1:])):
                        if b > a:
                            yield pd.DataFrame({"shard": [s], "kind": [kind], "who": [(u[a:b] - starts[s]).astype("<u4").tobytes()],
                                                "total": [total[a:b].astype("<f8" if kind == "mass" else "<u4").tobytes()]})
    return run


def _settle(model: Model):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        s = key[0]
        n = model.starts[s + 1] - model.starts[s]
        for kind, held, stored in (("before", "<u4", "<u4"), ("mass", "<f8", "<f8")):
            out = np.zeros(n)
            for who, total in pdf.loc[pdf["kind"] == kind, ["who", "total"]].itertuples(index=False):
                np.add.at(out, np.frombuffer(who, "<u4"), np.frombuffer(total, held))
            _save(model.folder, f"{kind}-{s}", out.astype(stored))
            if kind == "before":
                few = [int((out == k).sum()) for k in (1, 2, 3, 4)] + [int((out > 2).sum()), int(out.sum())]
        return pd.DataFrame({"shard": [s], "few": [few]})
    return run


def local_path(uri: str) -> str:
    """The path of a shared folder that is mounted on all machines."""
    m = re.match(r"(?:(\w[\w+.-]*):(?://[^/]*)?)?(/.*)", uri)
    if not m or m[1] not in (None, "file"):
        raise ValueError(f"{uri}: workers map model files into memory, so the shared folder must be a mounted one")
    return m[2]


def train(docs: DataFrame) -> Model:
    """Counts ``docs`` (text), writes the arrays to the shared folder and returns the model of them."""
    spark = docs.sparkSession
    docs = docs.select("text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(4, (size // SHARD_BYTES).bit_length())
    folder = local_path(shared_dir(spark, "llm-ngrams"))
    os.makedirs(folder)
    counted, told = "shard long, keys binary, counts binary", "shard long, n long, tokens long, few array<long>"

    words = (docs.mapInPandas(_count(np.concatenate, bits), counted).groupBy("shard")
             .applyInPandas(_merge(folder, bits, "word", "count", "<i8"), told).collect())  # a row a shard
    n = {r["shard"]: r["n"] for r in words}
    starts = np.concatenate(([0], np.cumsum([n.get(s, 0) for s in range(1 << bits)]))).tolist()
    if starts[-1] >= 1 << 32:
        raise ValueError("more than 2^32 words: a pair's key holds two 32-bit numbers")
    model = Model(folder, bits, starts, sum(r["tokens"] for r in words))

    pairs = (docs.mapInPandas(_count(_pairs_of(model), bits), counted).groupBy("shard")
             .applyInPandas(_merge(folder, bits, "pair", "times", "<i8"), told).collect())  # a row a shard
    model.pair_d = discounts([sum(r["few"][k] for r in pairs) for k in range(4)])
    model.pairs = sum(r["n"] for r in pairs)
    shards = spark.range(0, 1 << bits, numPartitions=1 << bits).withColumnRenamed("id", "shard")
    ends = (shards.mapInPandas(_spread(model), "shard long, kind string, who binary, total binary").groupBy("shard")
            .applyInPandas(_settle(model), "shard long, few array<long>").collect())  # a row a shard
    few = [sum(r["few"][k] for r in ends) for k in range(6)]
    model.word_d = discounts(few[:4])
    model.word_mass = sum(d * k for d, k in zip(model.word_d, (few[0], few[1], few[4])))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score and score (log10 of the texts' probabilities)."""
    @F.pandas_udf("n_tokens long, n_known long, base_score double, score double")
    def look_up(texts: pd.Series) -> pd.DataFrame:
        rows = [np.stack(model.log10(some), axis=1) for some in _portions(texts)]
        got = np.concatenate(rows) if rows else np.zeros((0, 4))
        return pd.DataFrame({"n_tokens": got[:, 0].astype(np.int64), "n_known": got[:, 1].astype(np.int64),
                             "base_score": got[:, 2], "score": got[:, 3]})

    s = unused(docs, "scores")
    return (docs.withColumn(s, look_up("text")).withColumns({
        "n_tokens": F.col(f"{s}.n_tokens"), "n_known": F.col(f"{s}.n_known"), "train_tokens": F.lit(model.tokens).cast("long"),
        "base_score": F.col(f"{s}.base_score"), "score": F.col(f"{s}.score")}).drop(s))


def perplexity(log10: Column, tokens: Column) -> Column:
    return F.pow(F.lit(10.0), -log10 / tokens)
