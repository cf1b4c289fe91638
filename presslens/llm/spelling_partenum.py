"""Spelling variants grouped through PartEnum signatures.

Words are counted over whole texts. A word's letters, each with how often it came
before in the word (the second e is another element than the first), are a set,
that is a binary vector. Two words one edit apart have vectors at Hamming distance one
(a letter more) or two (a letter replaced). PartEnum cuts the vector's dimensions into
``n`` parts and enumerates all ways to leave out ``k`` of them: vectors at
distance ``k`` at most differ in no more than ``k`` parts, so they agree on what is left in one
of the ways. Words of equal length meet by two parts left out, words whose lengths differ by one by a
single part; each way's remaining content, with the way and the length, is one key of an
equi-join. Pairs that meet are verified inside the join, by the distance of their folded
vectors and then by their edit distance, so nothing but true links leaves it, and Spark
splits the join's large keys.

Which part a dimension belongs to only matters for speed: the dimensions are
dealt so that the parts hold about equal entropy over all words.

Words are numbered by falling count, then in code-point order, so a word's best neighbour is
its smallest one; chains of forms, whose counts only rise, are followed by pointer jumping.

Defined cases: a null or empty text has no words; a null doc_id counts as the empty string in the
typing rule; repeated rows count again; a text of any length is read whole; ties between neighbours of
equal count go to the first in code-point order; an empty table gives no words; other columns are left out.
"""

from __future__ import annotations

import itertools
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import prefix_sums, written

LEAST_LETTERS = 7
LEAST_COUNT = 2
_HELD = 1 << 17  # words counted in a task before they are passed on
_ROWS = 1 << 15  # in one frame on its way out
_SIGNED = 1 << 11  # words signed at once
_OFTEN = 8  # occurrences of one letter in a word that get a part by their entropy; later ones by number


def typed(run: str, doc_id: str, every: int = 31) -> str:
    """``run`` of a document, less one letter where ``every`` divides the crc32 of id and run."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    return run if h % every else run[:h % len(run)] + run[h % len(run) + 1:]


def _count(least: int):
    runs = re.compile(rf"[a-zÀ-ÿ]{{{least},}}")  # shorter runs give no word long enough

    def run(batches):
        held: dict[str, int] = {}

        def flush():
            while held:
                some = [held.popitem() for _ in range(min(_ROWS, len(held)))]
                yield pd.DataFrame(some, columns=["word", "n"])

        for pdf in batches:
            for doc, text in zip(pdf["doc"], pdf["text"]):
                own: dict[str, int] = {}
                # bytes lower-case A-Z alone
                for w in runs.findall(text.encode("utf-8", "replace").lower().decode()):
                    own[w] = own.get(w, 0) + 1
                for w, n in own.items():
                    w = typed(w, doc)
                    if len(w) >= least:
                        held[w] = held.get(w, 0) + n
                if len(held) > _HELD:
                    yield from flush()
        yield from flush()
    return run


def word_counts(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n, id) of the words of ``docs`` (doc_id, text); ``id`` is the place by falling n, then word."""
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    words = (docs.where("text is not null").select(doc.alias("doc"), "text")
             .mapInPandas(_count(least_letters), "word string, n long")
             .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))
    words = prefix_sums(words.withColumn("_one", F.lit(1)), [F.desc("n"), "word"], "_one", "id", "words")
    return written(words.select("word", "n", "id"), "vocabulary")


def _elements(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word lengths, and of every letter of every word: the word's place, the letter, its how-manieth."""
    sizes = np.array([len(w) for w in words], np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    row = np.repeat(np.arange(len(words)), sizes)
    order = np.lexsort((codes, row))
    row, codes = row[order], codes[order]
    at = np.arange(len(row))
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (codes[1:] != codes[:-1])
    return sizes, row, codes, at - np.maximum.accumulate(np.where(new, at, 0)) + 1


def _tally(batches):
    for pdf in batches:
        _, _, codes, occ = _elements(pdf["word"].tolist())
        few = occ <= _OFTEN
        key, n = np.unique(codes[few] * (_OFTEN + 1) + occ[few], return_counts=True)
        yield pd.DataFrame({"key": key, "n": n})


def balanced_parts(counts: dict[int, int], words: int, parts: int) -> dict[int, int]:
    """The part of each dimension: the largest entropies first, each to the part that holds least."""
    p = {k: min(max(n / max(words, 1), 1e-12), 1 - 1e-12) for k, n in counts.items()}
    entropy = {k: -x * np.log2(x) - (1 - x) * np.log2(1 - x) for k, x in p.items()}
    load, out = [0.0] * parts, {}
    for k in sorted(entropy, key=lambda k: (-entropy[k], k)):
        out[k] = load.index(min(load))
        load[out[k]] += entropy[k]
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def signatures(words: list[str], part_of: dict[int, int], parts: int, left_out: int, lengthen: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Keys (a row a way to leave parts out, a column a word) and the words' vectors folded to 64 bits.

    ``lengthen`` is added to the length in the key: 1 looks for words one letter longer.
    """
    sizes, row, codes, occ = _elements(words)
    dim = codes * (_OFTEN + 1) + occ
    known, which = np.unique(dim, return_inverse=True)
    known_part = np.array([part_of.get(int(k), int(k) % parts) for k in known], np.int64)
    order = {k: i for i, k in enumerate(part_of)}
    known_bit = np.array([order.get(int(k), int(k)) % 64 for k in known], np.uint64)
    content = np.zeros((parts, len(words)), np.uint64)
    np.add.at(content, (known_part[which], row), _mix(codes.astype(np.uint64) << np.uint64(32) | occ.astype(np.uint64)))
    bits = np.zeros(len(words), np.uint64)
    np.bitwise_xor.at(bits, row, np.uint64(1) << known_bit[which])
    content = _mix(content ^ _mix(np.arange(1, parts + 1, dtype=np.uint64))[:, None])
    whole = content.sum(axis=0, dtype=np.uint64)
    length = (sizes + lengthen).astype(np.uint64)
    keys = [_mix((whole - content[list(out)].sum(axis=0, dtype=np.uint64)) ^ _mix(length * np.uint64(1 << 20) + np.uint64(i)))
            for i, out in enumerate(itertools.combinations(range(parts), left_out))]
    return np.array(keys), bits


def _sign(part_of: dict[int, int], parts: int, left_out: int, lengthen: int):
    def run(batches):
        for pdf in batches:
            for a in range(0, len(pdf), _SIGNED):
                words, ids = pdf["word"].iloc[a:a + _SIGNED].tolist(), pdf["id"].to_numpy()[a:a + _SIGNED]
                keys, bits = signatures(words, part_of, parts, left_out, lengthen)
                ways = len(keys)
                yield pd.DataFrame({"key": keys.view(np.int64).ravel(), "id": np.tile(ids, ways),
                                    "bits": np.tile(bits.view(np.int64), ways), "word": words * ways})
    return run


def near_pairs(vocabulary: DataFrame, replace_parts: int = 5, insert_parts: int = 4) -> DataFrame:
    """(a, b): ids of all pairs of words (word, id) that are one inserted, deleted or replaced letter apart; each pair once."""
    counts = {r["key"]: r["n"] for r in vocabulary.select("word").mapInPandas(_tally, "key long, n long")
              .groupBy("key").agg(F.sum("n").alias("n")).collect()}  # 8 a letter of the alphabet
    total = vocabulary.count()
    words = vocabulary.select("id", "word")

    def signed(parts: int, left_out: int, lengthen: int = 0) -> DataFrame:
        part_of = balanced_parts(counts, total, parts)
        return words.mapInPandas(_sign(part_of, parts, left_out, lengthen), "key long, id long, bits long, word string")

    def verified(most: int) -> Column:
        apart = F.bit_count(F.col("a.bits").bitwiseXOR(F.col("b.bits")))
        return (apart <= most) & (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1)

    same = signed(replace_parts, 2)
    replaced = same.alias("a").join(same.alias("b").hint("merge"), (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id")) & verified(2))
    short, long = signed(insert_parts, 1, 1).alias("a"), signed(insert_parts, 1).alias("b")
    inserted = short.join(long.hint("merge"), (F.col("a.key") == F.col("b.key")) & verified(1))
    lo, hi = F.least("a.id", "b.id"), F.greatest("a.id", "b.id")
    return replaced.select(lo.alias("a"), hi.alias("b")).union(inserted.select(lo.alias("a"), hi.alias("b"))).distinct()


def spelling_groups(docs: DataFrame, ratio: int = 10, **counting) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of ``docs`` (doc_id, text).

    ``form`` is the neighbour of largest n if that is ``ratio`` times the word's own at least; ``root`` is where
    the forms of forms end.
    """
    words = word_counts(docs, **counting)
    pairs = near_pairs(words)
    near = written(pairs.select(F.col("a").alias("id"), F.col("b").alias("other")).union(pairs.select("b", "a"))
                   .groupBy("id").agg(F.count("*").alias("n_near"), F.min("other").alias("best")), "near")
    best = words.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    forms = written(near.join(words.select("id", "n"), "id").join(best, "best").where(F.col("form_n") >= ratio * F.col("n"))
                    .select("id", "form", "form_n", F.col("best").alias("root_id"), F.col("form").alias("root")), "forms")
    while True:  # twice as far a round; counts rise tenfold a step, so there are few
        onward = forms.select(F.col("id").alias("root_id"), F.col("root_id").alias("_id"), F.col("root").alias("_root"))
        forms = written(forms.join(onward, "root_id", "left").select(
            "id", "form", "form_n", F.coalesce("_id", "root_id").alias("root_id"), F.coalesce("_root", "root").alias("root"),
            F.col("_id").isNotNull().alias("moved")), "forms")
        if not forms.where("moved").take(1):
            break
        forms = forms.drop("moved")
    return (words.join(near.select("id", "n_near"), "id", "left").join(forms.select("id", "form", "form_n", "root"), "id", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
