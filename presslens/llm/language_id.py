"""Language ID by rank-order profiles.

A language's profile is its most frequent character n-grams, in order, over all
training texts; a document's profile is made alike from its whole text, and its
language is the one whose profile is the least out of place: the sum, over the
document's n-grams, of the difference of ranks (the profile's length where the
language lacks the n-gram).

Letters are lower-cased; all other characters separate words, and n-grams do not
reach past the separator on either side of a word. Ties of counts go by code
points, ties of distances to the smaller language name.

Defined cases: a null text, and one without a letter, is ``und`` with score 0;
so is every text when there is nothing to learn from. Null languages are not
learned; repeated rows count each time; texts are read whole, however long; other columns of the input stay, but one of
the name of an added column is replaced.

Profiles are broadcast in blocks of languages, so any number of languages can be learned: each block gives a
document its least distance, and the least of all blocks decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm.common import prefix_sums, small_batches, unused, worker_state, written

LONGEST = 3  # letters of an n-gram
PROFILE = 400
LANGUAGES_AT_ONCE = 1000  # bounds a broadcast: so many profiles of 400 n-grams
_CHAR = 21  # bits of a code point
_GAP = 1  # stands for a separator: no letter, and not 0, which would not count in a code

def _letter_table() -> np.ndarray:
    import unicodedata
    cat = (unicodedata.category(chr(c))[0] for c in range(0x110000))
    return np.fromiter(({"L": 2, "M": 1}.get(c, 0) for c in cat), np.uint8, 0x110000)


def _letters() -> np.ndarray:
    """Of every code point: 2 for a letter, 1 for a mark, which belongs to one, 0 for any other."""
    return worker_state("letters", _letter_table)


def grams(text: str) -> np.ndarray:
    """Codes of all n-grams of 1 to LONGEST characters, repeats included."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    kind = _letters()[c]
    if not (kind == 2).any():
        return np.zeros(0, np.int64)
    c = np.where(kind > 0, c, _GAP).astype(np.int64)
    c = np.concatenate(([_GAP], c, [_GAP]))
    c = c[(c != _GAP) | np.concatenate(([True], c[:-1] != _GAP))]  # one separator between words
    out, code, ok = [c[c != _GAP]], c, np.ones(len(c), bool)
    for n in range(2, LONGEST + 1):
        code = (code[:-1] << _CHAR) | c[n - 1:]
        # a separator only at either end
        ok = np.ones(len(code), bool) if n == 2 else ok[:-1] & (c[n - 2:-1] != _GAP)
        out.append(code[ok])
    return np.concatenate(out)


def top_grams(codes: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    code, n = np.unique(codes, return_counts=True)
    if len(code) > size:
        least = np.partition(n, len(n) - size)[len(n) - size]
        code, n = code[n >= least], n[n >= least]
    return code[np.lexsort((code, -n))][:size]


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, gram, n) of a partition, summed up whenever the counts held grow large."""
    held: dict[str, list] = {}
    size = 0

    def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
        code = np.concatenate([x for x, _ in held[lang]])
        n = np.concatenate([x for _, x in held[lang]])
        u, at = np.unique(code, return_inverse=True)
        return u, np.bincount(at, n, len(u)).astype(np.int64)

    def flush():
        for lang in held:
            u, n = merged(lang)
            yield pd.DataFrame({"lang": lang, "gram": u, "n": n})
        held.clear()

    for pdf in batches:
        for lang, rows in pdf.groupby("lang")["text"]:
            pending, waiting = [], 0
            for text in [*rows, None]:
                if text is not None:
                    pending.append(grams(text))
                    waiting += len(pending[-1])
                if pending and (text is None or waiting > 1 << 20):
                    u, n = np.unique(np.concatenate(pending), return_counts=True)
                    held.setdefault(lang, []).append((u, n))
                    size += len(u)
                    pending, waiting = [], 0
            if len(held.get(lang, ())) > 8:
                held[lang] = [merged(lang)]
        size = sum(len(u) for x in held.values() for u, _ in x)
        if size > 1 << 22:
            yield from flush()
    yield from flush()


def learn_profiles(train: DataFrame, size: int = PROFILE) -> DataFrame:
    """(lang, gram, rank from 0): each language's ``size`` most frequent n-grams in ``train`` (text, lang)."""
    counts = (train.where("lang is not null and text is not null").select("text", "lang")
              .mapInPandas(_count_grams, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < size).select("lang", "gram", "rank")


class Profiles:
    """Profiles as sorted arrays, for the workers: at most LANGUAGES_AT_ONCE of ``size`` entries."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.size = size
        of_lang: dict[str, list[tuple[int, int]]] = {}
        for lang, gram, rank in rows:
            of_lang.setdefault(lang, []).append((gram, rank))
        self.langs = sorted(of_lang)
        self.tables = []
        for lang in self.langs:
            own = sorted(of_lang[lang])
            self.tables.append((np.array([g for g, _ in own], np.int64), np.array([k for _, k in own], np.int64)))

    def predict(self, text: str | None) -> tuple[int | None, str | None, int]:
        """The least distance, its language, and the number of n-grams compared (none: 0)."""
        top = top_grams(grams(text), self.size) if text else np.zeros(0, np.int64)
        if not len(top) or not self.langs:
            return None, None, 0
        place = np.arange(len(top))
        best = None
        for lang, (codes, ranks) in zip(self.langs, self.tables):
            at = np.minimum(np.searchsorted(codes, top), len(codes) - 1)
            d = np.where(codes[at] == top, np.abs(ranks[at] - place), self.size).sum()
            if best is None or d < best[0]:
                best = (int(d), lang)
        return *best, len(top)


def identify(docs: DataFrame, train: DataFrame, size: int = PROFILE,
             lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with the predicted language and a score from 0 to 1: one less the mean
    displacement of the document's n-grams as a part of the profile's length.

    ``train`` (text, lang) is read in full; of ``docs`` only text is looked at.
    """
    small_batches(docs.sparkSession)
    profiles = learn_profiles(train, size).select("lang", "gram", "rank")
    langs = train.where("lang is not null").select("lang").distinct()
    blocks = -(-langs.count() // LANGUAGES_AT_ONCE) or 1
    if blocks > 1:
        named = prefix_sums(langs.withColumn("_one", F.lit(1)), ["lang"], "_one", "at", "languages")
        profiles = written(profiles.join(named.select("lang", F.floor(F.col("at") / LANGUAGES_AT_ONCE).alias("block")), "lang"), "profiles")
    spark, name = docs.sparkSession, unused(docs, "guess")

    def nearest(block: int) -> Column:
        own = profiles if blocks == 1 else profiles.where(F.col("block") == block).select("lang", "gram", "rank")
        held = spark.sparkContext.broadcast([tuple(r) for r in own.collect()])  # plain data: workers need not have the package
        made: list[Profiles] = []  # by a task's first batch, for all of them

        @F.pandas_udf("far long, lang string, n long")
        def guess(texts: pd.Series) -> pd.DataFrame:
            if not made:
                made.append(Profiles(held.value, size))
            got = pd.DataFrame([made[0].predict(x) for x in texts], columns=["far", "lang", "n"])
            return got.astype({"far": "Int64", "lang": object})
        return guess("text")

    least = nearest(0) if blocks == 1 else F.array_min(F.filter(F.array(*[nearest(b) for b in range(blocks)]), lambda g: g["lang"].isNotNull()))
    got = docs.withColumn(name, least)
    far, n = F.col(f"{name}.far"), F.col(f"{name}.n")
    return (got.withColumn(lang_col, F.coalesce(F.col(f"{name}.lang"), F.lit("und")))
            .withColumn(score_col, F.when(n > 0, F.lit(1.0) - far.cast("double") / (n * size)).otherwise(F.lit(0.0))).drop(name))
