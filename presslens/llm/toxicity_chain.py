"""Toxicity by a chain of linear classifiers.

The label categories are predicted one after the other. Each is a logistic model of
the words (and word beginnings) a document holds, and of the probabilities of the
categories before it. Those come out of fold in training: a labelled document's earlier
probabilities are from a model that has not seen it, as a new document's will be.

Fitting uses a bounded sample, ``max_labelled`` of the labelled documents at hand, the same number of each value of
the last category as far as there are, weighted back to their shares of all those. Per
category the fold models and the final one are fitted in parallel, a group of a Spark job each. Every
text is then scored whole.

Defined cases: null and empty texts have no words and are scored by the models' constants;
labels that are null, or of documents that are not there, are not learned and take no places in the sample; of repeated labels of a
document the largest counts, of repeated documents one; a category with a single value, or none, is predicted as its share (0 if
none). Columns of the added names are replaced.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import small_batches, unused, written
from presslens.operators.windows import sample_exact

CATEGORIES = ("quality", "toxic")
MAX_LABELLED = 8000
THRESHOLD = 0.4  # of the last category's probability; clean documents stay well below it, out of fold too
_WORDS = re.compile(r"[^\W\d_]+")
_SIGNS = re.compile(r"[^\w\s]{2,}")


def features(text: str | None) -> np.ndarray:
    """32-bit hashes of the different words, their first 4 and 5 letters, and runs of signs."""
    if not text:
        return np.zeros(0, np.uint32)
    words = set(_WORDS.findall(text.lower()))
    # the text's whole words and the beginnings of them, told apart by a mark
    names = words | {w[:4] + "-" for w in words if len(w) > 4} | {w[:5] + "-" for w in words if len(w) > 5}
    names.update(set(_SIGNS.findall(text)))
    return np.unique(np.fromiter((zlib.crc32(x.encode("utf-8", "replace")) for x in names), np.uint32, len(names)))


@dataclass
class Linear:
    """A fitted logistic model: sorted feature hashes, their weights, those of the earlier probabilities, the constant."""

    ids: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    constant: float

    def probability(self, feats: list[np.ndarray], earlier: np.ndarray) -> np.ndarray:
        z = np.full(len(feats), self.constant) + _logit(earlier) @ self.earlier
        if len(self.ids):
            for i, f in enumerate(feats):
                at = np.minimum(np.searchsorted(self.ids, f), len(self.ids) - 1)
                z[i] += self.weights[at[self.ids[at] == f]].sum()
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


def fit_linear(feats: list[np.ndarray], earlier: np.ndarray, y: np.ndarray, weight: np.ndarray,
               least_docs: int = 4, least_z: float = 4.0, ridge: float = 0.3, steps: int = 30) -> Linear:
    """A weighted ridge logistic regression over the features whose share of
    documents differs between the values by ``least_z`` standard errors or more."""
    share = float((y * weight).sum() / weight.sum()) if len(y) else 0.0
    if len(y) == 0 or y.min() == y.max():
        constant = float(_logit(np.array([share]))[0]) if 0 < share < 1 else (20.0 if share else -20.0)
        return Linear(np.zeros(0, np.uint32), np.zeros(0), np.zeros(earlier.shape[1]), constant)
    row = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
    ids, col = np.unique(np.concatenate(feats), return_inverse=True)
    pos, neg = (np.bincount(col[y[row] == v], minlength=len(ids)) for v in (1, 0))
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    p = (pos + neg) / len(y)
    z = np.abs(pos / n1 - neg / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
    good = (pos + neg >= least_docs) & (z >= least_z)
    place = np.cumsum(good) - 1
    use = good[col]
    row, col, ids = row[use], place[col[use]], ids[good]
    n, k = len(y), len(ids)
    dense = np.concatenate([_logit(earlier), np.ones((n, 1))], axis=1)
    load = weight / weight.sum() * n
    penalty = np.full(k + dense.shape[1], ridge)
    penalty[-1] = 1e-6

    def times(v):  # rows of the features, the earlier probabilities and the constant, times v
        return np.bincount(row, v[:k][col], n) + dense @ v[k:]

    def back(r):
        return np.concatenate([np.bincount(col, r[row], k), dense.T @ r])

    def loss(v, z):
        return float((load * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (penalty * v * v).sum())

    v = np.zeros(len(penalty))
    v[-1] = _logit(np.array([share]))[0]
    z = times(v)
    now = loss(v, z)
    for _ in range(steps):  # Newton steps, each solved by conjugate gradients
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        g = back(load * (p - y)) + penalty * v
        if np.abs(g).max() < 1e-6 * n:
            break
        bend = np.maximum(load * p * (1 - p), 1e-9)
        d, r = np.zeros_like(v), -g
        q, rr = r.copy(), float(r @ r)
        stop = 1e-6 * rr
        for _ in range(200):
            h = back(bend * times(q)) + penalty * q
            a = rr / float(q @ h)
            d, r = d + a * q, r - a * h
            new = float(r @ r)
            if new <= stop:
                break
            q, rr = r + new / rr * q, new
        size, zd = 1.0, times(d)
        while size > 1e-6 and loss(v + size * d, z + size * zd) > now:
            size /= 2
        v, z = v + size * d, z + size * zd
        now = loss(v, z)
    return Linear(ids, v[:k], v[k:-1], float(v[-1]))


@dataclass
class Chain:
    categories: tuple
    models: list[Linear] = field(default_factory=list)

    def predict(self, texts: pd.Series) -> np.ndarray:
        feats = [features(x) for x in texts]
        out = np.zeros((len(feats), 0))
        for m in self.models:
            out = np.concatenate([out, m.probability(feats, out)[:, None]], axis=1)
        return out


def _fit_group(folds: int, category: int, earlier: dict):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id")
        feats = [np.frombuffer(x, "<u4") for x in pdf["feats"]]
        before = np.array([earlier.get(i, []) for i in pdf["doc_id"]]).reshape(len(pdf), category)
        y, w = pdf["y"].map(lambda v: v[category]).to_numpy(float), pdf["w"].to_numpy(float)
        seen = (pdf["fold"] != key[0]).to_numpy()
        m = fit_linear([f for f, s in zip(feats, seen) if s], before[seen], y[seen], w[seen])
        out = ~seen
        p = m.probability([f for f, s in zip(feats, seen) if not s], before[out])
        return pd.DataFrame({"model": [key[0]], "ids": [m.ids.astype("<u4").tobytes()], "weights": [m.weights.astype("<f8").tobytes()],
                             "earlier": [m.earlier.tolist()], "constant": [m.constant],
                             "doc_ids": [pdf["doc_id"].to_numpy(np.int64)[out].tolist()], "p": [p.tolist()]})
    return run


def fit(docs: DataFrame, labels: DataFrame, categories: tuple = CATEGORIES, max_labelled: int = MAX_LABELLED,
        folds: int = 3) -> Chain:
    """The chain over ``categories`` (0/1 columns of ``labels``, by doc_id) of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    small_batches(spark)
    known = F.col("doc_id").isNotNull()
    for c in categories:
        known &= F.col(c).isin(0, 1)
    labels = labels.where(known).groupBy("doc_id").agg(*[F.max(c).cast("int").alias(c) for c in categories])
    here = docs.select("doc_id").distinct()
    labels = written(labels.join(here, "doc_id", "left_semi"), "labels")
    totals = {r[0]: r[1] for r in labels.groupBy(categories[-1]).count().collect()}
    chosen = sample_exact(labels, max_labelled // 2, categories[-1], "doc_id", 10).select(
        "doc_id", F.array(*categories).alias("y"),
        (F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(folds))).cast("int").alias("fold"))

    @F.pandas_udf("binary")
    def feats(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: features(x).astype("<u4").tobytes())

    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(chosen), "doc_id").withColumn("feats", feats("text"))  # max_labelled rows at most
    sample = written(found.groupBy("doc_id").agg(F.first("y").alias("y"), F.first("fold").alias("fold"),
                                                 F.min_by("feats", F.struct(F.xxhash64("text"), "feats")).alias("feats")), "sample")
    counts = {r[0]: r[1] for r in sample.groupBy(F.col("y")[len(categories) - 1]).count().collect()}
    scale = F.create_map(*[F.lit(x) for v, n in counts.items() for x in (v, totals[v] / n)]) if counts else None
    weighted = sample.withColumn("w", scale[F.col("y")[len(categories) - 1]] if counts else F.lit(1.0))
    groups = weighted.withColumn("model", F.explode(F.array(*map(F.lit, range(folds + 1)))))  # the last sees all folds
    chain, earlier = Chain(tuple(categories)), {}
    for k in range(len(categories)):
        fitted = groups.groupBy("model").applyInPandas(
            _fit_group(folds, k, earlier), "model int, ids binary, weights binary, earlier array<double>, constant double, "
            "doc_ids array<long>, p array<double>").collect()  # folds + 1 rows
        last = next((r for r in fitted if r["model"] == folds), None)
        chain.models.append(Linear(np.frombuffer(last["ids"], "<u4"), np.frombuffer(last["weights"], "<f8"),
                                   np.array(last["earlier"], float), last["constant"]) if last else
                            Linear(np.zeros(0, np.uint32), np.zeros(0), np.zeros(k), -20.0))
        got = {i: p for r in fitted if r["model"] < folds for i, p in zip(r["doc_ids"], r["p"])}
        earlier = {i: [*earlier.get(i, []), p] for i, p in got.items()}
    return chain


def predict(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` with p_<category> for every category of the chain."""
    small_batches(docs.sparkSession)
    plain = [(m.ids, m.weights, m.earlier, m.constant) for m in chain.models]
    held = docs.sparkSession.sparkContext.broadcast(plain)  # plain data: workers need not have the package
    categories = chain.categories
    names = [f"p_{c}" for c in categories]

    @F.pandas_udf(", ".join(f"{n} double" for n in names))
    def score(texts: pd.Series) -> pd.DataFrame:
        own = Chain(categories, [Linear(*m) for m in held.value])
        return pd.DataFrame(own.predict(texts), columns=names)

    p = unused(docs, "chain")
    return docs.withColumn(p, score("text")).withColumns({n: F.col(f"{p}.{n}") for n in names}).drop(p)
