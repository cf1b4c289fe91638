import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from presslens.llm.common import BATCH_BYTES, small_batches
from presslens.llm.language_id import grams, identify, top_grams
from presslens.llm.toxicity_chain import Linear, features, fit, fit_linear, predict
from presslens.sources.tables import table
from tests.conftest import SF
from tests.llm.helpers import DE, EN, awkward, docs_frame


def brute_profile(text, size):
    """Counts of all n-grams by plain slicing of the words."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    count = {}
    for w in words:
        for piece, lengths in ((w, (1,)), (f"\1{w}\1", (2, 3))):
            for n in lengths:
                for i in range(len(piece) - n + 1):
                    g = piece[i:i + n]
                    count[g] = count.get(g, 0) + 1
    code = lambda g: sum((ord(c) << (21 * (len(g) - 1 - k))) for k, c in enumerate(g))
    return [code(g) for g in sorted(count, key=lambda g: (-count[g], code(g)))][:size]


def test_languages_in_blocks_give_the_same(spark, monkeypatch):
    """More languages than one broadcast holds: blocks of them, ties still to the smaller name."""
    from presslens.llm import language_id
    docs = awkward(spark)
    train = docs.select("text", "lang").union(docs.select("text", F.concat(F.lit("x-"), "lang"))).union(docs.select("text", F.concat(F.lit("a-"), "lang")))
    want = sorted(map(tuple, identify(docs, train).select("doc_id", "lang_pred", "score").collect()), key=repr)
    monkeypatch.setattr(language_id, "LANGUAGES_AT_ONCE", 2)
    got = sorted(map(tuple, identify(docs, train).select("doc_id", "lang_pred", "score").collect()), key=repr)
    assert got == want and any(r[1].startswith("a-") for r in got)


@pytest.mark.parametrize("text", [EN, DE, "a", "É é, ßx!!x 12 x", "q q q"])
def test_grams_against_slicing(text):
    got = top_grams(grams(text), 50).tolist()
    assert got == brute_profile(text, 50)


def test_out_of_place_distance_by_hand(spark):
    train = docs_frame(spark, [(1, EN, "en", "a"), (2, DE, "de", "a")])
    docs = docs_frame(spark, [(1, "there was", None, "x"), (2, "und die", None, "x")])
    got = {r["doc_id"]: r for r in identify(docs, train, size=40).collect()}
    for i, text in ((1, "there was"), (2, "und die")):
        own = brute_profile(text, 40)
        far = {}
        for lang, sample in (("en", EN), ("de", DE)):
            ranks = {g: k for k, g in enumerate(brute_profile(sample, 40))}
            far[lang] = sum(abs(ranks[g] - k) if g in ranks else 40 for k, g in enumerate(own))
        best = min(sorted(far), key=far.get)
        assert got[i]["lang_pred"] == best
        assert got[i]["score"] == pytest.approx(1 - far[best] / (len(own) * 40))
    assert got[1]["guess"] == "g" and got[1]["uid"] == "u"  # other columns stay


def test_language_of_awkward_rows(spark):
    docs = awkward(spark)
    got = identify(docs, docs.select("text", "lang")).collect()
    assert len(got) == 14
    for r in got:
        letters = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == (not letters)
        assert 0 <= r["score"] <= 1
    nothing = identify(docs, docs.where("false")).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in nothing] == [("und", 0.0)]
    assert identify(docs.where("false"), docs).count() == 0


def test_language_accuracy_on_held_out(spark):
    docs = table(spark, SF, "documents")
    got = identify(docs.where("doc_id % 4 = 2"), docs.where("doc_id % 4 <> 2"))
    right = got.where("lang = lang_pred").count()
    assert right >= 0.98 * got.count()


def test_linear_separates_and_shrinks_noise():
    rng = np.random.default_rng(1)
    y = (rng.random(400) < 0.3).astype(float)
    feats = [np.unique(np.append(rng.integers(100, 5000, 30), [7] if v else [8])).astype(np.uint32) for v in y]
    m = fit_linear(feats, np.zeros((400, 0)), y, np.ones(400))
    p = m.probability(feats, np.zeros((400, 0)))
    assert ((p > 0.5) == (y == 1)).all()
    weight = dict(zip(m.ids.tolist(), m.weights))
    assert weight[7] > 1 > -1 > weight[8]


def test_linear_gradient_is_zero_at_the_fit():
    rng = np.random.default_rng(2)
    y = (rng.random(200) < 0.5).astype(float)
    feats = [np.unique(np.append(rng.integers(20, 40, 3), [1] if v and rng.random() < 0.8 else [2])).astype(np.uint32) for v in y]
    earlier, w = rng.random((200, 1)), rng.random(200) + 0.5
    m = fit_linear(feats, earlier, y, w, ridge=0.5)
    load = w / w.sum() * 200
    r = load * (m.probability(feats, earlier) - y)
    for i, x in zip(m.ids, m.weights):
        assert sum(v for f, v in zip(feats, r) if i in f) + 0.5 * x == pytest.approx(0, abs=1e-2)
    assert r.sum() == pytest.approx(0, abs=1e-2)


def test_constant_categories():
    none = fit_linear([], np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    assert none.probability([np.zeros(0, np.uint32)], np.zeros((1, 0)))[0] < 1e-6
    one = fit_linear([np.array([1], np.uint32)] * 3, np.zeros((3, 0)), np.ones(3), np.ones(3))
    assert one.probability([np.zeros(0, np.uint32)], np.zeros((1, 0)))[0] > 1 - 1e-6
    assert isinstance(one, Linear) and len(features(None)) == len(features("")) == 0


def test_chain_finds_planted_words_out_of_sample(spark):
    bad = ["scumword", "vileling", "rotbag"]
    mk = lambda i: (f"w{i % 50} w{i % 37} und w{i % 11} " + (f"{bad[i % 3]} {bad[(i + 1) % 3]}" if i % 5 == 0 else f"w{i % 29}"))
    docs = docs_frame(spark, [(i, mk(i), "en", "a") for i in range(600)])
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    got = predict(docs, fit(docs, labels)).where("doc_id >= 300").collect()
    assert all((r["p_toxic"] >= 0.4) == (r["doc_id"] % 5 == 0) for r in got)


def test_chain_against_a_plain_one(spark):
    """Folds, out-of-fold probabilities and final models, category by category, on the same sample."""
    docs = docs_frame(spark, [(i, f"w{i % 50} v{i % 7} " + ("scumword" if i % 4 == 0 else f"w{i % 29}"), "en", "a") for i in range(160)])
    rows = [(i, int(i % 3 > 0), int(i % 4 == 0)) for i in range(120)]
    chain = fit(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
    fold = {r[0]: r[1] for r in spark.range(120).selectExpr("id", "pmod(xxhash64(id, 11), 3)").collect()}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = [i for i, _, _ in rows]
    feats, folds, ones = [features(text[i]) for i in ids], np.array([fold[i] for i in ids]), np.ones(len(ids))
    earlier = np.zeros((len(ids), 0))
    pick = lambda xs, keep: [x for x, k in zip(xs, keep) if k]
    for k, model in enumerate(chain.models):
        y = np.array([r[1 + k] for r in rows], float)
        whole = fit_linear(feats, earlier, y, ones)
        assert model.ids.tolist() == whole.ids.tolist() and np.allclose(model.weights, whole.weights, atol=1e-6)
        assert np.allclose(model.earlier, whole.earlier, atol=1e-6) and np.isclose(model.constant, whole.constant, atol=1e-6)
        p = np.zeros(len(ids))
        for f in range(3):
            out = folds == f
            part = fit_linear(pick(feats, ~out), earlier[~out], y[~out], ones[~out])
            p[out] = part.probability(pick(feats, out), earlier[out])
        earlier = np.concatenate([earlier, p[:, None]], axis=1)


def test_labels_of_absent_documents_take_no_places(spark):
    docs = docs_frame(spark, [(i, f"w{i % 50} w{i % 37} " + ("scumword" if i % 5 == 0 else f"w{i % 29}"), "en", "a") for i in range(200)])
    label = lambda ids: spark.createDataFrame([(i, int(i % 3 > 0), int(i % 5 == 0)) for i in ids], "doc_id long, quality int, toxic int")
    alone, among = fit(docs, label(range(200)), max_labelled=60), fit(docs, label(range(4000)), max_labelled=60)
    for a, b in zip(alone.models, among.models):
        assert a.ids.tolist() == b.ids.tolist() and np.allclose(a.weights, b.weights) and np.isclose(a.constant, b.constant)


def test_chain_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (2, 1, 0), (3, None, 1), (4, 0, 0), (None, 1, 1), (99, 1, 1), (7, 1, 1), (5, 0, 2)],
                                   "doc_id long, quality int, toxic int")
    got = predict(docs, fit(docs, labels))
    assert got.count() == 14 and got.where("p_toxic between 0 and 1 and p_quality between 0 and 1").count() == 14
    none = predict(docs, fit(docs, labels.where("false")))
    assert none.where("p_toxic > 0.01").count() == 0
    assert predict(docs.where("false"), fit(docs.where("false"), labels)).count() == 0


def test_texts_reach_workers_in_batches_of_few_bytes(spark):
    names = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch")
    before = {k: spark.conf.get(k) for k in names}
    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("lorem "), 1000).alias("text"), F.lit("la").alias("lang"))

    @F.pandas_udf("long")
    def held(texts: pd.Series) -> pd.Series:  # bytes of the batch that the row came in
        return pd.Series(int(texts.str.len().sum()), index=texts.index)

    def largest():
        other = docs.mapInArrow(lambda batches: iter([b.select(["doc_id"]).slice(0, 1).set_column(0, "doc_id", pa.array([b.nbytes])) for b in batches]), "doc_id long")
        return docs.select(held("text").alias("n")).agg(F.max("n")).first()[0], other.agg(F.max("doc_id")).first()[0]

    try:
        for k, v in zip(names, ("64MB", "10000")):  # Spark's own
            spark.conf.set(k, v)
        assert min(largest()) == pytest.approx(24e6, rel=0.1)
        got = identify(docs, docs.limit(5))
        assert max(largest()) < 2 * BATCH_BYTES
        assert got.groupBy("lang_pred").count().collect() == [("la", 4000)]
        spark.conf.set(names[0], "1m")  # a lower limit stays
        small_batches(spark)
        assert spark.conf.get(names[0]) in ("1m", "1048576", "1048576b")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
