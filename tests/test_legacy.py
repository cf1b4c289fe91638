"""Legacy categorical evaluation against errors worked out by hand."""

import json

import pytest

from presslens.plans.legacy import legacy_errors, legacy_summary

T = lambda **kw: json.dumps(kw)
# (truth, prediction, error, valid, fallacy matched)
RECORDS = [
    # 1 (negative to neutral) + 4 (left to right)
    (T(sentiment="negative", ideological_leaning="left", establishment_stance="systemic", primary_fallacy="none"),
     T(sentiment="neutral", ideological_leaning="right", establishment_stance="systemic", primary_fallacy="none"), 5, True, True),
    # 4 (positive 1, unknown 5) + 2 (other fallacy)
    (T(sentiment="positive", ideological_leaning="center", establishment_stance="neutral", primary_fallacy="a"),
     T(sentiment="mixed", ideological_leaning="center", establishment_stance="neutral", primary_fallacy="b"), 6, True, False),
    # an unknown true category fails after the fallacy has matched, or before it is reached
    (T(primary_fallacy="x", sentiment="neutral", ideological_leaning="odd", establishment_stance="neutral"),
     T(primary_fallacy="x", sentiment="neutral", ideological_leaning="left", establishment_stance="neutral"), 10, False, True),
    (T(sentiment="neutral", ideological_leaning="odd", primary_fallacy="x"),
     T(sentiment="neutral", ideological_leaning="left", primary_fallacy="x"), 10, False, False),
    # a key missing from the prediction, no JSON, JSON in a string, a key without scores
    (T(sentiment="neutral", primary_fallacy="x"), T(sentiment="neutral"), 10, False, False),
    (T(sentiment="neutral", primary_fallacy="x"), "garbage", 10, False, False),
    (json.dumps(T(sentiment="negative", primary_fallacy="y")), T(sentiment="negative", primary_fallacy="y"), 10, False, False),
    (T(sentiment="neutral", extra="z"), T(sentiment="neutral", extra="z"), 10, False, False),
]

# FIXED VALUES: the categories of the ten published records, truth then prediction
# (sentiment, leaning, stance, fallacy; the fallacies by letter)
PUBLISHED = [
    ("negative", "left", "anti-government", "A", "negative", "left", "anti-government", "B"),
    ("neutral", "neutral", "anti-government", "none", "neutral", "center", "neutral", "none"),
    ("neutral", "neutral", "neutral", "none", "negative", "right", "pro-government", "B"),
    ("positive", "neutral", "neutral", "none", "neutral", "neutral", "neutral", "none"),
    ("positive", "neutral", "pro-government", "A", "positive", "center-right", "pro-government", "none"),
    ("neutral", "left", "anti-government", "none", "neutral", "neutral", "neutral", "none"),
    ("neutral", "neutral", "systemic", "none", "neutral", "neutral", "systemic", "none"),
    ("neutral", "neutral", "systemic", "none", "neutral", "center", "systemic", "none"),
    ("negative", "neutral", "neutral", "C", "negative", "neutral", "anti-systemic", "none"),
    ("negative", "left", "anti-government", "none", "negative", "left", "anti-government", "B"),
]
KEYS = ("sentiment", "ideological_leaning", "establishment_stance", "primary_fallacy")


def evaluate(spark, records):
    df = spark.createDataFrame([(i, t, p) for i, (t, p) in enumerate(records)], "i int, t string, p string")
    return legacy_errors(df, "t", "p")


def test_errors_row_by_row(spark):
    e = evaluate(spark, [r[:2] for r in RECORDS])
    assert [(r.error, r.valid, r.fallacy_match) for r in e.orderBy("i").collect()] == [r[2:] for r in RECORDS]
    s = legacy_summary(e).first()
    assert (s.n_articles, s.n_valid) == (8, 2)
    assert s.mean_error == pytest.approx(71 / 8) and s.fallacy_accuracy == pytest.approx(100.0)


def test_published_records(spark):
    records = [(json.dumps(dict(zip(KEYS, r[:4]))), json.dumps(dict(zip(KEYS, r[4:])))) for r in PUBLISHED]
    e = evaluate(spark, records)
    assert [r.error for r in e.orderBy("i").collect()] == [2, 2, 7, 1, 3, 4, 0, 0, 3, 2]
    s = legacy_summary(e).first()
    assert (s.mean_error, s.fallacy_accuracy) == (pytest.approx(2.40), pytest.approx(50.0))
