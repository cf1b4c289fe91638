"""Projection operators: sink document, flattening, feed and analysis cards."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from presslens.operators.projections import analysis_card, feed_card, flatten_labels, sink_document

LAB = "struct<reasoning:string, primary_entities:array<string>, bias:double, error:string>"


def test_sink_document_defaults(spark):
    df = spark.createDataFrame(
        [("a.gr", "u1", "t", dt.datetime(2026, 4, 30), "body", None),
         ("a.gr", None, "t2", None, "b2", ("r", ["E"], 0.7, None))],
        f"source string, url string, title string, date timestamp, text string, label {LAB}")
    rows = sink_document(df).collect()
    assert rows[0]._id == hashlib.md5(b"u1").hexdigest() and rows[1]._id == hashlib.md5(b"").hexdigest()
    assert rows[0].ai_labels.reasoning == "" and rows[0].ai_labels.primary_entities == []
    assert rows[0].content == "body" and rows[1].ai_labels.bias == 0.7


def test_flatten_and_feed_card(spark):
    df = spark.createDataFrame(
        [(None, "", None, None, ("", None, 0.0, None)), ("T", "s", "u", dt.datetime(2026, 1, 1), ("why", ["x"], 0.8, None)),
         ("T", "s", "u", None, ("", [], float("nan"), None)), ("T", "s", "u", None, ("", [], -1.0, None))],
        f"title string, source string, url string, date timestamp, ai_labels {LAB}")
    flat = flatten_labels(df, synthetic=False).collect()
    assert flat[1].bias == 0.8 and flat[1].reasoning == "why" and flat[1].is_synthetic is False
    c = feed_card(df).collect()
    assert (c[0].title, c[0].source, c[0].url, c[0].reasoning) == ("No Title", "Unknown Source", "#", "Analysis pending...")
    assert c[0].pol_score == 50.0 and c[0].pol_lean == "Center" and c[0].tags == []
    assert c[1].pol_lean == "Right" and c[1].pol_score == 80.0
    assert c[2].pol_score == 50.0 and c[3].pol_lean == "Left" and c[3].pol_score == -100.0


def test_analysis_card(spark):
    df = spark.createDataFrame(
        [("https://www.site.gr/politics/very/long/path", "text", "Page", ("r", ["a"], 0.29, None)),
         ("https://x.gr/a", "", "", None),
         ("https://x.gr/b", "t", "", ("r", None, -1.0, None))],
        f"url string, text string, page_title string, label {LAB}")
    c = analysis_card(df, error=None).collect()
    assert (c[0].title, c[0].lean, c[0].score, c[0].source) == ("Page", "Left", 28, "https://www.site.gr/polit")
    assert (c[1].title, c[1].lean, c[1].score, c[1].tags) == ("Scrape Failed", "Center", 50, [])
    assert c[2].title == "Analysis of https://x.gr/b..." and c[2].score == 50 and c[2].lean == "Center"
