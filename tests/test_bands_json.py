"""Bands, defaults and model-output recovery against plain-Python renditions."""

import json
import math
import re

from pyspark.sql import functions as F

from presslens import specs
from presslens.functions import bands as B
from presslens.functions.jsonparse import with_parsed_output


def test_ideology_edges(spark):
    """An edge belongs to the class below it; what is not a number has no class."""
    want = {"-1": "Far-Left", "1e-3": "Far-Left", "0.15": "Far-Left", "0.150001": "Left", "0.35": "Left", "0.45": "Center-Left",
            "0.55": "Center / Neutral", "0.65": "Center-Right", "0.85": "Right", "0.86": "Far-Right", "NaN": "Far-Right", "abc": None, None: None}
    df = spark.createDataFrame([(i, v) for i, v in enumerate(want)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(B.ideology_class("v")).collect()]
    assert got == list(want.values())


def test_cut_right_closed(spark):
    vals = [0.0, 0.2, 0.2000001, 0.4, 0.6, 0.8, 1.0, 1.01, -0.01, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(B.cut("v", specs.RANGE5_EVEN)).collect()]
    lab = specs.RANGE5_EVEN["labels"]
    assert got == [lab[0], lab[0], lab[1], lab[1], lab[2], lab[3], lab[4], None, None, None]


def test_leans_and_defaults(spark):
    vals = [0.0, 0.35, 0.4, 0.6, 0.66, -1.0, None, float("nan"), 0.29]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double").orderBy("i")
    r = df.select(B.lean_feed("v").alias("f"), B.lean_analyzer("v").alias("a"),
                  B.default_score_feed("v").alias("d"), B.default_score_analyzer("v").alias("da"),
                  B.pct_int("v").alias("pi")).collect()
    assert [x.f for x in r][:6] == ["Left", "Left", "Center", "Center", "Right", "Left"]
    assert [x.a for x in r][:6] == ["Left", "Left", "Center", "Center", "Right", "Left"]
    d = [x.d for x in r]
    assert d[0] == 0.5 and d[5] == -1.0 and d[6] == 0.5 and d[7] == 0.5 and d[8] == 0.29
    assert [x.da for x in r][5] == 0.5 and [x.da for x in r][6] == 0.5
    assert r[8].pi == int(0.29 * 100)


# --- JSON recovery ------------------------------------------------------------
OUTPUTS = [
    '{"reasoning": "r", "primary_entities": ["A"], "bias": 0.3}',
    '"reasoning": "r", "bias": 0.4}',
    '{"reasoning": "r", "bias": "0.5"}\n```',
    '```json\n{"reasoning": "r", "bias": 0.6}\n```',
    'Sure! {"reasoning": "r", "bias": 0.7} bye',
    '<think>deep thought</think>{"reasoning": "", "bias": 0.8}',
    'half a thought</think>{"reasoning": "x", "bias": 0.9}',
    '<THINK>t</THINK>  {"reasoning": "  ", "bias": "abc"}',
    "",
    None,
    "no json",
]


def test_safe_parse_v1(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(OUTPUTS)], "i int, raw string").orderBy("i")
    got = with_parsed_output(with_parsed_output(df, "raw", "p"), "raw", "c", compat=True).orderBy("i").collect()
    # the score, where the output holds one object; "abc" is no number but no failure
    assert [r.p.bias for r in got] == [0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, None, None, None, None]
    assert [r.p.error for r in got] == [None] * 8 + ["parse_failed"] * 3
    # the older rule adds a brace to whatever does not start with one, so words before an object spoil it
    assert [r.c.bias == -1.0 for r in got] == [False] * 3 + [True] * 8


def test_safe_parse_v2_thoughts(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(OUTPUTS)], "i int, raw string").orderBy("i")
    got = [r.p for r in with_parsed_output(df, "raw", "p", thoughts=True).orderBy("i").collect()]
    assert got[5].reasoning == "deep thought" and got[5].bias == 0.8
    assert got[6].reasoning == "x" and got[6].bias == 0.9
    assert got[7].bias is None and got[7].reasoning == "t"
    assert got[8] is None and got[9] is None and got[10] is None
    assert not math.isnan(got[0].bias)


def test_scorer_concurrency_keeps_order(spark):
    import time as _t

    import pandas as pd

    from presslens.operators.score import Scorer, raw_scores

    class Echo(Scorer):
        def raw(self, texts):
            _t.sleep(0.01)
            return texts.map(lambda t: '{"reasoning": "%s", "bias": 0.5}' % t)

    df = spark.createDataFrame([(i, f"t{i}") for i in range(200)], "i int, prompt string").coalesce(1)
    out = raw_scores(df, {"m": Echo()}, "prompt", concurrency=8, backoff=0).orderBy("i").collect()
    assert [r.m_raw for r in out] == ['{"reasoning": "t%d", "bias": 0.5}' % i for i in range(200)]
    assert pd.notna(out[0].m_latency)


def test_scorer_failures_become_error_records(spark):
    from presslens.operators.score import Scorer, score_articles

    class Flaky(Scorer):
        def raw(self, texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("endpoint down")
            return texts.map(lambda t: '{"bias": 0.2}')

    df = spark.createDataFrame([("ok1",), ("bad",), ("ok2",)], "prompt string").coalesce(1)
    got = [r.ai_labels for r in score_articles(df, Flaky(), backoff=0).collect()]
    assert [g.bias for g in got] == [0.2, None, 0.2] and got[1].error == "RuntimeError: endpoint down"
    assert got[0].error is None
