"""Date functions on rows worked out by hand (UTC session)."""

import datetime as dt

from pyspark.sql import functions as F

from presslens.functions import dates as D

U = dt.datetime
# (text, its instant in UTC by either function: the ISO form alone, and with the first date in a text)
VALUES = [
    ("2026-04-30T10:59:59+03:00", U(2026, 4, 30, 7, 59, 59), None),
    ("2026-04-30T07:54:20Z", U(2026, 4, 30, 7, 54, 20), None),
    ("2026-04-30T07:54:20.250Z", U(2026, 4, 30, 7, 54, 20, 250000), None),
    ("2026-04-30T07:54", U(2026, 4, 30, 7, 54), None),
    ("2024-05-01T10:00+03:00", U(2024, 5, 1, 7, 0), None),  # minutes and an offset
    ("2024-05-01T10:00-0530", U(2024, 5, 1, 15, 30), None),
    ("2024-05-01T10:00Z", U(2024, 5, 1, 10, 0), None),
    ("2026-04-30 07:54:20", U(2026, 4, 30, 7, 54, 20), None),
    ("2026-04-30", U(2026, 4, 30), None),
    ("12:30", None, None),  # neither a time nor a year alone is a date
    ("2024", None, None),
    ("2024-05", None, None),
    ("2024-13-01T10:00", None, None),
    ("Πέμπτη 30 Απριλίου 2026", None, None),
    ("published 2026-04-29 by staff", None, U(2026, 4, 29)),
    ("id12026-04-29 and x2026-04-28x", None, None),  # whole words only
    ("on 2026-02-31, then 2026-03-01", None, None),  # the first date in the text is none
    ("", None, None), (None, None, None),
]


def test_parse_iso_and_first_date(spark):
    df = spark.createDataFrame([(i, v[0]) for i, v in enumerate(VALUES)], "i int, s string").orderBy("i")
    got = df.select(D.parse_iso("s").alias("iso"), D.parse_iso_or_date("s").alias("any")).collect()
    assert [r["iso"] for r in got] == [v[1] for v in VALUES]
    assert [r["any"] for r in got] == [v[1] or v[2] for v in VALUES]


def test_epoch_ms_roundtrip_and_display(spark):
    df = spark.createDataFrame([(1777535660000,), (None,)], "ms long")
    r = df.select(D.from_epoch_ms("ms").alias("t")).select(
        "t", D.to_epoch_ms("t").alias("back"), D.display_date("t", "t").alias("shown")).collect()
    assert r[0].t == dt.datetime(2026, 4, 30, 7, 54, 20) and r[0].back == 1777535660000
    assert r[0].shown == "2026-04-30 07:54" and r[1].shown is None


def test_clamp_cutoff(spark):
    now = dt.datetime(2026, 4, 30, 12, 0)
    df = spark.createDataFrame([(dt.datetime(2026, 4, 30, 11, 0),), (dt.datetime(2026, 4, 29),), (None,)], "c timestamp")
    got = [r[0] for r in df.select(D.clamp_cutoff("c", F.lit(now))).collect()]
    assert got == [dt.datetime(2026, 4, 30, 11, 0), dt.datetime(2026, 4, 30, 10, 0), dt.datetime(2026, 4, 30, 10, 0)]


def test_minute_prefix(spark):
    df = spark.createDataFrame([("2026-04-30T10:59:59+03:00",)], "s string")
    assert df.select(D.minute_prefix("s")).first()[0] == "2026-04-30T10:59"
