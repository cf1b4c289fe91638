"""Operators not exercised by a registered query: sinks, pending predictions,
key sets, listing URLs, sitemap XML."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.operators.filters import pending_predictions
from presslens.operators.setops import common_keys, entity_overlap
from presslens.operators.sinks import array_to_jsonl, load_feed, write_csv, write_jsonl
from presslens.operators.store import KeyedStore
from presslens.schemas import RAW_ARTICLE
from presslens.sources.sitemap import listing_urls, probe_sitemap, read_sitemap


def test_jsonl_csv_roundtrip(spark, scratch):
    df = spark.createDataFrame([("a.gr", "u1", "Τίτλος", dt.datetime(2026, 4, 30, 7, 54, 20), 'say "hi"\nline')],
                               "source string, url string, title string, date timestamp, text string")
    write_jsonl(df, os.path.join(scratch, "j"))
    back = spark.read.schema(RAW_ARTICLE).json(os.path.join(scratch, "j")).first()
    assert back.date == 1777535660000 and back.title == "Τίτλος"
    write_csv(df.drop("date"), os.path.join(scratch, "c"))
    c = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(os.path.join(scratch, "c"))
    assert c.first().text == 'say "hi"\nline'


def test_load_feed_and_array_to_jsonl(spark, scratch):
    src = os.path.join(scratch, "arr.json")
    with open(src, "w") as f:
        json.dump([{"source": "a", "url": "u1", "title": "t", "date": 1777535660000, "text": "x"},
                   {"url": "u2", "title": "no source"}], f)
    array_to_jsonl(spark, src, os.path.join(scratch, "lines"), RAW_ARTICLE)
    assert [r.url for r in spark.read.schema(RAW_ARTICLE).json(os.path.join(scratch, "lines")).collect()] == ["u1"]
    store = KeyedStore(spark, os.path.join(scratch, "store"))
    load_feed(spark, os.path.join(scratch, "lines"), store, RAW_ARTICLE)
    row = store.read().first()
    assert row.date == dt.datetime(2026, 4, 30, 7, 54, 20) and len(row._id) == 32


def test_pending_predictions(spark):
    df = spark.createDataFrame([(1, True, True), (2, True, None), (3, False, True)], "id int, a_done boolean, b_done boolean")
    assert sorted(r.id for r in pending_predictions(df, ["a", "b"]).collect()) == [2, 3]


def test_key_sets(spark):
    a = spark.createDataFrame([("k1",), ("k2",), ("k2",)], "k string")
    b = spark.createDataFrame([("k2",), ("k3",)], "k string")
    assert [r.k for r in common_keys(a, b, "k").collect()] == ["k2"]
    df = spark.createDataFrame([(["x", "y", "y"], ["y", "z"])], "a array<string>, b array<string>")
    i, u = entity_overlap(F.col("a"), F.col("b"))
    r = df.select(F.array_sort(i).alias("i"), F.array_sort(u).alias("u")).first()
    assert r.i == ["y"] and r.u == ["x", "y", "z"]


def test_listing_urls_and_probe(spark):
    cats = spark.createDataFrame([("politics",), ("economy",)], "category string")
    urls = listing_urls(cats, 1, 3, "https://site/%s?page=%d")
    assert urls.count() == 6 and "https://site/politics?page=3" in {r.url for r in urls.collect()}
    e = spark.createDataFrame([("s", 0, "https://s/sitemap-1.xml"), ("s", 1, "https://s/a"), ("t", 0, "https://t/x.xml")],
                              "source string, ord int, loc string")
    got = {r.source: (r.probe, r.kind) for r in probe_sitemap(e).collect()}
    assert got == {"s": ("https://s/a", "article"), "t": ("https://t/x.xml", "sitemap")}


def test_read_sitemap(spark, scratch):
    p = os.path.join(scratch, "sm.xml")
    with open(p, "w") as f:
        f.write('<?xml version="1.0"?><sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
                '<sitemap><loc>https://a.gr/1.xml</loc></sitemap><sitemap><loc>https://a.gr/2.xml</loc>'
                '<lastmod>2026-04-30T10:00:00+03:00</lastmod></sitemap></sitemapindex>')
    rows = sorted((r.loc, r.lastmod) for r in read_sitemap(spark, p).collect())
    assert rows == [("https://a.gr/1.xml", None), ("https://a.gr/2.xml", "2026-04-30T10:00:00+03:00")]


def test_describe_percentiles_against_numpy(spark):
    import numpy as np

    from presslens.operators.aggregates import describe, histogram
    rng = np.random.default_rng(3)
    a, b = [float(x) for x in rng.integers(0, 40, 501)], [float(x) for x in rng.normal(size=501)]
    df = spark.createDataFrame([(x, y if i % 7 else None) for i, (x, y) in enumerate(zip(a, b))], "a double, b double").repartition(6)
    kept = {"a": np.array(a), "b": np.array([y for i, y in enumerate(b) if i % 7])}
    for r in describe(df, ["a", "b"]).collect():
        v = kept[r.metric]
        assert r["count"] == len(v)
        for got, want in ((r.mean, v.mean()), (r.std, v.std(ddof=1)), (r.min, v.min()), (r.max, v.max()),
                          *zip((r.p25, r.p50, r.p75), np.percentile(v, [25, 50, 75]))):
            assert abs(got - want) < 1e-9
    one = describe(df.limit(1).select("a"), ["a"]).first()
    assert one.p25 == one.p75 == one.min and one.std is None
    none = describe(df.filter("false"), ["a"]).collect()
    assert none == [] and {r.n for r in histogram(df.filter("false"), "a", 4).collect()} == {0}
    same = histogram(spark.createDataFrame([(2.0,)] * 5, "a double"), "a", 3).orderBy("bin").collect()
    assert [r.n for r in same] == [5, 0, 0]
