"""Lookup joins: one rule for any key and any number of them."""

import datetime as dt

from pyspark.sql import functions as F

from presslens.operators import joins


def _data(spark):
    entries = spark.createDataFrame(
        [(1, "protothema.gr"), (2, "m.protothema.gr"), (3, "www.kathimerini.gr"), (4, "other.org"), (5, None)],
        "id int, domain string")
    state = spark.createDataFrame(
        [("protothema.gr", dt.datetime(2026, 4, 30, 7, 59), "a"), ("kathimerini.gr", dt.datetime(2026, 4, 30, 7, 30), "b"),
         ("gr", dt.datetime(2026, 1, 1), "z")],
        "source string, cutoff timestamp, ord string")
    return entries, state


def _run(entries, state):
    out = joins.lookup_contains(entries, state, "domain", "source", "cutoff", "ord",
                                F.lit(dt.datetime(2000, 1, 1)), out="c")
    return sorted((r.id, r.c) for r in out.collect())


def test_lookup_contains_is_substring_match(spark):
    entries, state = _data(spark)
    got = dict(_run(entries, state))
    first, other, none = dt.datetime(2026, 4, 30, 7, 59), dt.datetime(2026, 4, 30, 7, 30), dt.datetime(2000, 1, 1)
    assert got == {1: first, 2: first, 3: other, 4: none, 5: none}


def test_lookup_contains_of_any_key_beside_many(spark):
    entries = spark.createDataFrame(
        [(1, "myprotothema.gr"), (2, "tanea.gr.example.com"), (3, "x"), (3, "x"), (4, "")], "id int, domain string")
    rules = [("protothema.gr", dt.datetime(2026, 1, 1), "b"), ("anea.g", dt.datetime(2026, 1, 2), "a"),
             ("gr", dt.datetime(2026, 1, 3), "z"), (None, dt.datetime(2026, 1, 4), "0")]
    many = [(f"k{i}.example", dt.datetime(2025, 1, 1), f"k{i}") for i in range(12_000)]
    want = [(1, dt.datetime(2026, 1, 1)), (2, dt.datetime(2026, 1, 2)), *[(i, dt.datetime(2000, 1, 1)) for i in (3, 3, 4)]]
    for extra in ([], many):
        state = spark.createDataFrame(rules + extra, "source string, cutoff timestamp, ord string")
        assert _run(entries, state) == want
    everywhere = spark.createDataFrame([("", dt.datetime(2026, 2, 2), "a")], "source string, cutoff timestamp, ord string")
    assert [c for _, c in _run(entries, everywhere)] == [dt.datetime(2026, 2, 2)] * 5


def test_lookup_equal(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "source string, v int")
    t = spark.createDataFrame([("a", 10), ("b", 20)], "source string, w int")
    assert sorted(map(tuple, joins.lookup_equal(df, t, "source", "w", F.lit(0)).collect())) == [
        ("a", 1, 10), ("b", 2, 20), ("c", 3, 0)]


def test_merge_state(spark):
    s = spark.createDataFrame([("a", 1), ("b", 5)], "source string, cutoff int")
    n = spark.createDataFrame([("b", 3), ("c", 7)], "source string, newest int")
    got = sorted(map(tuple, joins.merge_state(s, n).collect()))
    assert got == [("a", 1), ("b", 5), ("c", 7)]
