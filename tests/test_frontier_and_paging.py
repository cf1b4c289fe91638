"""Breadth-first expansion, paging by cursor, substring lookup and text similarity against plain renditions."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from presslens.operators.aggregates import kde, order_bits, values_at
from presslens.operators.frontier import expand_frontier
from presslens.operators import similarity
from presslens.operators.joins import lookup_contains, with_next
from presslens.operators.similarity import text_cosine
from presslens.operators.sort import cursor_of, lay_out_by_date, page_after, top_k


def _reach(roots, links, depth, cap):
    met = {u: (h, 0) for u, h in roots}
    level = set(met)
    for d in range(1, depth + 1):
        new = sorted({(b, h) for a, b, h in links if a in level and b not in met and b is not None})
        taken = Counter()
        level = set()
        for u, h in new:
            if cap is None or taken[h] < cap:
                taken[h] += 1
                met[u] = (h, d)
                level.add(u)
    return {(u, h, d) for u, (h, d) in met.items()}


@pytest.mark.parametrize("depth, cap", [(0, None), (3, None), (3, 1), (50, 2), (50, None)])
def test_frontier(spark, depth, cap):
    rng = random.Random(3)
    host = lambda i: f"h{i % 4 if i % 3 else 0}"  # noqa: E731  h0 has a third and more
    links = [(f"u{a:02d}", f"u{b:02d}", host(b)) for a, b in {(rng.randrange(60), rng.randrange(60)) for _ in range(150)}]
    links += [("u00", "u00", "h0"), ("u01", None, None), (None, "u02", "h2")]
    roots = [("u00", "h0"), ("u07", host(7))]
    got = expand_frontier(spark.createDataFrame(roots + roots[:1], "url string, host string"),
                          spark.createDataFrame(links, "src string, dst string, host string"), depth, cap)
    assert sorted(tuple(r) for r in got.select("url", "host", "depth").collect()) == sorted(_reach(roots, links, depth, cap))


def test_pages_by_cursor_are_the_pages_by_offset(spark, scratch):
    rows = [(f"k{i:04d}", None if i % 11 == 0 else i * 37 % 40) for i in range(200)]  # many ties, many without a date
    df = spark.createDataFrame(rows, "_id string, d long").select("_id", F.timestamp_seconds("d").alias("date")).drop("d")
    lay_out_by_date(df, f"{scratch}/feed", files=4)
    feed, after, seen = spark.read.parquet(f"{scratch}/feed"), None, []
    order = [F.col("date").desc_nulls_last(), F.col("_id").asc()]
    want = [r["_id"] for r in df.orderBy(*order).collect()]
    while True:
        p = page_after(feed, after, 30)
        ids = [r["_id"] for r in p.collect()]
        assert ids == [r["_id"] for r in top_k(df, 30, order, offset=len(seen)).collect()]
        if not ids:
            break
        seen += ids
        after = cursor_of(p)
    assert seen == want
    plan = page_after(feed, (rows and feed.agg(F.max("date")).first()[0], "k"), 5)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(date", plan), plan


def test_lookup_by_the_rarest_substring(spark):
    rng = random.Random(1)
    values = ["".join(rng.choice("abc.") for _ in range(rng.randrange(0, 60))) for _ in range(300)] + [None, "", "ab"]
    keys = [("".join(rng.choice("abc.") for _ in range(n)), k) for k, n in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 3, 5] * 3)] + [("zzz", 98), ("ab", 99)]
    got = lookup_contains(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string"),
                          spark.createDataFrame([(k, o, f"val{o}") for k, o in keys] + [(None, 0, "no")], "k string, o int, val string"),
                          "v", "k", "val", "o", F.lit("none"), out="m")
    for r in got.collect():
        hit = [o for k, o in keys if r["v"] is not None and k in r["v"]]
        assert r["m"] == (f"val{min(hit)}" if hit else "none"), r


def test_text_cosine_against_plain(spark):
    rows = [(1, "the cat sat", "the cat sat"), (2, "the the cat", "a dog"), (3, None, "x"), (4, "", ""), (5, "Ένα δύο THE", "the ένα τρία the")]
    got = {r["i"]: r["similarity"] for r in text_cosine(spark.createDataFrame(rows, "i int, a string, b string"), "i", "a", "b").collect()}
    words = lambda t: Counter(re.findall(r"[^\W\d_]+", (t or "").lower()))
    texts = [words(t) for _, a, b in rows for t in (a, b)]
    n = sum(t is not None for _, a, b in rows for t in (a, b))
    idf = {t: math.log((1 + n) / (1 + sum(t in w for w in texts))) + 1 for w in texts for t in w}
    for i, a, b in rows:
        x, y = ({t: c * idf[t] for t, c in words(s).items()} for s in (a, b))
        norm = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
        assert got[i] == pytest.approx(sum(v * y.get(t, 0) for t, v in x.items()) / norm if norm else 0.0, abs=1e-12)


def _plain_cosine(rows):
    """Rows of one key (null, too) are one vector; a term is in a text of theirs or not; every text counts in n."""
    words = lambda t: Counter(re.findall(r"[^\W\d_]+", (t or "").lower()))
    vec = {}
    for i, a, b in rows:
        x, y = vec.setdefault(i, (Counter(), Counter()))
        x.update(words(a))
        y.update(words(b))
    n = sum(t is not None for _, a, b in rows for t in (a, b))
    held = Counter(t for sides in vec.values() for s in sides for t in s)
    w = {t: math.log((1 + n) / (1 + d)) + 1 for t, d in held.items()}
    out = {}
    for i, (x, y) in vec.items():
        norm = math.sqrt(sum((v * w[t]) ** 2 for t, v in x.items()) * sum((v * w[t]) ** 2 for t, v in y.items()))
        out[i] = sum(v * y[t] * w[t] ** 2 for t, v in x.items()) / norm if norm and i is not None else 0.0
    return out


def test_text_cosine_of_repeated_and_null_keys(spark):
    rng = random.Random(3)
    text = lambda: rng.choice([None, "", "1 2", " ".join(rng.choice(["a", "A", "b", "bb", "é", "c1c", "the"]) for _ in range(rng.randrange(12)))])
    rows = [(i if i % 7 else None, text(), text()) for i in [*range(60), *range(0, 60, 5), 3, 3]]
    want = _plain_cosine(rows)
    got = text_cosine(spark.createDataFrame(rows, "i int, a string, b string"), "i", "a", "b").collect()
    assert Counter(r["i"] for r in got) == Counter(r[0] for r in rows)
    for r in got:
        assert r["similarity"] == pytest.approx(want[r["i"]], abs=1e-12)


def test_text_cosine_holds_no_terms_of_many_rows(spark):
    """Terms are counted in their row: an aggregation by (row, term) held all terms of a task (2.6 GB on 0.5 GB of documents)."""
    pairs = spark.range(50).select("id", F.lit("a b a").alias("a"), F.lit("b c").alias("b"))
    out = text_cosine(pairs, "id", "a", "b").filter("similarity >= 0")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    grouped = re.findall(r"Aggregate \[([^\]]*)\]", plan)
    by_row = [g for g in grouped if "__key" in g and "__t" in g]
    assert len(by_row) == plan.count("Union")  # only that of repeated keys
    assert "strategy=shuffle_hash" in plan  # and the join on terms sorts no rows


@pytest.mark.parametrize("common, keys", [(0, 100), (3, 0), (5, 100)])
def test_text_cosine_of_common_and_rare_terms(spark, monkeypatch, common, keys):
    monkeypatch.setattr(similarity, "COMMON_TERMS", common)
    monkeypatch.setattr(similarity, "COMMON_KEYS", keys)
    rng = random.Random(4)
    text = lambda: " ".join(rng.choice("abcdefgh"[:rng.randrange(1, 9)]) for _ in range(rng.randrange(20)))
    rows = [(i if i != 9 else None, text(), text() if i % 6 else None) for i in [*range(50), 7, 7, 20]]
    want = _plain_cosine(rows)
    got = text_cosine(spark.createDataFrame(rows, "i int, a string, b string"), "i", "a", "b").collect()
    assert Counter(r["i"] for r in got) == Counter(r[0] for r in rows)
    for r in got:
        assert r["similarity"] == pytest.approx(want[r["i"]], abs=1e-12)


def test_common_terms_are_those_of_the_highest_steps():
    assert similarity._least_step([(0, 100), (4, 5), (9, 2)], 7) == 4
    assert similarity._least_step([(0, 100), (4, 5), (9, 2)], 6) == 9
    assert similarity._least_step([(3, 8)], 7) == 4 and similarity._least_step([], 7) == 1


def test_text_cosine_evaluates_its_pairs_once(spark):
    """Every evaluation shuffles the texts again where pairs come from a join."""
    seen = spark.sparkContext.accumulator(0)

    def one(t):
        seen.add(1)
        return t

    texts = spark.range(40).select("id", F.udf(one, "string").asNondeterministic()(F.lit("a b")).alias("a"), F.lit("b c").alias("b"))
    assert text_cosine(texts, "id", "a", "b").filter("similarity > 0").count() == 40
    assert seen.value == 40


def test_text_cosine_does_not_shuffle_common_terms(spark):
    pairs = spark.range(50).select("id", F.lit("a b a").alias("a"), F.lit("b c").alias("b"))
    plan = text_cosine(pairs, "id", "a", "b")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan


def test_with_next_is_the_join_on_the_next_key(spark):
    keys = [*range(-70, 70), 3, 3, 4, 31, 32, 32, 95, 96, 1 << 40, (1 << 40) - 1, None, None]
    rows = [(k, None if i % 9 == 0 else f"v{i}") for i, k in enumerate(keys) if k not in (10, -5)]
    df = spark.createDataFrame(rows, "id long, v string")
    want = Counter((a, x, y) for a, x in rows for b, y in rows if a is not None and b is not None and b == a + 1)
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = with_next(df, "id", "v", "after")
        assert Counter(tuple(r) for r in got.collect()) == want and got.columns == ["id", "v", "after"]
        assert "ReusedExchange" in got._jdf.queryExecution().executedPlan().toString()  # shuffled once
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)


def test_bits_follow_the_order_of_doubles(spark):
    rng = random.Random(5)
    vals = sorted([0.0, 5e-324, 2.2e-308, 1.0, math.nextafter(1, 0), math.nextafter(1, 2), 2.0, 4.0, 8.0, math.nextafter(8, 0), 1.7e308, float("inf"),
                   *[rng.uniform(-1, 1) * 10 ** rng.randrange(-300, 300) for _ in range(300)], -1.0, -2.0, -5e-324, float("-inf"), *[2.0 ** k for k in range(-60, 60)]])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    bits = [r[0] for r in df.orderBy("i").select(order_bits(F.col("v"))).collect()]
    assert all(a <= b for a, b in zip(bits, bits[1:])) and len(set(bits)) > len(vals) * 0.95


def test_values_at_positions(spark):
    rng = random.Random(2)
    data = {"flat": [float(i) for i in range(500)], "one": [7.5] * 300, "mixed": [rng.choice([0.0, -1.5, 1e300, rng.gauss(0, 1)]) for _ in range(700)]}
    rows = [(g, v) for g, vs in data.items() for v in vs]
    counts = spark.createDataFrame(rows, "g string, v double").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = {r["g"]: r["at"] for r in values_at(counts, "g", lambda n: F.array(F.lit(0).cast("long"), F.lit(123).cast("long"), n - 1)).collect()}
    for g, vs in data.items():
        vs = sorted(vs)
        assert got[g] == {0: vs[0], 123: vs[123], len(vs) - 1: vs[-1]}


def test_density_against_the_direct_sum(spark):
    rng = random.Random(4)
    xs = [rng.gauss(0, 1) for _ in range(800)] + [rng.uniform(5, 30) for _ in range(200)] + [None]
    got = kde(spark.createDataFrame([(x,) for x in xs], "v double"), "v", 50).orderBy("g").collect()
    xs = [x for x in xs if x is not None]
    n, mean = len(xs), sum(xs) / len(xs)
    h = math.sqrt(sum((x - mean) ** 2 for x in xs) / (n - 1)) * n ** -0.2
    for r in got:
        want = sum(math.exp(-0.5 * ((r["x"] - x) / h) ** 2) for x in xs) / (n * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(want, rel=1e-9, abs=1e-15)
    assert kde(spark.createDataFrame([(1.0,), (1.0,)], "v double"), "v").count() == 0
