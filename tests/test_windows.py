"""Selection operators against brute force, including a hot group holding a
third of the rows, and invariance to the number of partitions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from presslens.operators.windows import (cap_per_group, dedup_keep_first, last_write_wins, rank_slices,
                                         sample_exact, train_val_split, with_position)


def _h(k, seed):
    return hashlib.md5(f"{k}:{seed}".encode()).hexdigest()


def _skewed(spark, n=3000, parts=8):
    # group 'hot' holds a third of all rows
    rows = [(i, "hot" if i % 3 == 0 else f"g{i % 17}") for i in range(n)]
    return spark.createDataFrame(rows, "id long, grp string").repartition(parts)


def test_sample_exact_sizes_and_brute_force(spark):
    df = _skewed(spark)
    got = {(r.id, r.grp) for r in sample_exact(df, 25, "grp", "id", 42).collect()}
    exp = set()
    groups = {}
    for r in df.collect():
        groups.setdefault(r.grp, []).append(r.id)
    for g, ids in groups.items():
        for i in sorted(ids, key=lambda k: (_h(k, 42), k))[:25]:
            exp.add((i, g))
    assert got == exp


def test_sample_exact_of_a_null_group_and_small_groups(spark):
    df = spark.createDataFrame([(i, None if i % 2 else f"g{i % 10}") for i in range(200)], "id long, grp string").repartition(6)
    got = {}
    for r in sample_exact(df, 30, "grp", "id", 1).collect():
        got.setdefault(r.grp, []).append(r.id)
    assert {g: len(v) for g, v in got.items()} == {None: 30, **{f"g{k}": 20 for k in (0, 2, 4, 6, 8)}}
    assert sorted(got[None]) == sorted(sorted((i for i in range(200) if i % 2), key=lambda k: (_h(k, 1), k))[:30])
    assert sample_exact(df.filter("false"), 5, "grp", "id", 1).count() == 0
    assert sample_exact(df.filter("false"), 5, None, "id", 1).count() == 0


def test_ends_come_from_one_bucket_of_keys(spark):
    """Only the bucket that holds a wanted position is ranked; sizes of one, all and more than all rows."""
    from presslens.operators import windows
    ids = sorted(range(3000), key=lambda k: (_h(k, 5), k))
    for n in (0, 1, 7, 2999, 3000, 3001):
        assert sorted(r.id for r in sample_exact(_skewed(spark), n, None, "id", 5).collect()) == sorted(ids[:n]), n
    at = windows._keys_at(_skewed(spark), lambda total: F.array(F.lit(10).cast("long"), total - 1), None, "id", 5)
    assert {(r["__p"], r["__k"]) for r in at.collect()} == {(10, ids[10]), (2999, ids[2999])}


def test_any_number_of_groups_without_a_broadcast(spark):
    """No bound on groups, and ends that are too large to broadcast are joined all the same."""
    df = _skewed(spark).withColumn("grp", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("g"), F.col("id"))))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = sample_exact(df, 25, "grp", "id", 42)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = [r.id for r in out.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Broadcast" not in plan and "CartesianProduct" not in plan, plan
    hot = sorted(range(0, 3000, 3), key=lambda k: (_h(k, 42), k))[:25]
    assert sorted(got) == sorted([*hot, *(i for i in range(3000) if i % 3)])


def test_sample_exact_partition_invariant(spark):
    a = {r.id for r in sample_exact(_skewed(spark, parts=1), 40, "grp", "id", 7).collect()}
    b = {r.id for r in sample_exact(_skewed(spark, parts=13), 40, "grp", "id", 7).collect()}
    assert a == b


def test_sample_exact_global(spark):
    df = _skewed(spark, parts=80)  # more tasks than parts of the first level
    order = sorted(range(3000), key=lambda k: (_h(k, 42), k))
    assert sorted(r.id for r in sample_exact(df, 10, None, "id", 42).collect()) == sorted(order[:10])
    got = {r.id: r.slice for r in rank_slices(df, [(0, 4), (5, 9)], "id", 42).collect()}
    assert got == {**{k: 0 for k in order[:5]}, **{k: 1 for k in order[5:10]}}


@pytest.mark.parametrize("frac", [0.0, 0.5, 1.0])
def test_split_ends(spark, frac):
    got = [r.split for r in train_val_split(_skewed(spark, n=101), frac, "id", 42).collect()]
    assert got.count("train") == int(frac * 101) and len(got) == 101


def test_train_val_split_matches_rank(spark):
    df = _skewed(spark, n=2345)
    got = {r.id: r.split for r in train_val_split(df, 0.9, "id", 42, digits=2).collect()}
    order = sorted(range(2345), key=lambda k: (_h(k, 42), k))
    cut = int(0.9 * 2345)
    assert got == {k: ("train" if i < cut else "val") for i, k in enumerate(order)}


def test_rank_slices(spark):
    df = _skewed(spark, n=500)
    got = {r.id: r.slice for r in rank_slices(df, [(0, 9), (10, 14)], "id", 3).collect()}
    order = sorted(range(500), key=lambda k: (_h(k, 3), k))
    assert got == {**{k: 0 for k in order[:10]}, **{k: 1 for k in order[10:15]}}


def test_dedup_and_last_write_wins(spark):
    rows = [(i % 50 if i % 3 else 0, i, f"v{i}") for i in range(600)]  # key 0 is hot
    df = spark.createDataFrame(rows, "k long, ord long, v string").repartition(7)
    first = {r.k: r.v for r in dedup_keep_first(df, "k", "ord").collect()}
    last = {r.k: r.v for r in last_write_wins(df, "k", "ord", valid=F.col("ord") % 5 != 0).collect()}
    ef, el = {}, {}
    for k, o, v in sorted(rows, key=lambda x: x[1]):
        ef.setdefault(k, v)
        if o % 5 != 0:
            el[k] = v
    assert first == ef and last == el


def test_cap_per_group(spark):
    df = _skewed(spark, n=300)
    got = sorted(r.id for r in cap_per_group(df, "grp", "id", 3).collect())
    exp = []
    seen = {}
    for i in range(300):
        g = "hot" if i % 3 == 0 else f"g{i % 17}"
        if seen.get(g, 0) < 3:
            exp.append(i)
            seen[g] = seen.get(g, 0) + 1
    assert got == sorted(exp)


def test_with_position(spark):
    df = spark.createDataFrame([(i * 7 % 1000,) for i in range(1000)], "o long").repartition(5)
    got = {r.o: r.pos for r in with_position(df, "o").collect()}
    assert got == {o: o for o in range(1000)}


def test_split_partition_invariant(spark):
    a = {r.id: r.split for r in train_val_split(_skewed(spark, n=1500, parts=1), 0.9, "id", 5).collect()}
    b = {r.id: r.split for r in train_val_split(_skewed(spark, n=1500, parts=11), 0.9, "id", 5).collect()}
    assert a == b and sum(v == "train" for v in a.values()) == int(0.9 * 1500)


def test_top_k(spark):
    from presslens.operators.sort import top_k
    df = spark.createDataFrame([(i, (i * 37) % 101) for i in range(3000)], "id long, v long").repartition(40)
    order = [F.col("v").desc(), F.col("id").asc()]
    exp = sorted([(i, (i * 37) % 101) for i in range(3000)], key=lambda r: (-r[1], r[0]))[50:75]
    for spread in (1, 4, 64):
        assert [tuple(r) for r in top_k(df, 25, order, offset=50, spread=spread).collect()] == exp
