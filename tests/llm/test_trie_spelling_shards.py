"""Prefix tries, spelling groups and shards against plain renditions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from presslens.llm import prefix_trie as trie_module
from presslens.llm.hypershard import communication_matrix, hypergeometric, shard_rows, write_shards
from presslens.llm.prefix_trie import SearchTree, conversation_trie, encode_turns, median_order, prefix_trie, splice_heads
from presslens.llm.spelling_partenum import balanced_parts, near_pairs, signatures, spelling_groups, typed
from presslens.sources.tables import table
from tests.llm.helpers import awkward

TURNS = "conv_id long, turn long, role string, text string, seg long, ids string, `key` string"


def turns_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "i", "k") for r in rows], TURNS)


def ordered(rows):
    """Turns (role, text) of every conversation."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}


def spliced(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out = []

    def below(p):
        todo, found = [p], []
        while todo:
            found.append(todo.pop())
            todo += kids[found[-1]]
        return found

    for p, ms in members.items():
        sub = below(p)
        saved = sum((len(members[q]) - 1) * len((q[-1][1]).encode().split()) for q in sub if q)
        ends = ",".join(str(c) for c in ms if len(convs[c]) == len(p))
        out.append((ms[0], len(p), members[p[:-1]][0] if p else None, len(ms), len(kids[p]), sum(not kids[q] for q in sub), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def conversations(seed=1, n=90):
    """Shared openings, equal conversations (a third of all), prefixes of others, awkward rows."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 3 == 0:
            seq = [("user", "hot one"), ("assistant", "two words three")]
        else:
            seq = [(rng.choice(["user", "assistant"]), rng.choice(["a", "b c", "d e f", ""])) for _ in range(rng.randrange(1, 7))]
        rows += [(c, k, r, t) for k, (r, t) in enumerate(seq)]
    rows += [(200, None, None, "x y"), (200, 0, "user", None), (200, 0, "user", None), (200, 5, "user", "b"), (200, 5, "user", "a"),
             (None, 0, "user", "lost"), (240, 1, "user", "one"), (241, 0, "a", "b")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment, held", [(256, 1 << 18), (2, 1 << 18), (256, 6), (1, 3), (3, 10)])
def test_trie_over_segments_and_shards(spark, monkeypatch, segment, held):
    """The same trie whatever is cut: segments of few turns, search trees of few sequences."""
    monkeypatch.setattr(trie_module, "_SHARD_IDS", held)
    rows = conversations()
    convs = spliced(ordered(rows))
    turns = turns_frame(spark, rows).repartition(5)
    assert found(prefix_trie(*splice_heads(encode_turns(turns)), segment)) == plain_trie(convs)


def test_trie_of_conversations_as_they_are(spark):
    rows = conversations(2, 40) + [(300, k, "user", f"t{k}") for k in range(600)] + [(301, k, "user", f"t{k}") for k in range(550)]
    assert found(conversation_trie(turns_frame(spark, rows))) == plain_trie(ordered(rows))
    assert conversation_trie(turns_frame(spark, rows).where("false")).count() == 0
    alone = conversation_trie(turns_frame(spark, [(-3, 1, None, None)]))
    assert found(alone) == plain_trie({-3: [("", "")]})


def test_conversations_without_turns(spark):
    """All turns of a conversation can go when its opening is not there."""
    rows = [(c, 0, "user", "x") for c in range(21, 40)] + [(c, 0, "user", "y") for c in range(40, 45)]
    convs = spliced(ordered(rows))
    assert any(not v for v in convs.values())
    assert found(prefix_trie(*splice_heads(encode_turns(turns_frame(spark, rows))))) == plain_trie(convs)


def test_hashes_of_many_ends(spark, monkeypatch):
    monkeypatch.setattr(trie_module, "_IDS_CHUNK", 7)
    rows = [(c, 0, "user", "same") for c in range(500)] + [(c, 0, "user", f"{c % 5}") for c in range(500, 540)]
    assert found(conversation_trie(turns_frame(spark, rows).repartition(7))) == plain_trie(ordered(rows))


def test_median_insertion_balances_the_branches():
    assert sorted(median_order(100)) == list(range(100)) and median_order(0) == []
    tree = SearchTree()
    for i in median_order(1000):
        tree.insert([i, 7], [1, 2], 1, i, None)

    def height(node):
        todo, deepest = [(node, 1)], 0
        while todo:
            n, d = todo.pop()
            if n >= 0:
                deepest = max(deepest, d)
                todo += [(tree.lower[n], d + 1), (tree.higher[n], d + 1)]
        return deepest

    assert height(tree.child[0]) <= 11 and tree.children[0] == 1000
    assert tree.totals()[0][0] == 1000 and tree.totals()[1][0] == 0


def plain_spelling(docs, least=7, count=2):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            n[typed("".join(c.lower() if c.isascii() else c for c in run), "" if i is None else str(i))] += 1
    n = {w: k for w, k in n.items() if len(w) >= least and k >= count}
    near = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            near[(w[:i], w[i + 1:])].add(w)
    links = defaultdict(set)
    for group in near.values():
        for a, b in itertools.permutations(group, 2):
            links[a].add(b)
    for w in n:
        for i in range(len(w)):
            short = w[:i] + w[i + 1:]
            if short in n:
                links[w].add(short)
                links[short].add(w)
    form = {}
    for w in n:
        best = min(links[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(links[w]), n.get(form[w])))
    return sorted(out, key=repr)


def test_spelling_groups_against_plain(spark):
    rng = random.Random(7)
    base = ["anagrams", "nagarams", "aaaaaaab", "aaaaaaaa", "straße", "größere", "Größere", "ÀÉÎõüÿñ", "letters", "lettres", "setters"]
    docs = []
    for i in range(150):
        words = []
        for _ in range(40):
            w = rng.choice(base)
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", rng.choice("abcßé"), w[k] + rng.choice("xyz")]) + w[k + 1:]
            words.append(w)
        docs.append((i if i % 50 else None, rng.choice([" ", ", ", "1", "-"]).join(words)))
    docs += [(1000, None), (1001, ""), (1002, "anagrams " * 3000), (1002, "anagrams " * 3000)]
    got = spelling_groups(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_spelling(docs)


def test_chains_of_forms(spark):
    counts = {"chainsaa": 2, "chainsab": 20, "chainsbb": 200, "chainsbbb": 2000, "other": 9}
    docs = [(None, " ".join(w for w, n in counts.items() for _ in range(n)))]
    want = plain_spelling(docs)
    assert sorted((tuple(r) for r in spelling_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()), key=repr) == want
    assert len({r[2] for r in want}) < len(want) and max(r[3] for r in want) >= 1000
    assert spelling_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert spelling_groups(awkward(spark).select("doc_id", "text", "lang")).count() >= 0


def test_signatures_meet_within_the_distance():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(7, 12))) for _ in range(300)]
    part_of = balanced_parts({ord(c) * 9 + k: rng.randrange(1, 300) for c in "abcde" for k in (1, 2)}, 300, 5)
    changed = [w[:k] + "z" + w[k + 1:] for w in words for k in [rng.randrange(len(w))]]
    longer = [w[:k] + "q" + w[k:] for w in words for k in [rng.randrange(len(w))]]
    a, bits_a = signatures(words, part_of, 5, 2)
    b, bits_b = signatures(changed, part_of, 5, 2)
    assert (a == b).any(axis=0).all() and all(int(x ^ y).bit_count() <= 2 for x, y in zip(bits_a, bits_b))
    a, _ = signatures(words, part_of, 5, 1, 1)
    b, _ = signatures(longer, part_of, 5, 1)
    assert (a == b).any(axis=0).all() and a.shape == (5, 300)


def test_pairs_come_once_and_only_verified_ones_leave_the_join(spark):
    words = [(i, w) for i, w in enumerate(["aaaaaaa", "aaaaaab", "aaaaaaab", "baaaaaa", "abcdefg", "gfedcba", "abcdefgh"])]
    got = sorted(tuple(r) for r in near_pairs(spark.createDataFrame(words, "id long, word string")).collect())
    assert got == [(0, 1), (0, 2), (0, 3), (1, 2), (4, 6)]


@pytest.mark.parametrize("total, good, draws", [(60, 20, 15), (10, 10, 4), (7, 3, 7), (1000, 1, 500), (100000, 30000, 5000)])
def test_hypergeometric_draws(spark, total, good, draws):
    n = 4000
    u = (F.col("id") + 0.5) / n
    args = [F.lit(x).cast("long") for x in (total, good, draws)]
    got = np.array([r[0] for r in spark.range(0, n, numPartitions=4).select(hypergeometric(*args, u)).collect()])
    assert got.min() >= max(0, draws - total + good) and got.max() <= min(draws, good)
    mean = draws * good / total
    var = mean * (1 - good / total) * (total - draws) / max(total - 1, 1)
    # evenly spread uniforms give the distribution itself, up to their spacing
    assert abs(got.mean() - mean) < 0.02 * var ** 0.5 + 1e-9 and abs(got.var() - var) < 0.05 * var + 1e-9
    if total <= 60:
        want = np.bincount(np.random.default_rng(0).hypergeometric(good, total - good, draws, 200_000), minlength=draws + 1) / 200_000
        assert np.abs(np.bincount(got, minlength=draws + 1) / n - want).max() < 0.01


def test_matrix_has_the_rows_of_partitions_and_the_sizes_of_shards(spark):
    sizes = [0, 5, 1, 700, 33, 0, 12, 1000, 4, 9, 250]
    m = communication_matrix(spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "part int, n long"), 7)
    rows = {r["part"]: r["sent"] for r in m.collect()}
    assert {p: sum(v) for p, v in rows.items()} == dict(enumerate(sizes)) and min(min(v) for v in rows.values()) >= 0
    total = [sum(c) for c in zip(*rows.values())]
    assert sum(total) == sum(sizes) and max(total) - min(total) <= 1
    other = {r["part"]: r["sent"] for r in communication_matrix(
        spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "part int, n long"), 7, seed=1).collect()}
    assert other != rows


def test_shards_are_exact_whole_and_the_same_again(spark):
    docs = awkward(spark)
    for rows, shards in ((docs, 4), (docs, 40), (table(spark, "/root/testdata/sf0.001", "documents").withColumn("shard", F.lit("x")), 16)):
        kept = [c for c in rows.columns if c != "shard"]
        got = shard_rows(rows, shards).collect()
        assert [*kept, "shard", "slot"] == list(got[0].asDict())
        assert Counter(tuple(r[c] for c in kept) for r in got) == Counter(tuple(r) for r in rows.select(*kept).collect())
        slots = defaultdict(list)
        for r in got:
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(shards))
        held = [len(slots[s]) for s in range(shards)]
        assert max(held) - min(held) <= 1
        assert Counter(map(repr, got)) == Counter(map(repr, shard_rows(rows, shards).collect()))
    assert shard_rows(docs.where("false"), 16).count() == 0


def test_shuffle_is_uniform(spark):
    """Places of all rows, over shards and slots, are as spread as those of a uniform permutation."""
    rows = spark.range(0, 3000, numPartitions=6)
    seen = np.zeros((6, 5), int)
    for seed in range(4):
        for r in shard_rows(rows, 5, seed).collect():
            seen[r["id"] // 500, r["shard"]] += 1
    assert (seen.sum(axis=0) == 2400).all()
    # block by shard: mean 400, hypergeometric deviation about 16.3 a cell
    assert ((seen - 400) ** 2 / 267).sum() < 20 + 5 * (2 * 20) ** 0.5 and len(set(seen.ravel())) > 5
    place = sorted((r["shard"], r["slot"], r["id"]) for r in shard_rows(rows, 5).collect())
    ids = np.array([i for _, _, i in place])
    assert abs(np.corrcoef(ids[:-1], ids[1:])[0, 1]) < 0.08 and abs(np.corrcoef(ids, np.arange(3000))[0, 1]) < 0.08


def test_written_shards(spark):
    from presslens.session import shared_dir
    path = shared_dir(spark, "t-shards")
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    write_shards(docs, path, 8)
    back = spark.read.parquet(path)
    assert back.groupBy("shard").count().agg(F.min("count"), F.max("count"), F.count("*")).first()[:] == (25, 25, 8)
    assert back.select("doc_id").distinct().count() == docs.count() == 200


def test_native_plans_have_no_python(spark):
    from presslens.llm.queries import op13_hypergeometric_shards
    plan = op13_hypergeometric_shards(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
