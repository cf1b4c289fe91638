import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from presslens.llm.mixing import _keys, mix, mixed_documents, permute, source_targets, taken_words
from presslens.llm.packing_gga import best_fit, crossover, cut_pieces, evolve, fill_of, pack, start_packing
from presslens.sources.tables import table
from tests.conftest import SF
from tests.llm.helpers import awkward, docs_frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reshared(sizes, weights, ratio=1.5, most=2.0):
    """Targets by repeated resharing of the excess."""
    total, caps = ratio * sum(sizes), [most * s for s in sizes]
    fixed = [False] * len(sizes)
    while True:
        rest = total - sum(c for c, f in zip(caps, fixed) if f)
        w = sum(x for x, f in zip(weights, fixed) if not f)
        target = [c if f else rest * x / w for c, f, x in zip(caps, fixed, weights)]
        over = [not f and t > c for t, c, f in zip(target, caps, fixed)]
        if not any(over):
            return target
        fixed = [a or b for a, b in zip(fixed, over)]


@pytest.mark.parametrize("n", [1, 2, 3, 64, 1000, 1023])
def test_permutation(n):
    keys = _keys(42, 3)
    image = permute(np.arange(n), n, keys)
    assert sorted(image) == list(range(n))
    assert (permute(image, n, keys, inverse=True) == np.arange(n)).all()
    assert n < 64 or (image != np.arange(n)).any()


def test_targets_against_resharing(spark):
    sizes = {None: 50, "": 900, "Z": 10, "a": 2000, "é": 30, "😀": 700, "zero": 0}
    got = {r["source"]: r for r in source_targets(spark.createDataFrame(
        [(s, n) for s, n in sizes.items()], "source string, size long")).collect()}
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    want = reshared([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))])
    assert [got[s]["sid"] for s in order] == list(range(len(order)))
    assert [got[s]["target"] for s in order] == pytest.approx(want)


def test_mixture_of_the_table(spark):
    docs = table(spark, SF, "documents")
    sized, spans = mix(docs, block_words=64, shard_slots=500)
    first = sorted(map(tuple, taken_words(sized, spans).select("doc_id", "size", "target", "taken").collect()))
    again = sorted(map(tuple, taken_words(*mix(docs.repartition(5), shard_slots=500)).select("doc_id", "size", "target", "taken").collect()))
    assert first == again and len(first) == docs.count()
    texts = {r["doc_id"]: r for r in docs.collect()}
    taken, target, size = Counter(), {}, Counter()
    for i, n, t, k in first:
        assert n == len(WORD.findall(texts[i]["text"] or "")) and 0 <= k <= 2 * n
        s = texts[i]["source"]
        taken[s] += k
        size[s] += n
        target[s] = t
    order = sorted(target)
    assert [target[s] for s in order] == pytest.approx(reshared([size[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))]))
    for s in order:
        assert abs(taken[s] - target[s]) <= 32
    # every slot holds one block of its source, no block more than its passes
    per = spans.groupBy("sid", "slot").agg(F.countDistinct("block").alias("b"), F.sum(F.col("word_to") - F.col("word_from")).alias("w"))
    assert per.where("b <> 1 or w > 64").count() == 0
    assert spans.groupBy("sid", "block", "pass", "uid").count().where("count > 1").count() == 0
    shards = [r["count"] for r in spans.select("shard", "sid", "slot").distinct().groupBy("shard").count().collect()]
    assert len(shards) > 5 and max(shards) < 1.5 * min(shards)


def test_mixture_of_awkward_rows(spark):
    docs = awkward(spark)
    got = taken_words(*mix(docs)).collect()
    assert len(got) == 14
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert sum(r["taken"] for r in got) == pytest.approx(1.5 * sum(r["size"] for r in got), abs=32 * 6)
    assert mix(docs.where("false"))[1].count() == 0 and taken_words(*mix(docs.where("false"))).count() == 0
    null = docs_frame(spark, [(1, None, None, "a"), (2, "", None, "b")])
    assert [r["taken"] for r in taken_words(*mix(null)).collect()] == [0, 0]


def test_mixed_documents_hold_the_taken_words(spark):
    docs = awkward(spark)
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    sized, spans = mix(docs.select("doc_id", "text", "source"))
    want = sum(r["taken"] for r in taken_words(sized, spans).collect())
    got = out.collect()
    assert sum(len(WORD.findall(r["text"])) for r in got) == want
    by_id = defaultdict(list)
    for r in docs.collect():
        by_id[r["doc_id"]].append(WORD.findall(r["text"] or ""))
    for r in got:
        assert r["n_chars"] == len(r["text"]) and r["uid"] == "u" and r["size"] == "s"
        assert any(not Counter(WORD.findall(r["text"])) - Counter(w) for w in by_id[r["doc_id"]])


def test_taken_words_against_a_plain_mixture(spark):
    """Permutation, slots and what they take of each document, rendered word by word."""
    block, shards_of = 4, 8
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{k}" for k in range(rng.integers(0, 30))), None, rng.choice(["a", "b", "c", "d"])) for i in range(60)]
    rows += [(100 + i, " ".join("hot" for _ in range(9)), None, "a") for i in range(40)] + [(200, None, None, "b"), (201, "one", None, None)]
    docs = docs_frame(spark, rows)
    sized, spans = mix(docs, block_words=block, shard_slots=shards_of, seed=3)
    by_uid = {r["uid"]: r for r in sized.collect()}
    words = defaultdict(list)  # the stream of each source: (document, place of the word in it)
    for r in sorted((r for r in by_uid.values() if r["size"]), key=lambda r: (r["sid"], r["at"])):
        assert r["at"] == len(words[r["sid"]])
        words[r["sid"]] += [(r["uid"], k) for k in range(r["size"])]
    assert {s: len(w) for s, w in words.items()} == {r["sid"]: r["source_size"] for r in by_uid.values() if r["size"]}
    got, slots = defaultdict(Counter), defaultdict(set)
    for r in spans.collect():
        for k in range(r["word_from"], r["word_to"]):
            got[r["sid"]][r["uid"], k] += 1
        slots[r["sid"]].add((r["slot"], r["pass"], r["block"], r["shard"]))
    for sid, w in words.items():
        n = -(-len(w) // block)
        taken = Counter()
        order = permute(np.arange(n), n, _keys(3, sid))
        own = sorted(slots[sid])
        assert [s for s, _, _, _ in own] == list(range(len(own)))  # slots of a source: 0, 1, 2, ...
        for slot, turn, b, _ in own:
            assert (turn, b) == (slot // n, order[slot % n])
            taken.update(w[b * block:(b + 1) * block])
        assert got[sid] == taken
        target = next(r["target"] for r in by_uid.values() if r["sid"] == sid)
        assert abs(sum(taken.values()) - target) <= block
        assert [s for _, _, _, s in own] == sorted(s for _, _, _, s in own) and len({s for _, _, _, s in own}) > (1 if len(own) > 20 else 0)
    totals = {r["uid"]: r["taken"] for r in taken_words(sized, spans).collect()}
    for uid, r in by_uid.items():
        assert totals[uid] == sum(c for (u, _), c in got[r["sid"]].items() if u == uid) <= 2 * r["size"]


def test_words_are_matched_once_a_document(spark):
    """The pattern stands outside the function that is applied to every stretch."""
    plan = mixed_documents(awkward(spark))._jdf.queryExecution().optimizedPlan().toString()
    line = next(x for x in plan.splitlines() if "regexp_extract_all" in x)
    assert line.count("regexp_extract_all") == 1
    inner = line[line.index("slice("):]
    assert "regexp_extract_all" not in inner[:inner.index("word_to")]


def test_best_fit_takes_the_tightest_bin():
    sizes = np.array([6, 5, 4, 3, 2])
    bins, room = np.full(5, -1), []
    best_fit(sizes, np.arange(5), bins, room, 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and room == [0, 0]


def whole(sizes, bins, capacity):
    return len(bins) == len(sizes) and bins.min() >= 0 and fill_of(sizes, bins).max() <= capacity and fill_of(sizes, bins).min() > 0


def test_crossover_keeps_all_items_and_injected_bins():
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 100, 300)
    a, b = (start_packing(sizes, 100, rng, greedy=g) for g in (True, False))
    for _ in range(20):
        child = crossover(sizes, a, b, 100, rng)
        assert whole(sizes, child, 100)
        groups = lambda x: {tuple(np.flatnonzero(x == k)) for k in np.unique(x)}
        assert len(groups(child) & groups(b)) >= len(np.unique(b)) // 8


def fewest(sizes, capacity):
    """The least number of bins, by trying all sets of items (few items)."""
    n = len(sizes)
    best = [(0, 0)] + [(n + 1, 0)] * ((1 << n) - 1)  # bins, fill of the last one
    for s in range(1, 1 << n):
        for i in range(n):
            if s >> i & 1:
                bins, fill = best[s ^ (1 << i)]
                now = (bins, fill + sizes[i]) if bins and fill + sizes[i] <= capacity else (bins + 1, sizes[i])
                best[s] = min(best[s], now)
    return best[-1][0]


def test_evolution_beats_best_fit():
    # best fit puts the fours in pairs and wastes a place in every bin: 24 bins, where 20 hold all
    sizes = np.array([4] * 20 + [3] * 40)
    rng = np.random.default_rng(0)
    pop = [start_packing(sizes, 10, rng, greedy=i == 0) for i in range(6)]
    best_fit_bins = len(fill_of(sizes, pop[0]))
    assert best_fit_bins == 24
    after = evolve(sizes, pop, 10, 400, rng)
    assert all(whole(sizes, p, 10) for p in after)
    assert 20 <= len(fill_of(sizes, after[0])) < best_fit_bins


@pytest.mark.parametrize("seed", range(8))
def test_small_instances_are_solved_exactly(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(2, 9, 11)
    pop = [start_packing(sizes, 12, rng, greedy=i == 0) for i in range(6)]
    assert len(fill_of(sizes, evolve(sizes, pop, 12, 200, rng)[0])) == fewest(sizes.tolist(), 12)


def check_packed(rows, capacity=2048):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_of_the_table(spark):
    import zlib
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = pack(cut_pieces(docs, public_tokenizers.path("word_bpe_49k.json")), cell_items=100).collect()
    sequences = check_packed(rows)
    got = defaultdict(dict)
    for r in rows:
        got[r["doc_id"]][r["piece"]] = (r["start"], r["length"], r["ids_crc32"])
    total = 0
    for d in docs.collect():
        ids = np.array([*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        want = {k: (a, len(ids[a:a + 2048]), zlib.crc32(ids[a:a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048))}
        assert got[d["doc_id"]] == want
    assert sequences <= -(-total // 2048) * 1.02 + 1


def test_packing_edge_tables(spark):
    docs = awkward(spark)
    pieces = cut_pieces(docs, public_tokenizers.path("word_bpe_49k.json")).withColumn("uid", F.lit("u")).withColumn("offset", F.lit(-1))
    rows = pack(pieces, cell_items=4).collect()
    check_packed(rows)
    assert len(rows) == pieces.count() and {r["uid"] for r in rows} == {"u"}
    assert sum(r["length"] == 1 for r in rows) == 4  # null, empty and white texts: the end id alone
    assert pack(pieces.where("false")).count() == 0
    equal = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.lit(512).cast("long").alias("length"))
    assert check_packed(pack(equal, cell_items=500).collect()) <= 752
