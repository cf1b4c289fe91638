import numpy as np
import xxhash
from pyspark.sql import functions as F

from presslens.llm.simhash_bk import BKTree, fingerprint, fingerprint_column, forest, keep_one, near_duplicate_groups
from presslens.sources.tables import table
from tests.llm.helpers import awkward, docs_frame


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(values, radius):
    label = list(range(len(values)))
    pairs = [(i, j) for i in range(len(values)) for j in range(i) if bin(values[i] ^ values[j]).count("1") <= radius]
    while True:
        old = list(label)
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
        if old == label:
            return label


def test_fingerprint_bit_by_bit(spark):
    texts = [None, "", " \n", "One", "a b", "A b c", "a b c a b c a b c", "é ü\tx y\x0bz", "w " * 40_000 + "end"]
    for t in texts:
        assert fingerprint(t) == plain_fingerprint(t)
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("fp", fingerprint_column("text"))
    assert [r["fp"] & (1 << 64) - 1 for r in df.collect()] == [plain_fingerprint(t) for t in texts]
    # Spark's own hash is the same function
    one = spark.createDataFrame([("a b c",)], "t string").select(F.xxhash64("t").alias("h")).first()["h"]
    assert one & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"a b c", seed=42)


def test_tree_edges_are_distances_and_search_is_exact():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = np.unique(np.concatenate([base, *[base ^ (np.uint64(1) << np.uint64(b)) for b in (3, 17, 40)],
                                       base ^ np.uint64(0b1010001)]))
    tree = BKTree.load(BKTree(values).dump())
    for k in range(1, len(values)):
        p = tree.parent[k]
        assert p >= 0 and tree.edge[k] == bin(int(values[k]) ^ int(values[p])).count("1")
    for radius in (0, 1, 2, 4):
        q, n = tree.within(values, radius)
        want = {(i, j) for i, a in enumerate(values) for j, b in enumerate(values) if bin(int(a) ^ int(b)).count("1") <= radius}
        assert set(zip(q.tolist(), n.tolist())) == want
    assert forest(np.array([3, 1]), np.array([2, 2]), 5).tolist() == [0, 1, 1, 1, 4]


def test_groups_against_all_pairs_with_a_hot_block(spark):
    rng = np.random.default_rng(9)
    values = [int(x) for x in rng.integers(0, 1 << 63, 60)]
    # a third of all share one bit block and lie near each other
    values += [values[0] ^ int(sum(1 << int(b) for b in rng.choice(np.arange(25, 64), 3, replace=False))) for _ in range(80)]
    values += [values[0] ^ 1, values[1] ^ 5, values[2] ^ 7, values[3], values[3]]
    ids = [int(x) for x in rng.permutation(len(values))]
    df = spark.createDataFrame([(i, v - (1 << 64) if v >> 63 else v) for i, v in zip(ids, values)], "doc_id long, fp long")
    label = groups(values, 2)
    least = {c: min(i for i, x in zip(ids, label) if x == c) for c in label}
    want = {i: least[c] for i, c in zip(ids, label)}
    for size, limit in ((8, 1 << 20), (8, 0), (4096, 1 << 20)):
        got = near_duplicate_groups(df, tree_size=size, broadcast_bytes=limit)
        assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want


def test_query_table_against_all_pairs(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = near_duplicate_groups(docs.select("doc_id", fingerprint_column("text").alias("fp"))).collect()
    values = [plain_fingerprint(r["text"]) for r in docs.select("text", "doc_id").orderBy("doc_id").collect()]
    ids = [r["doc_id"] for r in docs.select("doc_id").orderBy("doc_id").collect()]
    label = groups(values, 2)
    least = {}
    for i, c in zip(ids, label):
        least[c] = min(i, least.get(c, i))
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: least[c] for i, c in zip(ids, label)}


def test_keep_one_of_awkward_rows(spark):
    docs = awkward(spark)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    texts = [r["text"] for r in docs.collect()]
    assert len(got) == len(set(groups([plain_fingerprint(t) for t in texts], 2)))
    assert [i for i, t in got if t and t.startswith("the ring") and not t.endswith("x")] == [1]
    assert kept.where("uid = 'u' and fp = 'f' and doc = 'd'").count() == len(got)
    assert keep_one(docs.where("false")).count() == 0
    assert keep_one(docs_frame(spark, [(None, "a b c", None, None), (None, "a b c", None, None)])).count() == 1
