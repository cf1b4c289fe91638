import numpy as np
import pytest
from pyspark.sql import functions as F

from presslens.llm.blocked_knn import bounds, nearest, quantise
from presslens.llm import pca_neardup
from presslens.llm.pca_neardup import chunk_ranges, first_cut, laid_out, linked_pairs, near_duplicates, principal_axes, rotate
from presslens.llm.vectors import cosines, matrix, pack_matrix, unit

SCHEMA = "vec_id long, embedding array<float>, label string, cid string, tile string"


def table_of(spark, vectors):
    return spark.createDataFrame([(i, v if v is None else [None if x is None else float(x) for x in v], "l", "c", "t")
                                  for i, v in vectors], SCHEMA)


def clustered(n=240, dim=24, seed=3):
    """Clusters of near and exact copies, one of them holding a third of the rows."""
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, dim))
    m[: n // 3] = rng.normal(size=dim)
    m[n // 6: n // 3] += rng.normal(size=(n // 6, dim)) * 0.25
    m[150:170] = m[149] + rng.normal(size=(20, dim)) * np.linspace(0.05, 0.6, 20)[:, None]
    m[200] = 3 * m[201]
    return m.astype(np.float32)


BAD = [(900, None), (901, []), (902, [0.0] * 24), (903, [None] + [1.0] * 23), (904, [float("nan")] * 24), (905, [float("inf")] * 24)]


def brute_links(ids, m, t):
    m = m.astype(np.float64)
    n = len(m)
    i, j = np.triu_indices(n, 1)
    ok = cosines(m[i], m[j]) >= t
    i, j = i[ok], j[ok]
    links = np.bincount(i, minlength=n) + np.bincount(j, minlength=n)
    label = list(range(n))
    for _ in range(n):
        old = list(label)
        for a, b in zip(i, j):
            label[a] = label[b] = min(label[a], label[b])
        if label == old:
            break
    return {x: (int(k), ids[c]) for x, k, c in zip(ids, links, label)}


def test_near_duplicates_against_all_pairs(spark):
    m = clustered()
    ids = list(range(10, 10 + len(m)))
    got = near_duplicates(table_of(spark, [*zip(ids, m.tolist()), *BAD, (990, [1.0, 2.0])]), tile_rows=16).collect()
    want = {**brute_links(ids, m, 0.9), **{i: (0, i) for i, _ in BAD}, 990: (0, 990)}
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_near_duplicates_in_many_chunks(spark):
    """Vectors of two lengths compared with chunks of about 20 of them."""
    m, short = clustered(), clustered(240, 5, seed=4)
    ids, others = list(range(10, 10 + len(m))), list(range(1000, 1000 + len(short)))
    got = near_duplicates(table_of(spark, [*zip(ids, m.tolist()), *zip(others, short.tolist()), *BAD]), tile_rows=8, broadcast_bytes=4000).collect()
    want = {**brute_links(ids, m, 0.9), **brute_links(others, short, 0.9), **{i: (0, i) for i, _ in BAD}}
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want


def test_near_duplicates_join_no_vectors(spark, monkeypatch):
    """A join may shuffle either side: vectors, once for each pair of tiles, must not be in one."""
    m, joined, frame = clustered(), [], type(spark.range(0))
    join = frame.join

    def watched(self, other, *args, **named):
        joined.extend([*self.dtypes, *other.dtypes])
        return join(self, other, *args, **named)

    monkeypatch.setattr(frame, "join", watched)
    near_duplicates(table_of(spark, [*zip(range(len(m)), m.tolist())]), tile_rows=16, broadcast_bytes=4000).collect()
    assert joined and not [c for c, kind in joined if kind.startswith("array") or kind == "binary" and c != "key"]


def test_chunk_ranges_cover_all_ids_once():
    files = [(3, 7, 700), (0, 5, 100), (1, 1, 900), (2, 4, 4)]
    got = chunk_ranges(files, 250)
    ids = [(f << 33) + k for f, n, _ in sorted(files) for k in range(n)]
    assert [i for lo, hi in got for i in ids if lo <= i < hi] == ids
    assert all(a[1] <= b[0] for a, b in zip(got, got[1:])) and chunk_ranges([], 250) == []
    assert len(chunk_ranges(files, 10_000)) == 1


def test_near_duplicates_of_negative_zero(spark):
    got = near_duplicates(table_of(spark, [(4, [0.0, 1.0]), (5, [-0.0, 1.0]), (6, [1.0, -0.0])])).collect()
    assert {tuple(r) for r in got} == {(4, 1, 4, True), (5, 1, 4, False), (6, 0, 6, True)}


def test_near_duplicates_edge_tables(spark):
    assert near_duplicates(table_of(spark, [])).count() == 0
    same = table_of(spark, [(7, [1.0, 2.0]), (7, [1.0, 2.0]), (None, [1.0, 2.0]), (3, None), (None, None)])
    got = sorted((tuple(r) for r in near_duplicates(same).collect()), key=repr)
    assert got == sorted([(7, 2, 7, True), (7, 2, 7, True), (None, 2, 7, False), (3, 0, 3, True), (None, 0, None, True)], key=repr)
    twice = near_duplicates(table_of(spark, [(1, [1.0, 0.0]), (2, [2.0, 0.0])]).withColumn("embedding", F.col("embedding").cast("array<double>")))
    assert {r["component_id"] for r in twice.collect()} == {1}


@pytest.mark.parametrize("same", [False, True])
@pytest.mark.parametrize("cuts", [[2, 4, 8, 16, 24], [8, 16, 24], [24]])
def test_pairs_stop_only_below_the_threshold(same, cuts):
    m = clustered().astype(np.float64)
    a, b = (m, m) if same else (m[:100], m[100:])
    basis = [(0, np.linalg.eigh(unit(m).T @ unit(m))[1])], np.arange(24)[::-1], cuts
    i, j = linked_pairs(a, b, laid_out(a, basis), laid_out(b, basis), cuts, 0.9, same)
    x, y = np.meshgrid(range(len(a)), range(len(b)), indexing="ij")
    ok = cosines(a[x.ravel()], b[y.ravel()]) >= 0.9
    want = {(p, q) for p, q in zip(x.ravel()[ok], y.ravel()[ok]) if not same or p < q}
    assert set(zip(i, j)) == want and len(i) == len(want)


def test_first_cut_follows_the_spectrum():
    assert first_cut(np.array([1.0] + [0.0] * 63), 0.9) == 1
    assert 12 <= first_cut(np.ones(64), 0.9) <= 32
    assert first_cut(np.ones(64), 0.99) < first_cut(np.ones(64), 0.5) <= 64
    assert first_cut(np.zeros(3), 0.9) in (1, 2, 3)


def test_axes_by_blocks_of_components(spark, monkeypatch):
    """Vectors too long for one basis: the same links from axes of 5 components each."""
    m = clustered()
    ids = list(range(len(m)))
    t = table_of(spark, [*zip(ids, m.tolist()), (990, [1.0, 2.0])])
    monkeypatch.setattr(pca_neardup, "AXIS_NUMBERS", 2 * 5 * 24)
    basis = principal_axes(t)[24]
    assert [len(x) for _, x in basis[0]] == [5, 5, 5, 5, 4]
    r = rotate(unit(m.astype(np.float64)), basis)
    assert np.allclose((r ** 2).sum(axis=1), 1) and (np.diff((r ** 2).sum(axis=0)) <= 1e-6).all()
    got = {x["vec_id"]: (x["n_links"], x["component_id"]) for x in near_duplicates(t, tile_rows=32).collect()}
    assert got == {**brute_links(ids, m, 0.9), 990: (0, 990)}


def brute_nearest(ids, m, k, queries):
    m = m.astype(np.float64)
    out = []
    for q in queries:
        at = ids.index(q)
        s = cosines(np.repeat(m[at:at + 1], len(m), 0), m)
        order = sorted((x for x in range(len(m)) if ids[x] != q), key=lambda x: (-s[x], ids[x]))[:k]
        out += [(q, r + 1, ids[x], s[x]) for r, x in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("rows", [(7, 13), (512, 2048)])
def test_nearest_is_exact_with_ties(spark, rows):
    m = clustered()
    ids = list(range(len(m)))
    t = table_of(spark, [*zip(ids, m.tolist()), *BAD, (1000, [1.0]), (None, m[0].tolist())])
    got = nearest(t, F.col("vec_id") % 20 == 0, query_rows=rows[0], candidate_rows=rows[1], group_rows=50)
    assert sorted(tuple(r) for r in got.collect()) == brute_nearest(ids, m, 5, range(0, len(m), 20))


def test_nearest_edge_tables(spark):
    few = table_of(spark, [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.0, 1.0]), (50, [1.0, 1.0])])
    got = sorted(tuple(r)[:3] for r in nearest(few, F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 50), (0, 2, 1), (50, 1, 0), (50, 2, 0), (50, 3, 1)]
    assert nearest(few.where("false"), F.lit(True)).count() == 0
    assert nearest(few, F.lit(None).cast("boolean")).count() == 0


def test_int8_products_stay_within_their_bounds():
    rng = np.random.default_rng(0)
    a, b = unit(rng.normal(size=(60, 48))), unit(rng.normal(size=(80, 48)) ** 3)
    near, off = bounds(quantise(a), quantise(b))
    assert (np.abs(near - a @ b.T) <= off).all() and off.max() < 0.1


def test_matrices_keep_their_values():
    for m in (np.array([[0.1, 1 / 3]]), np.array([[0.5, 2.0]])):
        assert (matrix(pack_matrix(m), 2) == m).all()
