import re

import pytest

import corpus_pipeline
from presslens.llm import queries as llm
from presslens.llm.common import components, prefix_sums, written
from presslens.llm.simhash_bk import fingerprint
from presslens.llm.toxicity_chain import THRESHOLD, fit, predict
from presslens.sources.tables import table
from tests.conftest import SF
from tests.llm.helpers import awkward
from tests.llm.test_mixing_and_packing import check_packed
from tests.llm.test_simhash import groups
from tests.oracle_harness import compare

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_against_sql(spark, name):
    ok, msg, _ = compare(spark, name, llm.QUERIES[name], llm.ORACLE[name], SF)
    assert ok, msg


def test_all_thirteen_are_registered():
    import __spark_entry__
    names = __spark_entry__.queries()
    assert [sum(bool(re.match(rf"op{n}_", q)) for q in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names and [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "toxicity", "near duplicates", "mixing", "packing"]


def test_stages_one_by_one(spark):
    docs = table(spark, SMALL, "documents")
    stage = dict(corpus_pipeline.STAGES)
    kept = written(stage["language ID"](spark, docs, SMALL), "t")
    ids = {r["doc_id"] for r in kept.collect()}
    for r in docs.collect():  # all prose stays, texts without letters go
        assert (r["doc_id"] in ids) == any(c.isalpha() for c in r["text"] or "")
    assert kept.columns == docs.columns

    clean = written(stage["toxicity"](spark, kept, SMALL), "t")
    p = predict(kept, fit(kept, table(spark, SMALL, "labels")))
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in p.where(f"p_toxic < {THRESHOLD}").collect()}

    rows = sorted(clean.collect(), key=lambda r: r["doc_id"])
    label = groups([fingerprint(r["text"]) for r in rows], 2)
    single = written(stage["near duplicates"](spark, clean, SMALL), "t")
    assert {r["doc_id"] for r in single.collect()} == {rows[c]["doc_id"] for c in label}

    mixed = written(stage["mixing"](spark, single, SMALL), "t")
    words = lambda df: sum(len((r["text"] or "").encode().split()) for r in df.collect())
    assert words(mixed) == pytest.approx(1.5 * words(single), abs=32 * 25)
    assert {r["doc_id"] for r in mixed.collect()} <= {r["doc_id"] for r in single.collect()}

    packed = stage["packing"](spark, mixed, SMALL).collect()
    check_packed(packed)
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in mixed.collect()}


def test_awkward_rows_pass_all_stages(spark):
    docs = awkward(spark)
    out = docs
    for name, f in corpus_pipeline.STAGES[:-1]:
        out = written(f(spark, out, SMALL), "t")
        assert out.columns == docs.columns
    assert {r["doc_id"] for r in out.collect()} <= {None, 1, 3, 7, 9, 10, 11}
    assert corpus_pipeline.STAGES[-1][1](spark, docs.where("false"), SMALL).count() == 0


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, x) for x in range(200, 300)] + [(1, 2), (2, 3), (3, 1), (5, 5), (3, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{x: 1 for x in [1, 2, 3, 7, *range(200, 300)]}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_prefix_sums_over_ties(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(200)], "k long, v long")
    got = sorted(tuple(r) for r in prefix_sums(df, ["k"], "v", "before", "t").select("before", "k", "v").collect())
    at = 0
    for before, _, v in sorted(got, key=lambda r: (r[0], r[2])):
        assert before == at
        at += v
    assert [k for _, k, _ in got] == sorted(k for _, k, _ in got)
