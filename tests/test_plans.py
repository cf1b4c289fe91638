"""Physical-plan properties of every registered query (sf0.001 for speed):
no Cartesian products or nested-loop joins, Python only where the operator
needs it, pruned scans for the flagship."""

import contextlib
import io

import pytest

from presslens import catalog

SMALL = "/root/testdata/sf0.001"
PYTHON_OK = {"score_articles", "multi_model", "label_incremental", "page_analysis", "page_articles",
             "quality_rollup", "stream_scored"}
STATEFUL = {"stream_scored", "stream_cutoffs", "stream_clean", "upsert", "patch", "sitemap_scan", "balanced_shuffled", "positional_mae",
            "jsonl_roundtrip", "json_auto_roundtrip", "csv_roundtrip", "json_array_roundtrip", "split_json_roundtrip", "array_lines",
            "sample_load", "stream_cutoffs_state", "live_source_means", "sitemap_frontier", "feed_by_cursor", "label_once"}


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - STATEFUL))
def test_no_cross_products_and_python_only_where_needed(spark, name):
    plan = _plan(catalog.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, plan
    if name not in PYTHON_OK:
        for node in ("MapInPandas", "PythonMapInArrow", "ArrowEvalPython", "BatchEvalPython"):
            assert node not in plan, (name, node)


@pytest.mark.parametrize("name", ["sample_per_source", "shuffle_slices", "train_val_split", "dataset_build", "balance_classes",
                                  "sft_pairs", "sitemap_filter", "ingest_incremental", "state_merge", "feed_page", "cap_per_domain"])
def test_no_nested_loops_when_nothing_is_small(spark, name):
    """The plans large inputs would get: Spark broadcasts nothing by itself."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        plan = _plan(catalog.queries()[name](spark, SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, plan


def test_sampling_moves_keys_only(spark):
    """The texts of the sampled documents are filtered where they are."""
    from pyspark.sql import functions as F

    from presslens.operators.windows import sample_exact, train_val_split
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for df in (sample_exact(docs, 5, "source", "doc_id", 1), sample_exact(docs, 5, None, "doc_id", 1), train_val_split(docs, 0.5, "doc_id", 1)):
        plan = _plan(df.withColumn("n", F.length("text")))
        scans = [line for line in plan.splitlines() if "ReadSchema" in line]
        assert sum("text:string" in s for s in scans) == 1
        top = plan[:plan.index("text#")]
        assert "Exchange hashpartitioning" not in top.split("BroadcastExchange")[0], plan


def test_flagship_scan_is_pruned(spark):
    plan = _plan(catalog.queries()["clean_feed"](spark, SMALL))
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert schemas and all("lang" not in s and "n_chars" not in s for s in schemas)


def test_feed_page_is_bounded_top_k(spark):
    plan = _plan(catalog.queries()["feed_page"](spark, SMALL))
    assert "TakeOrderedAndProject" in plan and "WindowGroupLimit" in plan
