"""Text cleaning bindings (STR-01..06) over the article view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens import specs
from presslens.catalog import register
from presslens.functions.text import (apply_marker_rules, collapse_ws, general_clean,
                                      purify_markdown, truncate)
from presslens.plans import sql as S
from presslens.sources.tables import table

# Marker rules bound to the driver's sources (rules are data): one source per
# reference mode - keep-before then keep-after-last (two markers), three
# keep-before markers, and one keep-after-last - using tokens that occur in the text.
DOC_MARKER_RULES = [
    ("src0", "before", ". The"),
    ("src0", "after_last", " and "),
    ("src1", "before", " que "),
    ("src1", "before", " und "),
    ("src1", "before", " the "),
    ("src2", "after_last", "."),
]
DOC_GENERAL_MARKER = " la "
DOC_DROP_SENTENCE = " the"


def marker_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "source",
                    apply_marker_rules("text", "source", DOC_MARKER_RULES).alias("cleaned"))


def general_clean_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", general_clean("text", DOC_GENERAL_MARKER, DOC_DROP_SENTENCE).alias("cleaned"),
                    general_clean("text").alias("cleaned_default"))


def whitespace_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", collapse_ws("text").alias("normalized"))


def markdown_purify(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    md = purify_markdown("text")
    return d.select("doc_id", md.alias("purified")).select(
        "doc_id", "purified", truncate("purified", 4000).alias("purified_4000"))


def _ws_norm_sql(e: str) -> str:
    return f"nullif({S.strip(f'regexp_replace({e}, {S.q(specs.WS)} || \'+\', \' \', \'g\')')}, '')"


def _purify_sql(e: str) -> str:
    ws, nws = specs.WS, specs.NON_WS
    t0 = f"coalesce({e}, '')"
    t1 = f"CASE WHEN strpos({t0}, '# ') > 0 THEN substr({t0}, strpos({t0}, '# ')) ELSE {t0} END"
    t2 = f"regexp_replace({t1}, '!\\[.*?\\]\\(.*?\\)', '', 'g')"
    t3 = f"regexp_replace({t2}, '\\[(.*?)\\]\\(.*?\\)', '\\1', 'g')"
    t4 = f"regexp_replace({t3}, 'https?://{nws}+', '', 'g')"
    return t4


_STOP = " OR ".join(f"contains(lower(x), {S.q(p)})" for p in specs.STOP_PHRASES)
_WC = f"CASE WHEN x = '' THEN 0 ELSE len(string_split_regex(x, '{specs.WS}+')) END"

register("marker_clean", f"""
SELECT doc_id, source, {S.marker_rules('text', 'source', DOC_MARKER_RULES)} AS cleaned FROM documents
""")(marker_clean)

register("general_clean", f"""
SELECT doc_id,
  CASE WHEN text IS NULL OR text = '' THEN NULL ELSE
    {S.strip(f"replace(split_part(text, {S.q(DOC_GENERAL_MARKER)}, 1), {S.q(DOC_DROP_SENTENCE)}, '')")} END AS cleaned,
  {S.general_clean('text')} AS cleaned_default
FROM documents
""")(general_clean_q)

register("whitespace_norm", f"""
SELECT doc_id, {_ws_norm_sql('text')} AS normalized FROM documents
""")(whitespace_norm)

register("markdown_purify", f"""
WITH a AS (SELECT doc_id, list_transform(string_split({_purify_sql('text')}, chr(10)),
                                          lambda x: {S.strip('x')}) AS lines FROM documents),
b AS (SELECT doc_id, lines,
             coalesce(list_min(list_filter(list_transform(lines, lambda x, i: CASE WHEN {_STOP} THEN i END),
                                           lambda y: y IS NOT NULL)), len(lines) + 1) AS stop_at FROM a),
c AS (SELECT doc_id, coalesce(array_to_string(list_filter(list_slice(lines, 1, stop_at - 1),
                                                          lambda x: {_WC} >= {specs.MIN_WORDS_PER_LINE}),
                                              chr(10) || chr(10)), '') AS purified FROM b)
SELECT doc_id, purified, substring(purified, 1, 4000) AS purified_4000 FROM c
""")(markdown_purify)
