"""Scoring bindings (UDF-02..05, JOB-04 batch form), model-output recovery
(JSN-01/02) and event property parsing (JSN-03/05)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens import specs
from presslens.catalog import register
from presslens.functions.jsonparse import with_parsed_output
from presslens.functions.text import prompt_text
from presslens.operators.score import LexiconScorer, WrappingScorer, label_incremental, score_articles, score_models, score_once
from presslens.plans import sql as S
from presslens.session import shared_dir
from presslens.sources.tables import articles, table

# Lexicons for the stand-in scorer, chosen among frequent tokens of the driver
# corpus so scores vary (a real deployment plugs in a model endpoint).
LEFT = ["the", "la", "der", "que"]
RIGHT = ["and", "de", "die", "en"]


def _prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles(spark, sf_dir)
    return a.select("doc_id", "title", prompt_text("title", "text").alias("prompt"))


def _label_cols(c: str = "ai_labels"):
    return [F.round(F.col(f"{c}.bias"), 6).alias("bias"),
            F.array_join(F.col(f"{c}.primary_entities"), ",").alias("entities"),
            F.col(f"{c}.reasoning").alias("reasoning"), F.col(f"{c}.error").alias("error")]


def score_articles_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = score_articles(_prompts(spark, sf_dir), LexiconScorer(LEFT, RIGHT), backoff=0)
    return s.select("doc_id", *_label_cols())


def multi_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = {"lex_a": LexiconScorer(LEFT, RIGHT), "lex_b": LexiconScorer(RIGHT, LEFT),
              "lex_wrapped": WrappingScorer(LexiconScorer(LEFT, RIGHT))}
    s = score_models(_prompts(spark, sf_dir), models, backoff=0)
    return s.select("doc_id", *[F.round(F.col(f"{m}_prediction.bias"), 6).alias(f"{m}_bias") for m in models],
                    F.col("lex_wrapped_prediction.reasoning").alias("lex_wrapped_reasoning"))


def label_incremental_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _prompts(spark, sf_dir)
    done = p.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    s = label_incremental(p, done, LexiconScorer(LEFT, RIGHT), backoff=0)
    return s.select("doc_id", *_label_cols())


def label_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over one ledger: half of the articles, then all; prompts are first lines without their last word, so
    near copies share one. The second run calls for what the first has not answered."""
    from presslens.functions.text import prompt_text
    ledger = shared_dir(spark, "answers")
    a = articles(spark, sf_dir)
    short = F.regexp_replace("title", r"\S+$", "")
    p = a.select("doc_id", "title", prompt_text(short, F.col("source")).alias("prompt"))
    scorer = LexiconScorer(LEFT, RIGHT)
    score_once(p.filter(F.col("doc_id") % 2 == 0), scorer, ledger, backoff=0)
    s = with_parsed_output(score_once(p, scorer, ledger, backoff=0), "model_raw", "ai_labels")
    return s.select("doc_id", *_label_cols())


def _wrap_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model-output strings in the shapes seen in practice, built from the
    article view: clean object, missing '{', trailing fence, leading fence,
    prose around, think block with empty reasoning, orphan closing tag, junk."""
    a = articles(spark, sf_dir)
    w = F.regexp_extract("title", r"^([A-Za-z]+)", 1)
    obj = F.concat(F.lit('{"reasoning": "'), w, F.lit('", "primary_entities": ["'), F.col("source"),
                   F.lit('"], "bias": '), F.col("score").cast("string"), F.lit("}"))
    obj_str_bias = F.concat(F.lit('{"reasoning": "", "bias": "'), F.col("score").cast("string"), F.lit('"}'))
    v = F.col("doc_id") % 8
    raw = (F.when(v == 0, obj)
           .when(v == 1, obj.substr(F.lit(2), F.length(obj)))
           .when(v == 2, F.concat(obj, F.lit("\n```")))
           .when(v == 3, F.concat(F.lit("```json\n"), obj, F.lit("\n```")))
           .when(v == 4, F.concat(F.lit("Here is the result: "), obj, F.lit(" Hope it helps.")))
           .when(v == 5, F.concat(F.lit("<think>thoughts on "), w, F.lit("</think>"), obj_str_bias))
           .when(v == 6, F.concat(F.lit("cut off reasoning</think>"), obj))
           .otherwise(F.lit("no json here")))
    return a.select("doc_id", raw.alias("raw"))


def safe_parse_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _wrap_variants(spark, sf_dir)
    r = with_parsed_output(r, "raw", "p1")
    r = with_parsed_output(r, "raw", "pc", compat=True)
    r = with_parsed_output(r, "raw", "p2", thoughts=True)
    p1, pc, p2 = F.col("p1"), F.col("pc"), F.col("p2")
    return r.select("doc_id", F.round(p1["bias"], 6).alias("v1_bias"), p1["error"].alias("v1_error"),
                    p1["reasoning"].alias("v1_reasoning"),
                    F.round(pc["bias"], 6).alias("compat_bias"),
                    F.round(p2["bias"], 6).alias("v2_bias"), p2["reasoning"].alias("v2_reasoning"),
                    p2.isNull().alias("v2_failed"))


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties (JSON text) parsed wide, cast narrow, then aggregated."""
    e = table(spark, sf_dir, "events")
    k = F.from_json("props", "k string")["k"].try_cast("bigint")
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("sum_k"),
                                       F.max(k).alias("max_k"), F.count_if(k.isNull()).alias("bad_k"))


_PROMPT = (f"{S.q(specs.TITLE_LABEL)} || coalesce(title, '') || chr(10) || "
           f"{S.q(specs.BODY_LABEL)} || coalesce(text, '')")
_IN_L = ", ".join(S.q(x) for x in LEFT)
_IN_R = ", ".join(S.q(x) for x in RIGHT)


def _lex_sql(src: str) -> str:
    return f"""
t AS (SELECT doc_id, title, regexp_extract_all(lower({_PROMPT}), '[a-z]+') AS toks FROM {src}),
c AS (SELECT doc_id, title, toks, len(list_filter(toks, lambda x: x IN ({_IN_L}))) AS nl,
             len(list_filter(toks, lambda x: x IN ({_IN_R}))) AS nr FROM t)"""


_LEX_OUT = f"""SELECT doc_id, round((1.0 + nr) / (2.0 + nl + nr), 6) AS bias,
       coalesce(array_to_string(list_sort(list_distinct(list_filter(toks, lambda x: x IN ({_IN_L}, {_IN_R})))), ','), '') AS entities,
       'left=' || CAST(nl AS VARCHAR) || ' right=' || CAST(nr AS VARCHAR) AS reasoning, CAST(NULL AS VARCHAR) AS error
FROM c"""

register("score_articles", f"WITH a AS ({S.ARTICLES}), {_lex_sql('a')} {_LEX_OUT}")(score_articles_q)

register("multi_model", f"""WITH a AS ({S.ARTICLES}), {_lex_sql('a')}
SELECT doc_id, round((1.0 + nr) / (2.0 + nl + nr), 6) AS lex_a_bias, round((1.0 + nl) / (2.0 + nl + nr), 6) AS lex_b_bias,
       round((1.0 + nr) / (2.0 + nl + nr), 6) AS lex_wrapped_bias,
       'left=' || CAST(nl AS VARCHAR) || ' right=' || CAST(nr AS VARCHAR) AS lex_wrapped_reasoning FROM c""")(multi_model)

register("label_incremental", f"""WITH a AS ({S.ARTICLES}),
done AS (SELECT DISTINCT title FROM a WHERE doc_id IN (SELECT doc_id FROM labels)),
todo AS (SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.title IS NOT DISTINCT FROM a.title)),
{_lex_sql('todo')} {_LEX_OUT}""")(label_incremental_q)


_SHORT = (f"{S.q(specs.TITLE_LABEL)} || regexp_replace(coalesce(title, ''), '\\S+$', '') || chr(10) || "
          f"{S.q(specs.BODY_LABEL)} || coalesce(source, '')")
register("label_once", f"WITH a AS ({S.ARTICLES}), {_lex_sql('a').replace(_PROMPT, _SHORT)} {_LEX_OUT}")(label_once)


def _strip(e):
    return S.strip(e)


def _v1_sql(raw: str, prefix: str) -> str:
    """Columns {prefix}_j (recovered object text or NULL) and {prefix}_c (compat)."""
    r = _strip(raw)
    pref = f"(CASE WHEN starts_with({r}, '{{') THEN {r} ELSE '{{' || {r} END)"
    cleaned = _strip(f"(CASE WHEN ends_with({pref}, '```') THEN left({pref}, length({pref}) - 3) ELSE {pref} END)")
    c1 = f"regexp_extract({cleaned}, '(?s)\\{{.*\\}}', 0)"
    c2 = f"regexp_extract({r}, '(?s)\\{{.*\\}}', 0)"
    # a '{...}' span that is valid JSON is an object
    ok = lambda c: f"({c} <> '' AND coalesce(json_valid({c}), false))"
    return (f"CASE WHEN {ok(c1)} THEN {c1} WHEN {ok(c2)} THEN {c2} END AS {prefix}_j, "
            f"CASE WHEN {ok(c1)} THEN {c1} END AS {prefix}_c")


_W = "regexp_extract(title, '^([A-Za-z]+)', 1)"
_OBJ = (f"'{{\"reasoning\": \"' || {_W} || '\", \"primary_entities\": [\"' || source || '\"], \"bias\": ' "
        f"|| CAST(score AS VARCHAR) || '}}'")
_OBJ_S = "'{\"reasoning\": \"\", \"bias\": \"' || CAST(score AS VARCHAR) || '\"}'"
_RAW = f"""CASE doc_id % 8
  WHEN 0 THEN {_OBJ}
  WHEN 1 THEN substr({_OBJ}, 2)
  WHEN 2 THEN {_OBJ} || chr(10) || '```'
  WHEN 3 THEN '```json' || chr(10) || {_OBJ} || chr(10) || '```'
  WHEN 4 THEN 'Here is the result: ' || {_OBJ} || ' Hope it helps.'
  WHEN 5 THEN '<think>thoughts on ' || {_W} || '</think>' || {_OBJ_S}
  WHEN 6 THEN 'cut off reasoning</think>' || {_OBJ}
  ELSE 'no json here' END"""
_BODY = ("regexp_replace(regexp_replace(regexp_replace(raw, '(?is)<reasoning>.*?</reasoning>', '', 'g'), "
         "'(?is)<think>.*?</think>', '', 'g'), '(?is)^.*?</(?:reasoning|think)>', '')")
_THOUGHT = _strip("regexp_extract(raw, '(?is)<(?:reasoning|think)>(.*?)</(?:reasoning|think)>', 1)")

register("safe_parse", f"""
WITH a AS ({S.ARTICLES}),
r AS (SELECT doc_id, {_RAW} AS raw FROM a),
p AS (SELECT doc_id, raw, {_v1_sql('raw', 'p1')}, {_v1_sql(_BODY, 'p2')}, {_THOUGHT} AS thought FROM r)
SELECT doc_id,
  round(TRY_CAST(json_extract_string(p1_j, '$.bias') AS DOUBLE), 6) AS v1_bias,
  CASE WHEN p1_j IS NULL THEN 'parse_failed' END AS v1_error,
  coalesce(json_extract_string(p1_j, '$.reasoning'), '') AS v1_reasoning,
  round(CASE WHEN p1_c IS NULL THEN -1.0 ELSE TRY_CAST(json_extract_string(p1_c, '$.bias') AS DOUBLE) END, 6) AS compat_bias,
  CASE WHEN raw IS NULL OR raw = '' OR p2_j IS NULL THEN NULL
       ELSE round(TRY_CAST(json_extract_string(p2_j, '$.bias') AS DOUBLE), 6) END AS v2_bias,
  CASE WHEN raw IS NULL OR raw = '' OR p2_j IS NULL THEN NULL
       WHEN {_strip("coalesce(json_extract_string(p2_j, '$.reasoning'), '')")} = '' AND thought <> '' THEN thought
       ELSE coalesce(json_extract_string(p2_j, '$.reasoning'), '') END AS v2_reasoning,
  (raw IS NULL OR raw = '' OR p2_j IS NULL) AS v2_failed
FROM p
""")(safe_parse_q)

register("json_props", """
SELECT event_type, count(*) AS n, CAST(sum(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
       max(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS max_k,
       count(*) FILTER (WHERE TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) IS NULL) AS bad_k
FROM events GROUP BY event_type
""")(json_props)


# --- JOB-12 page analysis ----------------------------------------------------
def page_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markdown text -> purified -> scored -> result card, over whole texts.
    Page title: first line with '#' removed (no page metadata here)."""
    from presslens.functions.text import purify_markdown, py_strip
    from presslens.operators.projections import analysis_card
    a = articles(spark, sf_dir)
    pages = a.select("doc_id", "url",
                     py_strip(F.replace(F.substring_index(py_strip("text"), "\n", 1), F.lit("#"), F.lit("")))
                     .alias("page_title"),
                     purify_markdown("text").alias("text"))
    scored = score_articles(pages, LexiconScorer(LEFT, RIGHT), text_col="text", out="label", backoff=0)
    card = analysis_card(scored, keep=("doc_id",))
    return card.select(
        "doc_id", "title", "lean", "score", "reasoning", F.array_join("tags", ",").alias("tags"), "source")


def parse_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-18: outputs recovered without error, and all outputs."""
    from presslens.operators.aggregates import success_counts
    r = with_parsed_output(_wrap_variants(spark, sf_dir), "raw", "p")
    return success_counts(r.select(F.col("p.error").alias("error")))


register("parse_success", f"""
WITH a AS ({S.ARTICLES}),
r AS (SELECT doc_id, {_RAW} AS raw FROM a),
p AS (SELECT doc_id, {_v1_sql('raw', 'p1')} FROM r)
SELECT count(*) FILTER (WHERE p1_j IS NOT NULL) AS ok, count(*) AS total FROM p
""")(parse_success)

def _page_analysis_sql() -> str:
    from presslens.plans.text_ops import _STOP, _WC, _purify_sql
    purified = f"""
WITH a AS ({S.ARTICLES}),
l AS (SELECT doc_id, url, text, list_transform(string_split({_purify_sql('text')}, chr(10)), lambda x: {S.strip('x')}) AS lines FROM a),
b AS (SELECT *, coalesce(list_min(list_filter(list_transform(lines, lambda x, i: CASE WHEN {_STOP} THEN i END),
                                              lambda y: y IS NOT NULL)), len(lines) + 1) AS stop_at FROM l),
p AS (SELECT doc_id, url, {S.strip(f"replace(split_part({S.strip('text')}, chr(10), 1), '#', '')")} AS page_title,
             coalesce(array_to_string(list_filter(list_slice(lines, 1, stop_at - 1),
                                 lambda x: {_WC} >= {specs.MIN_WORDS_PER_LINE}), chr(10) || chr(10)), '') AS body
      FROM b),
t AS (SELECT *, regexp_extract_all(lower(body), '[a-z]+') AS toks FROM p),
c AS (SELECT *, len(list_filter(toks, lambda x: x IN ({_IN_L}))) AS nl, len(list_filter(toks, lambda x: x IN ({_IN_R}))) AS nr,
             (1.0 + len(list_filter(toks, lambda x: x IN ({_IN_R})))) /
             (2.0 + len(list_filter(toks, lambda x: x IN ({_IN_L}))) + len(list_filter(toks, lambda x: x IN ({_IN_R})))) AS bias
      FROM t)"""
    lo, hi = specs.LEAN_ANALYZER
    return purified + f"""
SELECT doc_id,
  CASE WHEN body = '' THEN 'Scrape Failed'
       ELSE coalesce(nullif(page_title, ''), 'Analysis of ' || substring(url, 1, 25) || '...') END AS title,
  CASE WHEN body = '' THEN 'Center' WHEN bias <= {lo} THEN 'Left' WHEN bias >= {hi} THEN 'Right' ELSE 'Center' END AS lean,
  CASE WHEN body = '' THEN 50 ELSE CAST(trunc(bias * 100.0) AS INTEGER) END AS score,
  CASE WHEN body = '' THEN NULL ELSE 'left=' || CAST(nl AS VARCHAR) || ' right=' || CAST(nr AS VARCHAR) END AS reasoning,
  CASE WHEN body = '' THEN '' ELSE coalesce(array_to_string(list_sort(list_distinct(
       list_filter(toks, lambda x: x IN ({_IN_L}, {_IN_R})))), ','), '') END AS tags,
  CASE WHEN body = '' THEN NULL ELSE substring(url, 1, 25) END AS source
FROM c"""


register("page_analysis", _page_analysis_sql())(page_analysis)
