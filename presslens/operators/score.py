"""Pluggable scoring on the executors (UDF-01..05).

A scorer turns a pandas Series of prompt texts into raw model-output strings
(what a model endpoint would answer). Scoring is a pandas UDF of the prompt alone,
on the executors; the raw answer is then parsed with the native JSON recovery (JSN-01/02), so
Python only does what needs Python - the call itself. Failures are per row: a text whose call raises is
tried up to ``max_retries`` times and then answered by an error record. ``score_once`` adds a durable ledger of answers
by prompt, so that no prompt is paid for twice.
"""

from __future__ import annotations

import json
import re
import time
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions.jsonparse import with_parsed_output
from presslens.functions.text import ColumnOrName, _c


_TOKEN = re.compile(r"[a-z]+")


class Scorer:
    """Base protocol: ``raw(texts) -> Series[str | None]`` (same index); ``call_rows``: how many texts a call takes
    (1: an endpoint of one prompt a request; a local model takes a batch)."""

    call_rows = 1

    def raw(self, texts: pd.Series) -> pd.Series:  # pragma: no cover - interface
        raise NotImplementedError


class LexiconScorer(Scorer):
    """Deterministic stand-in for a model endpoint: bias from counts of
    lexicon words (lower-case ASCII letter runs), (1 + right) / (2 + left + right);
    entities = the distinct lexicon words seen, sorted."""

    call_rows = 256

    def __init__(self, left: list[str], right: list[str]):
        self.left, self.right = set(left), set(right)

    def raw(self, texts: pd.Series) -> pd.Series:
        left, right = self.left, self.right

        def one(text: str) -> str:
            toks = _TOKEN.findall(text.lower())
            nl = sum(t in left for t in toks)
            nr = sum(t in right for t in toks)
            ents = sorted({t for t in toks if t in left or t in right})
            return json.dumps({"reasoning": f"left={nl} right={nr}", "primary_entities": ents,
                               "bias": (1 + nr) / (2 + nl + nr)}, ensure_ascii=False)
        return texts.fillna("").map(one)


class WrappingScorer(Scorer):
    """Wraps another scorer's output the way chat models do (think block,
    code fence) - used to exercise the recovery path."""

    def __init__(self, inner: Scorer, think: str = "checked the wording"):
        self.inner, self.think, self.call_rows = inner, think, inner.call_rows

    def raw(self, texts: pd.Series) -> pd.Series:
        return "<think>" + self.think + "</think>\n```json\n" + self.inner.raw(texts) + "\n```"


def _error(e: Exception) -> str:
    """JSN-08: the error record a failing row answers with."""
    return json.dumps({"error": f"{type(e).__name__}: {e}", "reasoning": "", "primary_entities": []}, ensure_ascii=False)


def _call(scorer: Scorer, texts: pd.Series, max_retries: int, backoff: float) -> list[tuple[str | None, float, bool]]:
    """One call for ``texts``: (answer, seconds of the call, whether it failed) of each. Where it fails, the texts are called one by
    one, so only those that fail by themselves are tried again (and become error records in the end)."""
    for attempt in range(max(1, max_retries)):
        t0 = time.perf_counter()
        try:
            out = scorer.raw(texts)
            took = time.perf_counter() - t0
            return [(None if pd.isna(x) else x, took, False) for x in out]
        except Exception as e:
            if len(texts) > 1:
                return [r for i in range(len(texts)) for r in _call(scorer, texts.iloc[i:i + 1], max_retries, backoff)]
            if attempt + 1 < max_retries:
                time.sleep(backoff)
            failed = _error(e), time.perf_counter() - t0, True
    return [failed]


def _calls(texts: pd.Series, rows: int, chars: int) -> list[pd.Series]:
    """Slices of at most ``rows`` texts and about ``chars`` characters (a longer text alone)."""
    out, start, size = [], 0, 0
    for i, t in enumerate(texts):
        n = len(t) if isinstance(t, str) else 0
        if i > start and (i - start >= rows or size + n > chars):
            out.append(texts.iloc[start:i])
            start, size = i, 0
        size += n
    return [*out, texts.iloc[start:]] if len(texts) else out


def raw_scores(df: DataFrame, scorers: dict[str, Scorer], text_col: str,
               max_retries: int = 3, backoff: float = 1.0, partitions: int | None = None,
               concurrency: int = 1, call_rows: int | None = None, call_chars: int = 1 << 20,
               failures: bool = False) -> DataFrame:
    """Adds ``<name>_raw`` (string) and ``<name>_latency`` (double, seconds of the row's call) for every scorer, and
    with ``failures`` ``<name>_failed`` (boolean: the answer is an error record).

    Only ``text_col`` goes to Python and only answers and latencies come back; the other columns
    stay in the JVM. ``partitions`` sets the number of scoring tasks, ``concurrency`` the parallel calls
    inside each (order kept), ``call_rows`` (default: what the scorer states) and ``call_chars`` the size of a call.
    """
    src = df.repartition(partitions) if partitions else df
    names = list(scorers)
    schema = ", ".join(f"`{n}_raw` string, `{n}_latency` double" + (f", `{n}_failed` boolean" if failures else "") for n in names)

    @F.pandas_udf(schema)
    def run(texts: pd.Series) -> pd.DataFrame:
        out = {}
        for name in names:
            parts = _calls(texts, call_rows or scorers[name].call_rows, call_chars)
            call = lambda t, sc=scorers[name]: _call(sc, t, max_retries, backoff)
            if concurrency > 1 and len(parts) > 1:
                from concurrent.futures import ThreadPoolExecutor
                with ThreadPoolExecutor(max_workers=concurrency) as pool:
                    got = list(pool.map(call, parts))
            else:
                got = map(call, parts)
            rows = [r for part in got for r in part]
            out[f"{name}_raw"] = pd.Series([r[0] for r in rows], dtype=object)
            out[f"{name}_latency"] = pd.Series([r[1] for r in rows], dtype=float)
            if failures:
                out[f"{name}_failed"] = pd.Series([r[2] for r in rows], dtype=bool)
        return pd.DataFrame(out)

    scored = src.withColumn("__scores", run.asNondeterministic()(F.col(text_col)))
    return scored.select(*src.columns, "__scores.*")


def score_articles(df: DataFrame, scorer: Scorer, text_col: str = "prompt", out: str = "ai_labels",
                   compat: bool = False, **kw) -> DataFrame:
    """UDF-02/03: label every row; ``out`` = {reasoning, primary_entities, bias,
    error}; failures give error records (bias null, or -1 with ``compat``)."""
    r = raw_scores(df, {"m": scorer}, text_col, **kw)
    return (with_parsed_output(r, "m_raw", out, compat=compat)
            .withColumnRenamed("m_latency", "latency").drop("m_raw"))


def score_models(df: DataFrame, scorers: dict[str, Scorer], text_col: str = "prompt", **kw) -> DataFrame:
    """UDF-04: ``<m>_prediction`` (think-aware parse, null on failure) and
    ``<m>_latency`` per model."""
    r = raw_scores(df, scorers, text_col, **kw)
    for m in scorers:
        r = with_parsed_output(r, f"{m}_raw", f"{m}_prediction", thoughts=True).drop(f"{m}_raw")
    return r


def label_incremental(df: DataFrame, done: DataFrame, scorer: Scorer, key: str = "title",
                      text_col: str = "prompt", out: str = "ai_labels", **kw) -> DataFrame:
    """UDF-05: score only the rows whose key has no label yet (null-safe
    anti-join first, so finished work is never re-scored)."""
    from presslens.operators.setops import new_items
    return score_articles(new_items(df, done, key), scorer, text_col, out, **kw)


# a task's answers become visible when the task ends, not when the job does: a job that fails later loses none
_BY_TASK = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
_ANSWERS = "prompt_id string, raw string, latency double"


def prompt_id(text: ColumnOrName) -> Column:
    """The key of a prompt: SHA-256 of the text (null and empty ones differ)."""
    c = _c(text)
    return F.sha2(F.concat(F.when(c.isNull(), F.lit("0")).otherwise(F.lit("1")), F.coalesce(c, F.lit(""))), 256)


def answers(spark: SparkSession, ledger: str, model: str) -> DataFrame:
    """(prompt_id, raw, latency) of the ledger: one row a prompt that was answered."""
    from presslens.sources.files import path_exists
    path = f"{ledger}/model={model}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], _ANSWERS)
    return spark.read.schema(_ANSWERS).parquet(path).dropDuplicates(["prompt_id"])


def score_once(df: DataFrame, scorer: Scorer, ledger: str, text_col: str = "prompt", model: str = "model",
               partitions: int | None = None, **kw) -> DataFrame:
    """``df`` with ``<model>_raw`` and ``<model>_latency``; the scorer sees every distinct prompt once, in this run
    and in all others over the same ``ledger`` (a folder of the cluster's shared storage).

    Prompts go by hash: equal ones are one call however many rows have them, and those the ledger holds are none. Each
    task's answers are kept from the moment it ends (an executor lost later, or a job that fails, repeats the calls of
    its running tasks only), so tasks are the unit of what is lost: ``partitions`` sets their number. Prompts whose
    calls failed come out with their error record and are not entered, so a later run tries them again.
    """
    spark, m = df.sparkSession, model
    keyed = df.withColumn("__pid", prompt_id(text_col))
    todo = keyed.select("__pid", F.col(text_col).alias("__text")).dropDuplicates(["__pid"])
    known = answers(spark, ledger, m).select(F.col("prompt_id").alias("__pid"))
    todo = todo.join(known, "__pid", "left_anti")
    if partitions:
        todo = todo.repartition(partitions, "__pid")
    got = raw_scores(todo, {m: scorer}, "__text", failures=True, **kw)
    got = got.select(F.col("__pid").alias("prompt_id"), F.col(f"{m}_raw").alias("raw"), F.col(f"{m}_latency").alias("latency"),
                     F.col(f"{m}_failed").alias("failed"))
    # the failed ones of this run are kept beside the answers, for this run alone
    run = uuid.uuid4().hex
    got = got.withColumn("model", F.when(F.col("failed"), F.lit(f"{m}.failed-{run}")).otherwise(F.lit(m))).drop("failed")
    got.write.mode("append").options(**_BY_TASK).partitionBy("model").parquet(ledger)
    all_answers = answers(spark, ledger, m).union(answers(spark, ledger, f"{m}.failed-{run}"))
    all_answers = all_answers.select(F.col("prompt_id").alias("__pid"), F.col("raw").alias(f"{m}_raw"), F.col("latency").alias(f"{m}_latency"))
    return keyed.join(all_answers, "__pid", "left").drop("__pid")
