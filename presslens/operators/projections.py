"""Projections (PRJ-01..10): sink document, flatten labels, feed cards,
localised picks, synthetic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens import specs
from presslens.functions.bands import default_score_analyzer, default_score_feed, lean_feed, pct
from presslens.functions.text import _c, ColumnOrName, doc_key


def sink_document(df: DataFrame, label: str = "label") -> DataFrame:
    """PRJ-01: keyed document: _id = md5(url), text -> content, labels nested
    with defaults ('' / [] / null bias + error)."""
    lab = F.col(label)
    return df.select(
        doc_key("url").alias("_id"), "source", "url", "title", "date", F.col("text").alias("content"),
        F.struct(F.coalesce(lab["reasoning"], F.lit("")).alias("reasoning"),
                 F.coalesce(lab["primary_entities"], F.array().cast("array<string>")).alias("primary_entities"),
                 lab["bias"].alias("bias"), lab["error"].alias("error")).alias("ai_labels"))


def flatten_labels(df: DataFrame, label: str = "ai_labels", synthetic: bool | None = None) -> DataFrame:
    """PRJ-02: lift bias / reasoning / entities to columns; tag is_synthetic."""
    out = df.withColumn("bias", F.col(f"{label}.bias")) \
            .withColumn("reasoning", F.col(f"{label}.reasoning")) \
            .withColumn("primary_entities", F.col(f"{label}.primary_entities"))
    if synthetic is not None:
        out = out.withColumn("is_synthetic", F.lit(bool(synthetic)))
    return out


def feed_card(df: DataFrame, d=specs.FEED_DEFAULTS) -> DataFrame:
    """PRJ-04: display card with falsy-aware defaults; lean and 0-100 score use
    the feed default (``bias || 0.5``)."""
    def txt(c, default):
        return F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit(default))
    score = default_score_feed(F.col("ai_labels.bias"))
    return df.select(
        txt("title", d["title"]).alias("title"), txt("source", d["source"]).alias("source"),
        txt("url", d["url"]).alias("url"), F.col("date"),
        F.coalesce(F.col("ai_labels.primary_entities"), F.array().cast("array<string>")).alias("tags"),
        F.coalesce(F.nullif(F.col("ai_labels.reasoning"), F.lit("")), F.lit(d["reasoning"])).alias("reasoning"),
        lean_feed(score).alias("pol_lean"), pct(score).alias("pol_score"))


def analysis_card(df: DataFrame, url: str = "url", text: str = "text", label: str = "label",
                  page_title: str = "page_title", error: str | None = None, keep=()) -> DataFrame:
    """PRJ-05 / STR-07: on-demand result card. Without text: the failure card
    (title 'Scrape Failed', Center, 50, the error as reasoning, no tags).
    Otherwise title = page title, else the label's title, else
    'Analysis of ' + url[:25] + '...'; lean on the analyzer cut-offs and an
    integer score from the bias (missing or -1 -> 0.5); source = url[:25]."""
    from presslens.functions.bands import lean_analyzer, pct_int
    lab = F.col(label)
    s = default_score_analyzer(lab["bias"])
    no_text = F.col(text).isNull() | (F.col(text) == "")
    lab_title = lab["title"] if "title" in df.schema[label].dataType.fieldNames() else F.lit(None).cast("string")
    title = F.coalesce(F.nullif(F.col(page_title), F.lit("")), F.nullif(lab_title, F.lit("")),
                       F.concat(F.lit("Analysis of "), F.substring(url, 1, 25), F.lit("...")))
    err = F.col(error) if error else F.lit(None).cast("string")
    return df.select(
        *keep, F.col(url).alias("url"),
        F.when(no_text, F.lit("Scrape Failed")).otherwise(title).alias("title"),
        F.when(no_text, F.lit("Center")).otherwise(lean_analyzer(s)).alias("lean"),
        F.when(no_text, F.lit(50)).otherwise(pct_int(s)).alias("score"),
        F.when(no_text, err).otherwise(F.coalesce(lab["reasoning"], F.lit("Error generating reasoning.")))
         .alias("reasoning"),
        F.when(no_text, F.array().cast("array<string>"))
         .otherwise(F.coalesce(lab["primary_entities"], F.array().cast("array<string>"))).alias("tags"),
        F.when(no_text, F.lit(None).cast("string")).otherwise(F.substring(url, 1, 25)).alias("source"))


def localized_text(c: ColumnOrName, lang: ColumnOrName) -> Column:
    """PRJ-10: plain string as is; {en, el} object -> chosen language, else el,
    else en, else '' (empty strings fall through)."""
    x = _c(c)
    if isinstance(lang, str) and lang in ("en", "el"):
        chosen = x[lang]
    else:
        chosen = F.when(_c(lang) == "en", x["en"]).when(_c(lang) == "el", x["el"])
    return F.coalesce(F.nullif(chosen, F.lit("")), F.nullif(x["el"], F.lit("")),
                      F.nullif(x["en"], F.lit("")), F.lit(""))


def localized_array(c: ColumnOrName, lang: ColumnOrName) -> Column:
    """PRJ-10 for arrays: an empty array is kept (it is truthy); only a missing
    one falls through to el, en, then []."""
    x = _c(c)
    chosen = F.when(_c(lang) == "en", x["en"]).when(_c(lang) == "el", x["el"]) \
        if not isinstance(lang, str) else x[lang]
    return F.coalesce(chosen, x["el"], x["en"], F.array().cast("array<string>"))


def materialize(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Set column ``name`` to ``expr`` so that it is computed once per row even
    when a later filter tests it.

    Catalyst pushes a filter on a projected alias below the projection by
    inlining the alias, so an expensive expression (text cleaning, date
    parsing) would run in the filter and again in the projection. A filter on
    a generator's output cannot move below the generator, so the value is
    emitted through a one-element ``explode`` instead (same rows, one pass).
    """
    cols = [F.col(c) for c in df.columns if c != name]
    return df.select(*cols, F.explode(F.array(expr)).alias(name)).select(*df.columns, *(
        [] if name in df.columns else [name]))
