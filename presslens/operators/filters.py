"""Row filters (FLT-01..17). Plain predicates, so Catalyst pushes the ones on
scan columns into the parquet reader."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens import specs
from presslens.functions.bands import cut
from presslens.functions.dates import parse_iso
from presslens.functions.text import url_year


def drop_missing(df: DataFrame, cols=("title", "date", "url")) -> DataFrame:
    """FLT-01: null (not empty) in any of ``cols`` drops the row."""
    return df.dropna(subset=list(cols))


def min_length(df: DataFrame, col: str = "text", n: int = specs.MIN_TEXT_CHARS) -> DataFrame:
    """FLT-02: keep strictly longer than ``n`` characters (null drops)."""
    return df.filter(F.length(col) > n)


def drop_bad_dates(df: DataFrame, col: str = "date") -> DataFrame:
    """FLT-03 + DT-03: parse to a UTC timestamp, drop what does not parse."""
    from presslens.operators.projections import materialize
    t = dict(df.dtypes)[col]
    if t.startswith("timestamp"):
        return df.withColumn(col, F.col(col).cast("timestamp")).filter(F.col(col).isNotNull())
    return materialize(df, col, parse_iso(F.col(col).cast("string"))).filter(F.col(col).isNotNull())


def year_in(df: DataFrame, col: str, years) -> DataFrame:
    """FLT-04."""
    return df.filter(F.year(col).isin(list(years)))


def labelled_only(df: DataFrame, col: str = "ai_labels", truthy: bool = True) -> DataFrame:
    """FLT-05: label present (and, when ``truthy``, not an empty object/string)."""
    c = F.col(col)
    cond = c.isNotNull()
    if truthy:
        dt = dict(df.dtypes)[col]
        if dt == "string":
            cond = cond & (F.trim(c) != "") & (F.trim(c) != "{}")
        elif dt.startswith("struct"):
            fields = df.schema[col].dataType.fieldNames()
            cond = cond & F.coalesce(*[c[f].isNotNull() for f in fields], F.lit(False))
    return df.filter(cond)


def score_between(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """FLT-06."""
    return df.filter(F.col(col).between(lo, hi))


def in_band(df: DataFrame, col: str, spec, label: str) -> DataFrame:
    """FLT-07."""
    return df.filter(cut(col, spec) == label)


def url_matches(df: DataFrame, col: str, patterns) -> DataFrame:
    """FLT-08: any of the regex alternatives."""
    return df.filter(F.col(col).rlike("|".join(f"(?:{p})" for p in patterns)))


def url_excludes(df: DataFrame, col: str = "loc", keywords=specs.URL_EXCLUDE_KEYWORDS) -> DataFrame:
    """FLT-09: drop URLs whose lower-case form contains any keyword."""
    low = F.lower(F.col(col))
    hit = None
    for k in keywords:
        c = low.contains(k)
        hit = c if hit is None else hit | c
    return df.filter(~hit)


def drop_stale_url_year(df: DataFrame, col: str, now: Column) -> DataFrame:
    """FLT-11: rows whose URL's first /YYYY/ is before the current year drop;
    URLs without a year are kept."""
    y = url_year(col)
    return df.filter(y.isNull() | (y >= F.year(now)))


def require_nonempty(df: DataFrame, cols=("title", "text")) -> DataFrame:
    """FLT-13."""
    cond = None
    for c in cols:
        x = F.col(c).isNotNull() & (F.col(c) != "")
        cond = x if cond is None else cond & x
    return df.filter(cond)


def by_source(df: DataFrame, source: str = "All", col: str = "source") -> DataFrame:
    """FLT-14: equality filter with an 'All' pass-through (decided on the driver,
    so 'All' adds no predicate at all)."""
    return df if source == "All" else df.filter(F.col(col) == source)


def quality_flags(df: DataFrame, min_len: int = specs.MIN_TEXT_CHARS) -> DataFrame:
    """FLT-16: title / date / body checks as OK, MISSING or TOO SHORT."""
    def present(c):
        return F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    return df.select(
        "*",
        F.when(present("title"), "OK").otherwise("MISSING").alias("title_check"),
        F.when(present("date"), "OK").otherwise("MISSING").alias("date_check"),
        F.when(~present("text"), "MISSING").when(F.length("text") <= min_len, "TOO SHORT")
         .otherwise("OK").alias("text_check"),
    )


def extracted_only(df: DataFrame, rule: str = "rule", date: str = "date") -> DataFrame:
    """FLT-17: an extractor matched and the date is non-empty."""
    return df.filter(F.col(rule).isNotNull() & F.col(date).isNotNull() & (F.col(date).cast("string") != ""))



def pending_predictions(df: DataFrame, models) -> DataFrame:
    """FLT-15: rows still missing a prediction from any of ``models``. Done-ness
    is an explicit ``<model>_done`` flag: a prediction that came back null is
    done (the key exists), which a null column alone could not express."""
    cond = None
    for m in models:
        c = ~F.coalesce(F.col(f"{m}_done"), F.lit(False))
        cond = c if cond is None else cond | c
    return df.filter(cond)
