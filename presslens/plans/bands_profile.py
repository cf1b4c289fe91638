"""Band/class counts (MTH-01..06, AGG-10, JOIN-12), dataset profile (JOB-11:
AGG-09/12/13) and class balancing (JOB-05)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens import specs
from presslens.catalog import register
from presslens.functions.bands import (band_dimension, class_dimension, cut, ideology_class,
                                       lean_analyzer, lean_dash, lean_feed, pct)
from presslens.functions.metrics import target_score
from presslens.operators.aggregates import counts_by, describe, histogram, kde
from presslens.operators.setops import union_all
from presslens.functions.metrics import hash_key
from presslens.operators.windows import rank_slices, sample_exact, with_position
from presslens.plans import sql as S
from presslens.sources.tables import articles


def band_counts(df: DataFrame, col: str, spec) -> DataFrame:
    """Rows per band in band order, empty bands as 0."""
    spark = df.sparkSession
    banded = df.select(cut(col, spec).alias("band"))
    return counts_by(banded, "band", band_dimension(spark, spec))


def band_counts_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return band_counts(articles(spark, sf_dir), "score", specs.RANGE5_EVEN)


def band_counts_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return band_counts(articles(spark, sf_dir), "score_b", specs.RANGE5_TAIL)


def ideology_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles(spark, sf_dir).select(ideology_class("score").alias("cls"))
    return counts_by(a, "cls", class_dimension(spark))


def lean_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles(spark, sf_dir)
    leans = a.select(F.explode(F.array(
        F.struct(F.lit("feed").alias("spec"), lean_feed("score").alias("lean")),
        F.struct(F.lit("analyzer").alias("spec"), lean_analyzer("score").alias("lean")),
        F.struct(F.lit("dash").alias("spec"), lean_dash(pct("score")).alias("lean")),
    )).alias("l")).select("l.*")
    return leans.groupBy("spec", "lean").agg(F.count(F.lit(1)).alias("n"))


def profile_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles(spark, sf_dir).select(F.length("text").alias("char_count"), F.col("score").alias("bias"))
    return describe(a, ["char_count", "bias"]).select(
        "metric", "count", *[F.round(c, 9).alias(c) for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]])


HIST = [("char_count", 10), ("bias", 20)]


def histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles(spark, sf_dir).select(F.length("text").alias("char_count"), F.col("score").alias("bias"))
    out = None
    for m, n in HIST:
        h = histogram(a, m, n).select(F.lit(m).alias("metric"), F.lit(n).alias("bins"), "bin", "n")
        out = h if out is None else out.unionByName(h)
    return out


KDE_POINTS = 200


def kde_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles(spark, sf_dir).select(F.col("score").alias("bias"))
    return kde(a, "bias", KDE_POINTS).select("g", F.round("x", 6).alias("x"),
                                             F.round("density", 6).alias("density"))


# --- JOB-05 class balancing -------------------------------------------------
# The binding's sizes; the library's defaults (specs) are for a corpus of a few thousand.
LEFT_CAP = 150
NEUTRAL_SLICES = [(0, 119), (120, 159), (160, 199)]
FAR_RIGHT_TRIM = 30
RIGHT_TARGET = (0.66, 0.85)
FAR_RIGHT_TARGET = (0.85, 1.0)


def balance_classes(scored: DataFrame, rewrites: DataFrame | None = None, seed: int = specs.SEED,
                    left_cap: int = specs.LEFT_CAP, neutral_slices=specs.NEUTRAL_SLICES,
                    far_right_trim: int | None = specs.FAR_RIGHT_TRIM, final_spec=specs.RANGE5_TAIL) -> DataFrame:
    """JOB-05 on rows (doc_id, source, title, text, bias[, date]).

    Bands on range5_even; Far-Left, Right, Far-Right kept whole; Left sampled to
    ``left_cap``; Neutral shuffled and sliced into core / right-rewrite queue /
    far-right-rewrite queue. Queued rows become synthetic records (PRJ-08) whose
    text comes from ``rewrites`` (doc_id, title, text) when given - the rewrite
    generator is an external hook - else is carried over; their target score is
    a seeded uniform draw (MTH-08). Far-right synthetic rows are trimmed to
    ``far_right_trim`` (None: all stay). The final set is banded with ``final_spec``.
    """
    spec = specs.RANGE5_EVEN
    labs = spec["labels"]
    b = scored.withColumn("__band", cut("bias", spec))
    keep = b.filter(F.col("__band").isin(labs[0], labs[3], labs[4]))
    left = sample_exact(b.filter(F.col("__band") == labs[1]), left_cap, None, "doc_id", seed)
    neutral = rank_slices(b.filter(F.col("__band") == labs[2]), neutral_slices, "doc_id", seed, "__slice")
    core = neutral.filter(F.col("__slice") == 0).drop("__slice")
    authentic = union_all(keep, left, core).drop("__band").withColumn("is_synthetic", F.lit(False))

    def synth(slice_id: int, lo_hi) -> DataFrame:
        q = neutral.filter(F.col("__slice") == slice_id).drop("__slice", "__band")
        if rewrites is not None:
            q = q.drop("title", "text").join(rewrites.select("doc_id", "title", "text"), "doc_id")
        return q.select(
            "doc_id", F.concat(F.lit("synthetic-"), F.col("source")).alias("source"),
            F.lit("synthetic").alias("url"), "title", "text",
            target_score("doc_id", lo_hi[0], lo_hi[1], seed).alias("bias"),
            F.lit(True).alias("is_synthetic"))

    synth_r = synth(1, RIGHT_TARGET)
    synth_fr = synth(2, FAR_RIGHT_TARGET)
    if far_right_trim is not None:
        synth_fr = sample_exact(synth_fr, far_right_trim, None, "doc_id", seed)
    final = union_all(authentic, synth_r, synth_fr)
    return final.withColumn("bias_range", cut("bias", final_spec))


def balance_classes_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles(spark, sf_dir).select("doc_id", "source", "url", "title", "text", F.col("score").alias("bias"))
    out = balance_classes(a, None, specs.SEED, LEFT_CAP, NEUTRAL_SLICES, FAR_RIGHT_TRIM)
    return out.select("doc_id", "source", "url", "is_synthetic", "bias", "bias_range")


def balance_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain variant: rewrites (here: the text after its first line) for all queued rows, no trim, even bands."""
    a = articles(spark, sf_dir).select("doc_id", "source", "url", "title", "text", F.col("score").alias("bias"))
    rewrites = a.select("doc_id", "title", F.regexp_replace("text", r"^[^\n]*\n?", "").alias("text"))
    out = balance_classes(a, rewrites, specs.SEED, LEFT_CAP, NEUTRAL_SLICES, None, specs.RANGE5_EVEN)
    return out.select("doc_id", "source", "is_synthetic", "bias", "bias_range", F.md5("text").alias("text_md5"))


def balanced_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-07 on the balanced set (final ``sample(frac=1)``): every row's place in the shuffled order."""
    out = balance_classes_q(spark, sf_dir).select("doc_id", "is_synthetic", hash_key("doc_id", specs.SEED).alias("h"))
    return with_position(out.withColumn("o", F.struct("h", "doc_id")), "o").select("doc_id", "is_synthetic", "pos")


def _cut_sql(e: str, spec) -> str:
    ed, lab = spec["edges"], spec["labels"]
    parts = [f"WHEN {e} >= {ed[0]} AND {e} <= {ed[1]} THEN {S.q(lab[0])}"]
    parts += [f"WHEN {e} > {lo} AND {e} <= {hi} THEN {S.q(l)}" for lo, hi, l in zip(ed[1:-1], ed[2:], lab[1:])]
    return f"CASE {' '.join(parts)} END"


def _dim_sql(labels) -> str:
    return " UNION ALL ".join(f"SELECT {i + 1} AS ord, {S.q(l)} AS band" for i, l in enumerate(labels))


def _band_sql(col: str, spec) -> str:
    return f"""
WITH a AS ({S.ARTICLES}), d AS ({_dim_sql(spec['labels'])}),
c AS (SELECT {_cut_sql(col, spec)} AS band, count(*) AS n FROM a GROUP BY 1)
SELECT d.ord, d.band, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM d LEFT JOIN c ON d.band = c.band
"""


def _ideology_sql(e: str) -> str:
    parts = [f"WHEN {e} <= {x} THEN {S.q(l)}" for x, l in zip(specs.IDEOLOGY_EDGES, specs.IDEOLOGY_CLASSES)]
    return f"CASE WHEN {e} IS NULL THEN NULL {' '.join(parts)} ELSE {S.q(specs.IDEOLOGY_CLASSES[-1])} END"


_H = "md5(CAST(doc_id AS VARCHAR) || ':' || '{seed}')".format(seed=specs.SEED)
_H01 = f"(CAST(('0x' || substr({_H}, 1, 8)) AS BIGINT) / 4294967296.0)"


def _describe_sql(metric: str, expr: str) -> str:
    r = lambda e: f"round(CAST({e} AS DOUBLE), 9)"
    return f"""SELECT '{metric}' AS metric, count({expr}) AS count, {r(f'avg({expr})')} AS mean,
  {r(f'stddev_samp({expr})')} AS std, {r(f'min({expr})')} AS min,
  {r(f'quantile_cont({expr}, 0.25)')} AS p25, {r(f'quantile_cont({expr}, 0.5)')} AS p50,
  {r(f'quantile_cont({expr}, 0.75)')} AS p75, {r(f'max({expr})')} AS max FROM a"""


def _hist_sql(metric: str, expr: str, n: int) -> str:
    return f"""SELECT '{metric}' AS metric, {n} AS bins, CAST(b.bin AS INTEGER) AS bin, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM range(1, {n + 1}) b(bin) LEFT JOIN (
  SELECT CAST(least(floor((CAST({expr} AS DOUBLE) - s.lo) / CASE WHEN s.hi = s.lo THEN 1.0 ELSE s.hi - s.lo END * {n}) + 1, {n}) AS INTEGER) AS bin,
         count(*) AS n
  FROM a, (SELECT CAST(min({expr}) AS DOUBLE) AS lo, CAST(max({expr}) AS DOUBLE) AS hi FROM a) s
  WHERE {expr} IS NOT NULL GROUP BY 1) c ON b.bin = c.bin"""


register("band_counts_a", _band_sql("score", specs.RANGE5_EVEN))(band_counts_a)
register("band_counts_b", _band_sql("score_b", specs.RANGE5_TAIL))(band_counts_b)

register("ideology_counts", f"""
WITH a AS ({S.ARTICLES}),
d AS ({" UNION ALL ".join(f"SELECT {i + 1} AS ord, {S.q(l)} AS cls" for i, l in enumerate(specs.IDEOLOGY_CLASSES))}),
c AS (SELECT {_ideology_sql('score')} AS cls, count(*) AS n FROM a GROUP BY 1)
SELECT d.ord, d.cls, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM d LEFT JOIN c ON d.cls = c.cls
""")(ideology_counts)

register("lean_counts", f"""
WITH a AS ({S.ARTICLES}),
l AS (
  SELECT 'feed' AS spec, {S.lean_feed('score')} AS lean FROM a
  UNION ALL SELECT 'analyzer', CASE WHEN score <= {specs.LEAN_ANALYZER[0]} THEN 'Left'
                                    WHEN score >= {specs.LEAN_ANALYZER[1]} THEN 'Right' ELSE 'Center' END FROM a
  UNION ALL SELECT 'dash', CASE WHEN score * 100.0 <= {specs.LEAN_DASH[0]} THEN 'Left'
                                WHEN score * 100.0 <= {specs.LEAN_DASH[1]} THEN 'Center' ELSE 'Right' END FROM a)
SELECT spec, lean, count(*) AS n FROM l GROUP BY 1, 2
""")(lean_counts)

register("profile_describe", f"""
WITH a AS (SELECT length(text) AS char_count, bias FROM (SELECT text, {S.score('doc_id', 37)} AS bias FROM documents))
{_describe_sql('char_count', 'char_count')}
UNION ALL
{_describe_sql('bias', 'bias')}
""")(profile_describe)

register("histogram", f"""
WITH a AS (SELECT length(text) AS char_count, {S.score('doc_id', 37)} AS bias FROM documents)
{_hist_sql('char_count', 'char_count', 10)}
UNION ALL
{_hist_sql('bias', 'bias', 20)}
""")(histograms)

register("kde", f"""
WITH a AS (SELECT {S.score('doc_id', 37)} AS bias FROM documents),
s AS (SELECT min(bias) AS lo, max(bias) AS hi, stddev_samp(bias) * pow(count(bias), -0.2) AS h,
             count(bias) AS n FROM a),
g AS (SELECT CAST(i AS INTEGER) AS g, s.lo + i * ((s.hi - s.lo) / {KDE_POINTS - 1}) AS x, s.h, s.n
      FROM range(0, {KDE_POINTS}) r(i), s)
SELECT g.g, round(g.x, 6) AS x,
       round(sum(exp(-0.5 * pow((g.x - a.bias) / g.h, 2))) / (g.n * g.h * sqrt(2 * pi())), 6) AS density
FROM g, a GROUP BY g.g, g.x, g.h, g.n
""")(kde_q)

_NS = NEUTRAL_SLICES
_BALANCED = f"""
WITH a AS (SELECT doc_id, source, 'doc/' || CAST(doc_id AS VARCHAR) AS url, {S.score('doc_id', 37)} AS bias FROM documents),
b AS (SELECT *, {_cut_sql('bias', specs.RANGE5_EVEN)} AS band, {_H} AS h, {_H01} AS h01 FROM a),
keep AS (SELECT doc_id, source, url, false AS is_synthetic, bias FROM b
         WHERE band IN ({S.q(specs.RANGE5_EVEN['labels'][0])}, {S.q(specs.RANGE5_EVEN['labels'][3])},
                        {S.q(specs.RANGE5_EVEN['labels'][4])})),
lft AS (SELECT doc_id, source, url, false AS is_synthetic, bias FROM (
          SELECT *, row_number() OVER (ORDER BY h, doc_id) AS rn FROM b
          WHERE band = {S.q(specs.RANGE5_EVEN['labels'][1])}) WHERE rn <= {LEFT_CAP}),
neu AS (SELECT *, row_number() OVER (ORDER BY h, doc_id) - 1 AS pos FROM b
        WHERE band = {S.q(specs.RANGE5_EVEN['labels'][2])}),
core AS (SELECT doc_id, source, url, false AS is_synthetic, bias FROM neu
         WHERE pos BETWEEN {_NS[0][0]} AND {_NS[0][1]}),
sr AS (SELECT doc_id, 'synthetic-' || source AS source, 'synthetic' AS url, true AS is_synthetic,
              round({RIGHT_TARGET[0]} + {RIGHT_TARGET[1] - RIGHT_TARGET[0]!r} * h01, 2) AS bias FROM neu
       WHERE pos BETWEEN {_NS[1][0]} AND {_NS[1][1]}),
sfr AS (SELECT doc_id, source, url, is_synthetic, bias FROM (
          SELECT doc_id, 'synthetic-' || source AS source, 'synthetic' AS url, true AS is_synthetic,
                 round({FAR_RIGHT_TARGET[0]} + {FAR_RIGHT_TARGET[1] - FAR_RIGHT_TARGET[0]!r} * h01, 2) AS bias,
                 row_number() OVER (ORDER BY h, doc_id) AS rn
          FROM neu WHERE pos BETWEEN {_NS[2][0]} AND {_NS[2][1]}) WHERE rn <= {FAR_RIGHT_TRIM}),
u AS (SELECT * FROM keep UNION ALL SELECT * FROM lft UNION ALL SELECT * FROM core
      UNION ALL SELECT * FROM sr UNION ALL SELECT * FROM sfr)
"""

register("balance_classes", _BALANCED + f"""
SELECT doc_id, source, url, is_synthetic, bias, {_cut_sql('bias', specs.RANGE5_TAIL)} AS bias_range FROM u
""")(balance_classes_q)

register("balanced_shuffled", _BALANCED + f"""
SELECT doc_id, is_synthetic, row_number() OVER (ORDER BY {_H}, doc_id) - 1 AS pos FROM u
""")(balanced_shuffled)

register("balance_plain", _BALANCED + f""",
p AS (SELECT * FROM keep UNION ALL SELECT * FROM lft UNION ALL SELECT * FROM core UNION ALL SELECT * FROM sr
      UNION ALL SELECT doc_id, 'synthetic-' || source, 'synthetic', true,
                       round({FAR_RIGHT_TARGET[0]} + {FAR_RIGHT_TARGET[1] - FAR_RIGHT_TARGET[0]!r} * h01, 2)
                FROM neu WHERE pos BETWEEN {_NS[2][0]} AND {_NS[2][1]})
SELECT p.doc_id, p.source, is_synthetic, bias, {_cut_sql('bias', specs.RANGE5_EVEN)} AS bias_range,
       md5(CASE WHEN is_synthetic THEN regexp_replace(text, '^[^\n]*\n?', '') ELSE text END) AS text_md5
FROM p JOIN documents d USING (doc_id)
""")(balance_plain)
