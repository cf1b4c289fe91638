"""JOB-07 rater agreement: label sets keyed by url-or-title, last write wins,
inner join, MAE and verdict; plus the positional variant (JOIN-02)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens import specs
from presslens.catalog import register
from presslens.functions.jsonparse import label_bias, unwrap_label
from presslens.operators.aggregates import mae, verdict
from presslens.operators.windows import align_by_position, last_write_wins
from presslens.plans import sql as S
from presslens.sources.tables import articles, table


def rater_key(url: str = "url", title: str = "title"):
    """Join key: url, else title (empty strings count as missing)."""
    return F.coalesce(F.nullif(F.col(url), F.lit("")), F.nullif(F.col(title), F.lit("")))


def label_set(df: DataFrame, label: str = "label", order: str = "ord") -> DataFrame:
    """(key, bias) with one row per key: labels given as objects or stringified
    JSON, bias as number or numeric string; rows without a valid bias are
    skipped and the latest valid row per key wins (WIN-02)."""
    parsed = df.select(rater_key().alias("key"), F.col(order).alias("ord"),
                       label_bias(unwrap_label(label)).alias("bias"))
    return last_write_wins(parsed, "key", "ord", valid=F.col("bias").isNotNull()).select("key", "bias")


def align_raters(a: DataFrame, b: DataFrame) -> DataFrame:
    """JOIN-01: inner equi-join of two label sets on the key."""
    return a.withColumnRenamed("bias", "bias_a").join(b.withColumnRenamed("bias", "bias_b"), "key")


def _rater_inputs(spark: SparkSession, sf_dir: str):
    art = articles(spark, sf_dir)
    labels = table(spark, sf_dir, "labels")
    # rater A: labelled articles; even ids carry an object, odd ids a stringified
    # object with the bias as a string
    a = art.join(labels.select("doc_id"), "doc_id", "left_semi").select(
        "url", "title", "ord",
        F.when(F.col("doc_id") % 2 == 0, F.to_json(F.struct(F.col("score").alias("bias"))))
         .otherwise(F.concat(F.lit('"'), F.replace(F.to_json(F.struct(F.col("score").cast("string").alias("bias"))),
                                                   F.lit('"'), F.lit('\\"')), F.lit('"')))
         .alias("label"))
    # rater B: every article, then later rows from the labels table that
    # override it; toxic rows carry a non-numeric bias and are skipped
    b1 = art.select("url", "title", "ord", F.to_json(F.struct(F.col("score_b").alias("bias"))).alias("label"))
    b2 = labels.select(
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"), F.lit(None).cast("string").alias("title"),
        (F.col("doc_id") + F.lit(1_000_000_000)).alias("ord"),
        F.when(F.col("toxic") == 1, F.lit('{"bias": "n/a"}'))
         .otherwise(F.to_json(F.struct((F.col("quality").cast("double") / 2).alias("bias")))).alias("label"))
    return label_set(a), label_set(b1.unionByName(b2))


def rater_mae(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _rater_inputs(spark, sf_dir)
    m = mae(align_raters(a, b), "bias_a", "bias_b")
    return m.select(F.round("mae", 9).alias("mae"), "n_matched", verdict("mae").alias("verdict"))


def mae_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict per source (AGG-20 applied to grouped MAEs)."""
    a, b = _rater_inputs(spark, sf_dir)
    src = articles(spark, sf_dir).select(F.col("url").alias("key"), "source")
    j = align_raters(a, b).join(src, "key")
    g = j.groupBy("source").agg(F.avg(F.abs(F.col("bias_a") - F.col("bias_b"))).alias("mae"),
                                F.count(F.lit(1)).alias("n_matched"))
    return g.select("source", F.round("mae", 9).alias("mae"), "n_matched", verdict("mae").alias("verdict"))


def positional_mae(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-02: the i-th article (by id) against the i-th article in reverse id order."""
    art = articles(spark, sf_dir)
    a = art.select(F.col("doc_id").alias("ord_a"), F.col("score").alias("bias_a"))
    b = art.select((-F.col("doc_id")).alias("ord_b"), F.col("score_b").alias("bias_b"))
    m = mae(align_by_position(a, b, "ord_a", "ord_b"), "bias_a", "bias_b")
    return m.select(F.round("mae", 9).alias("mae"), "n_matched")


def _verdict_sql(e: str) -> str:
    whens = " ".join(f"WHEN {e} < {hi} THEN {S.q(n)}" for hi, n in specs.MAE_VERDICTS)
    return f"CASE {whens} ELSE {S.q(specs.MAE_VERDICT_ELSE)} END"


_PAIRS = f"""
WITH art AS ({S.ARTICLES}),
ra AS (SELECT url AS key, score AS bias_a FROM art WHERE doc_id IN (SELECT doc_id FROM labels)),
b AS (SELECT url AS key, ord, score_b AS bias FROM art
      UNION ALL
      SELECT 'doc/' || CAST(doc_id AS VARCHAR), doc_id + 1000000000,
             CASE WHEN toxic = 1 THEN NULL ELSE CAST(quality AS DOUBLE) / 2 END FROM labels),
rb AS (SELECT key, bias AS bias_b FROM (
         SELECT *, row_number() OVER (PARTITION BY key ORDER BY ord DESC) AS rn FROM b WHERE bias IS NOT NULL)
       WHERE rn = 1),
p AS (SELECT ra.key, bias_a, bias_b FROM ra JOIN rb ON ra.key = rb.key)
"""

register("rater_mae", _PAIRS + f"""
SELECT round(avg(abs(bias_a - bias_b)), 9) AS mae, count(*) AS n_matched,
       {_verdict_sql('avg(abs(bias_a - bias_b))')} AS verdict FROM p
""")(rater_mae)

register("mae_verdict", _PAIRS + f"""
SELECT art.source, round(avg(abs(bias_a - bias_b)), 9) AS mae, count(*) AS n_matched,
       {_verdict_sql('avg(abs(bias_a - bias_b))')} AS verdict
FROM p JOIN art ON p.key = art.url GROUP BY art.source
""")(mae_verdict)

register("positional_mae", f"""
WITH art AS ({S.ARTICLES}),
a AS (SELECT score AS bias_a, row_number() OVER (ORDER BY doc_id) AS pos FROM art),
b AS (SELECT score_b AS bias_b, row_number() OVER (ORDER BY -doc_id) AS pos FROM art)
SELECT round(avg(abs(bias_a - bias_b)), 9) AS mae, count(*) AS n_matched FROM a JOIN b ON a.pos = b.pos
""")(positional_mae)
