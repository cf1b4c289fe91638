"""JOB-09 legacy categorical evaluation (JSN-03, JOIN-10, AGG-07/08/20).

Per article: every key of the ground-truth object is checked in its JSON
order. Scored keys add |score(pred) - score(truth)| (unknown prediction = 5);
the fallacy key adds the mismatch weight. Any failure - unparseable JSON, a
key missing from the prediction, an unknown truth category, an unknown key -
makes the article cost the penalty and not count as valid; a fallacy match
seen before the failing key still counts, as in a loop that stops at the first
exception.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens import specs
from presslens.catalog import register
from presslens.operators.aggregates import verdict
from presslens.plans import sql as S
from presslens.sources.tables import table

FALLACY_KEY = "primary_fallacy"


def _score_map(scores=specs.LEGACY_SCORES) -> Column:
    return F.create_map(*[x for k, m in scores.items() for x in
                          (F.lit(k), F.create_map(*[y for c, v in m.items() for y in (F.lit(c), F.lit(v))]))])


def legacy_errors(df: DataFrame, truth: str, pred: str, scores=specs.LEGACY_SCORES,
                  unknown: int = specs.LEGACY_UNKNOWN_PREDICTION, penalty: int = specs.LEGACY_ERROR_PENALTY,
                  fallacy_weight: int = specs.LEGACY_FALLACY_WEIGHT) -> DataFrame:
    """Adds ``error`` (int), ``valid`` and ``fallacy_match`` (booleans)."""
    # the columns hold what a JSON reader gives for the field: an object's JSON
    # text, or a string's content; a doubly encoded object is therefore a
    # string, not an object, and counts as a failure
    t = F.from_json(F.col(truth), "map<string,string>")
    p = F.from_json(F.col(pred), "map<string,string>")
    sm = _score_map(scores)
    known = F.array(*[F.lit(k) for k in list(scores) + [FALLACY_KEY]])
    d = df.withColumn("__t", t).withColumn("__p", p).withColumn("__k", F.map_keys("__t"))

    def score(k, v):
        return F.try_element_at(F.try_element_at(sm, k), v)

    def key_error(k):
        scored = F.array_contains(F.array(*[F.lit(x) for x in scores]), k)
        return ((~F.array_contains(known, k)) | (~F.map_contains_key(F.col("__p"), k))
                | (scored & score(k, F.col("__t")[k]).isNull()))

    first_err = F.array_min(F.filter(F.transform("__k", lambda k, i: F.when(key_error(k), i + 1)),
                                     lambda x: x.isNotNull()))
    contrib = F.transform("__k", lambda k: F.when(
        k == FALLACY_KEY,
        F.when(F.col("__p")[k].eqNullSafe(F.col("__t")[k]), 0).otherwise(fallacy_weight))
        .otherwise(F.abs(F.coalesce(score(k, F.col("__p")[k]), F.lit(unknown)) - score(k, F.col("__t")[k]))))
    parsed = F.col("__t").isNotNull() & F.col("__p").isNotNull()
    valid = parsed & first_err.isNull()
    f_idx = F.array_position("__k", FALLACY_KEY)
    fmatch = (parsed & (f_idx > 0) & (first_err.isNull() | (first_err > f_idx))
              & F.col("__p")[FALLACY_KEY].eqNullSafe(F.col("__t")[FALLACY_KEY]))
    total = F.aggregate(contrib, F.lit(0), lambda acc, x: acc + x)
    return (d.withColumn("error", F.when(valid, total).otherwise(F.lit(penalty)).cast("int"))
             .withColumn("valid", valid).withColumn("fallacy_match", F.coalesce(fmatch, F.lit(False)))
             .drop("__t", "__p", "__k"))


def legacy_summary(errors: DataFrame) -> DataFrame:
    """AGG-07/08/20: mean error, fallacy accuracy (% of valid), verdict."""
    agg = errors.agg(F.count(F.lit(1)).alias("n_articles"), F.count_if("valid").alias("n_valid"),
                     F.avg("error").alias("mean_error"), F.count_if("fallacy_match").alias("__m"))
    acc = F.coalesce(F.lit(100.0) * F.col("__m") / F.nullif(F.col("n_valid"), F.lit(0)), F.lit(0.0))
    return agg.select("n_articles", "n_valid", F.round("mean_error", 9).alias("mean_error"),
                      F.round(acc, 9).alias("fallacy_accuracy"),
                      verdict("mean_error", specs.LEGACY_VERDICTS, specs.LEGACY_VERDICT_ELSE).alias("verdict"))


# --- binding: categories chosen from doc_id --------------------------------
SENT = ["negative", "neutral", "positive"]
IDEO = ["far-left", "left", "center-left", "center", "center-right", "right", "far-right", "neutral"]
STANCE = ["pro-government", "anti-government", "systemic", "anti-systemic", "neutral"]
FALLACY = ["none", "ad hominem", "strawman", "false dilemma"]


def _pick(values, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _kv(k: str, v: Column) -> Column:
    return F.concat(F.lit(f'"{k}": "'), v, F.lit('"'))


def legacy_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    ts = _pick(SENT, d % 3)
    ti = F.when(d % 23 == 0, F.lit("unknown")).otherwise(_pick(IDEO, (d * 7) % 8))
    te = _pick(STANCE, (d * 3) % 5)
    tf = _pick(FALLACY, d % 4)
    body = [_kv("sentiment", ts), _kv("ideological_leaning", ti), _kv("establishment_stance", te)]
    truth = F.when(d % 5 == 0, F.concat(F.lit("{"), F.concat_ws(", ", _kv(FALLACY_KEY, tf), *body), F.lit("}"))) \
             .otherwise(F.concat(F.lit("{"), F.concat_ws(", ", *body, _kv(FALLACY_KEY, tf)), F.lit("}")))
    ps = F.when(d % 19 == 0, F.lit("mixed")).otherwise(_pick(SENT, (d + 1) % 3))
    pbody = [_kv("sentiment", ps), _kv("ideological_leaning", _pick(IDEO, (d * 5) % 8)),
             _kv("establishment_stance", _pick(STANCE, d % 5))]
    pf = _kv(FALLACY_KEY, _pick(FALLACY, F.floor(d / 2) % 4))
    pred = F.when(d % 13 == 0, F.lit("not json")) \
            .when(d % 17 == 0, F.concat(F.lit("{"), F.concat_ws(", ", *pbody), F.lit("}"))) \
            .otherwise(F.concat(F.lit("{"), F.concat_ws(", ", *pbody, pf), F.lit("}")))
    return table(spark, sf_dir, "documents").select("doc_id", truth.alias("actual_ground_truth"),
                                                     pred.alias("model_prediction"))


def legacy_errors_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = legacy_errors(legacy_records(spark, sf_dir), "actual_ground_truth", "model_prediction")
    return e.select("doc_id", "error", "valid", "fallacy_match")


def legacy_eval_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legacy_summary(legacy_errors(legacy_records(spark, sf_dir), "actual_ground_truth", "model_prediction"))


def _lst(values) -> str:
    return "[" + ", ".join(S.q(v) for v in values) + "]"


def _score_sql(key: str, e: str) -> str:
    m = specs.LEGACY_SCORES[key]
    return "CASE " + " ".join(f"WHEN {e} = {S.q(c)} THEN {v}" for c, v in m.items()) + " END"


_LEG = f"""
WITH c AS (
  SELECT doc_id, {_lst(SENT)}[doc_id % 3 + 1] AS ts,
         CASE WHEN doc_id % 23 = 0 THEN 'unknown' ELSE {_lst(IDEO)}[(doc_id * 7) % 8 + 1] END AS ti,
         {_lst(STANCE)}[(doc_id * 3) % 5 + 1] AS te, {_lst(FALLACY)}[doc_id % 4 + 1] AS tf,
         CASE WHEN doc_id % 19 = 0 THEN 'mixed' ELSE {_lst(SENT)}[(doc_id + 1) % 3 + 1] END AS ps,
         {_lst(IDEO)}[(doc_id * 5) % 8 + 1] AS pi, {_lst(STANCE)}[doc_id % 5 + 1] AS pe,
         {_lst(FALLACY)}[CAST(floor(doc_id / 2) AS BIGINT) % 4 + 1] AS pf,
         doc_id % 13 = 0 AS bad_json, doc_id % 17 = 0 AS no_fallacy, doc_id % 23 = 0 AS bad_truth,
         doc_id % 5 = 0 AS fallacy_first
  FROM documents),
e AS (
  SELECT doc_id,
         NOT (bad_json OR no_fallacy OR bad_truth) AS valid,
         CASE WHEN bad_json OR no_fallacy OR bad_truth THEN 10 ELSE
           abs(coalesce({_score_sql('sentiment', 'ps')}, 5) - {_score_sql('sentiment', 'ts')})
           + abs(coalesce({_score_sql('ideological_leaning', 'pi')}, 5) - {_score_sql('ideological_leaning', 'ti')})
           + abs(coalesce({_score_sql('establishment_stance', 'pe')}, 5) - {_score_sql('establishment_stance', 'te')})
           + CASE WHEN pf = tf THEN 0 ELSE 2 END END AS error,
         (NOT bad_json) AND (NOT no_fallacy) AND (NOT bad_truth OR fallacy_first) AND pf = tf AS fallacy_match
  FROM c)
"""

register("legacy_errors", _LEG + "SELECT doc_id, CAST(error AS INTEGER) AS error, valid, fallacy_match FROM e")(
    legacy_errors_q)

register("legacy_eval", _LEG + f"""
SELECT count(*) AS n_articles, count(*) FILTER (WHERE valid) AS n_valid, round(avg(error), 9) AS mean_error,
       round(coalesce(100.0 * count(*) FILTER (WHERE fallacy_match) / nullif(count(*) FILTER (WHERE valid), 0), 0.0), 9)
         AS fallacy_accuracy,
       CASE {' '.join(f"WHEN avg(error) < {hi} THEN {S.q(n)}" for hi, n in specs.LEGACY_VERDICTS)}
            ELSE {S.q(specs.LEGACY_VERDICT_ELSE)} END AS verdict
FROM e
""")(legacy_eval_q)
