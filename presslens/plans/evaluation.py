"""JOB-08 multi-model evaluation (UDF-07, AGG-02..06, PRJ-09) and the
similarity metrics (ARR-01 Jaccard, MTH-10 cosine)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens import specs
from presslens.catalog import register
from presslens.functions.bands import ideology_class
from presslens.functions.metrics import cosine, jaccard
from presslens.functions.text import normalise_entities
from presslens.operators.aggregates import confusion, macro_f1_from_cells
from presslens.plans import sql as S
from presslens.sources.tables import articles, table

MODELS = ["base", "tuned", "tuned_thinking"]  # of the bindings; ``models`` is a parameter


def evaluation_long(records: DataFrame, models=MODELS, truth: str = "ai_labels") -> DataFrame:
    """Unpivot F8 records to one row per (article, model): truth bias/class/entities,
    predicted bias (numeric or numeric string, else null), class, entities,
    and whether the prediction failed (missing, or bias missing/non-numeric)."""
    t = F.col(truth)
    per_model = []
    for m in models:
        p = F.col(f"{m}_prediction")
        per_model.append(F.struct(
            F.lit(m).alias("model"),
            p.isNull().alias("missing"),
            p["bias"].try_cast("double").alias("pred_bias"),
            p["primary_entities"].alias("pred_entities"),
        ))
    base = records.filter(t.isNotNull()).select(
        "doc_id",
        F.coalesce(t["bias"].try_cast("double"), F.lit(0.5)).alias("true_bias"),
        normalise_entities(t["primary_entities"]).alias("true_entities"),
        F.explode(F.array(*per_model)).alias("m"))
    return base.select(
        "doc_id", "m.model", "true_bias", ideology_class("true_bias").alias("y_true"),
        "m.missing", "m.pred_bias", ideology_class("m.pred_bias").alias("y_pred"),
        (F.col("m.missing") | F.col("m.pred_bias").isNull()).alias("failed"),
        F.when(~F.col("m.missing"), jaccard("true_entities", normalise_entities("m.pred_entities")))
         .alias("jaccard"),
    )


def evaluation_cells(longf: DataFrame) -> DataFrame:
    """One pass over the per-(article, model) rows: partial sums per
    (model, y_true, y_pred) cell - at most models x 8 x 8 rows."""
    ok = ~F.col("failed")
    return longf.groupBy("model", "y_true", "y_pred").agg(
        F.count_if(ok).alias("n"), F.count_if(F.col("failed")).alias("n_failed"),
        F.sum(F.when(ok, F.abs(F.col("true_bias") - F.col("pred_bias")))).alias("sae"),
        F.sum("jaccard").alias("sj"), F.count("jaccard").alias("nj"))


def evaluate_models(records: DataFrame, models=MODELS) -> DataFrame:
    """UDF-07: per model scored count, failures, MAE, accuracy, mean Jaccard and
    macro F1 over the 7 fixed classes - all derived from one aggregation pass
    (the cell table), so the articles are read once."""
    cells = evaluation_cells(evaluation_long(records, models))
    hit = F.col("y_true") == F.col("y_pred")
    per = cells.groupBy("model").agg(
        F.sum("n").alias("n_scored"), F.sum("n_failed").alias("failed"),
        F.try_divide(F.sum("sae"), F.sum("n")).alias("mae"),
        F.try_divide(F.sum(F.when(hit, F.col("n")).otherwise(0)).cast("double"), F.sum("n")).alias("accuracy"),
        F.try_divide(F.sum("sj"), F.sum("nj")).alias("jaccard"))
    f1 = macro_f1_from_cells(cells.filter(F.col("n") > 0), specs.IDEOLOGY_CLASSES, ["model"])
    return per.join(f1, "model", "left")


def eval_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 records bound to the article view: truth = score with title words as
    entities; three model predictions derived from the second rater, with
    missing predictions and non-numeric biases on fixed id patterns."""
    a = articles(spark, sf_dir)
    words = F.split(F.lower(F.col("title")), " ")

    def pred(bias, ents):
        return F.struct(F.col("title").alias("reasoning"), ents.alias("primary_entities"),
                        bias.alias("bias"))
    return a.select(
        "doc_id",
        F.struct(F.col("title").alias("reasoning"), F.slice(words, 1, 3).alias("primary_entities"),
                 F.col("score").alias("bias")).alias("ai_labels"),
        pred(F.col("score_b").cast("string"), F.slice(words, 2, 3)).alias("base_prediction"),
        pred(F.format_number((F.col("score") + F.col("score_b")) / 2, 3), F.slice(words, 1, 2))
            .alias("tuned_prediction"),
        F.when(F.col("doc_id") % 7 == 0, F.lit(None))
         .otherwise(pred(F.when(F.col("doc_id") % 11 == 0, F.lit("abc")).otherwise(F.col("score").cast("string")),
                         F.slice(words, 1, 3))).alias("tuned_thinking_prediction"),
    )


def model_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = evaluate_models(eval_records(spark, sf_dir))
    return r.select("model", "n_scored", "failed", *[F.round(c, 9).alias(c) for c in
                                                     ["mae", "accuracy", "jaccard", "macro_f1"]])


def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-09: (model, metric, score) long table."""
    w = model_eval(spark, sf_dir)
    return w.unpivot("model", ["mae", "accuracy", "jaccard", "macro_f1"], "metric", "score")


def confusion_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    longf = evaluation_long(eval_records(spark, sf_dir)).filter(~F.col("failed"))
    return confusion(longf, "y_true", "y_pred", specs.IDEOLOGY_CLASSES, by=["model"])


def failed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-06."""
    longf = evaluation_long(eval_records(spark, sf_dir))
    return longf.groupBy("model").agg(F.count_if("failed").alias("failed"),
                                      F.count_if("missing").alias("missing"))


def entity_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles(spark, sf_dir)
    words = F.split(F.lower(F.col("title")), " ")
    return a.select("doc_id", F.round(jaccard(F.slice(words, 1, 3), F.slice(words, 2, 3)), 5).alias("jaccard"))


def cosine_sim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTH-10 on consecutive embedding pairs (equi-join on vec_id + 1)."""
    e = table(spark, sf_dir, "embeddings")
    a = e.select("vec_id", F.col("embedding").alias("ea"), F.col("label").alias("label_a"))
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("eb"), F.col("label").alias("label_b"))
    j = a.join(b, "vec_id")
    return j.select("vec_id", "label_a", "label_b", F.round(cosine("ea", "eb"), 5).alias("cosine"))


def reasoning_similarity(pairs: DataFrame, by: str = "model", truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    """AGG-05: mean cosine between the embeddings of the true and the predicted reasoning, per model, over
    the articles that have both; the others are counted apart."""
    both = cosine(truth, predicted)
    return pairs.groupBy(by).agg(F.avg(both).alias("similarity"), F.count(both).alias("n_scored"),
                                 F.count_if(both.isNull()).alias("n_missing"))


def reasoning_similarity_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in predictions: model k answers with the embedding k rows on; every seventh answer is missing."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    ks = F.array(*[F.lit(k) for k in range(len(MODELS))])
    asked = e.select("vec_id", F.col("embedding").alias("truth"), F.posexplode(ks).alias("k", "on"))
    asked = asked.withColumn("vec_id", F.col("vec_id") + F.col("on"))
    answers = e.filter("vec_id % 7 <> 0").withColumnRenamed("embedding", "predicted")
    models = F.array(*[F.lit(m) for m in MODELS])
    got = asked.join(answers, "vec_id", "left").withColumn("model", models[F.col("k")])
    return reasoning_similarity(got).select("model", F.round("similarity", 6).alias("similarity"), "n_scored", "n_missing")


# ----------------------------------------------------------------------------
def _ideo(e: str) -> str:
    parts = [f"WHEN {e} <= {x} THEN {S.q(l)}" for x, l in zip(specs.IDEOLOGY_EDGES, specs.IDEOLOGY_CLASSES)]
    return f"CASE WHEN {e} IS NULL THEN NULL {' '.join(parts)} ELSE {S.q(specs.IDEOLOGY_CLASSES[-1])} END"


def _jac(a: str, b: str) -> str:
    u = f"list_distinct(list_concat(list_distinct({a}), list_distinct({b})))"
    i = f"list_intersect(list_distinct({a}), list_distinct({b}))"
    return f"CASE WHEN len({u}) = 0 THEN 1.0 ELSE CAST(len({i}) AS DOUBLE) / len({u}) END"


_WORDS = "string_split(lower(title), ' ')"
def _norm(e: str) -> str:
    return f"list_distinct(list_transform({e}, lambda x: {S.strip('lower(x)')}))"

_LONG = f"""
WITH art AS ({S.ARTICLES}),
r AS (SELECT doc_id, score AS true_bias, {_norm(f'{_WORDS}[1:3]')} AS te,
             {_norm(f'{_WORDS}[2:4]')} AS e_base, {_norm(f'{_WORDS}[1:2]')} AS e_nothink,
             {_norm(f'{_WORDS}[1:3]')} AS e_think,
             score_b AS b_base, round((score + score_b) / 2, 3) AS b_nothink,
             CASE WHEN doc_id % 11 = 0 THEN NULL ELSE score END AS b_think,
             doc_id % 7 = 0 AS think_missing FROM art),
l AS (SELECT doc_id, 'base' AS model, true_bias, false AS missing, b_base AS pred_bias, {_jac('te', 'e_base')} AS jaccard FROM r
      UNION ALL SELECT doc_id, 'tuned', true_bias, false, b_nothink, {_jac('te', 'e_nothink')} FROM r
      UNION ALL SELECT doc_id, 'tuned_thinking', true_bias, think_missing,
                       CASE WHEN think_missing THEN NULL ELSE b_think END,
                       CASE WHEN think_missing THEN NULL ELSE {_jac('te', 'e_think')} END FROM r),
ll AS (SELECT *, missing OR pred_bias IS NULL AS failed, {_ideo('true_bias')} AS y_true, {_ideo('pred_bias')} AS y_pred FROM l)
"""

_CLASSES = " UNION ALL ".join(f"SELECT {S.q(c)} AS cls" for c in specs.IDEOLOGY_CLASSES)

_EVAL = _LONG + f""",
ok AS (SELECT * FROM ll WHERE NOT failed),
pc AS (SELECT model, cls, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM (
         SELECT model, y_true AS cls, CASE WHEN y_true = y_pred THEN 1 ELSE 0 END AS tp, 0 AS fp,
                CASE WHEN y_true <> y_pred THEN 1 ELSE 0 END AS fn FROM ok
         UNION ALL
         SELECT model, y_pred, 0, CASE WHEN y_true <> y_pred THEN 1 ELSE 0 END, 0 FROM ok) GROUP BY 1, 2),
grid AS (SELECT m.model, c.cls FROM (SELECT DISTINCT model FROM ok) m, ({_CLASSES}) c),
f1 AS (SELECT g.model, avg(coalesce(2.0 * coalesce(tp, 0) / nullif(2 * coalesce(tp, 0) + coalesce(fp, 0) + coalesce(fn, 0), 0), 0.0)) AS macro_f1
       FROM grid g LEFT JOIN pc ON g.model = pc.model AND g.cls = pc.cls GROUP BY g.model),
ag AS (SELECT model, count(*) FILTER (WHERE NOT failed) AS n_scored, count(*) FILTER (WHERE failed) AS failed,
              avg(CASE WHEN NOT failed THEN abs(true_bias - pred_bias) END) AS mae,
              avg(CASE WHEN NOT failed THEN CAST(y_true = y_pred AS DOUBLE) END) AS accuracy,
              avg(jaccard) AS jaccard FROM ll GROUP BY model),
w AS (SELECT ag.model, n_scored, failed, round(mae, 9) AS mae, round(accuracy, 9) AS accuracy,
             round(jaccard, 9) AS jaccard, round(f1.macro_f1, 9) AS macro_f1
      FROM ag LEFT JOIN f1 ON ag.model = f1.model)
"""

register("model_eval", _EVAL + "SELECT * FROM w")(model_eval)

register("metrics_long", _EVAL + """
SELECT model, metric, score FROM w UNPIVOT (score FOR metric IN (mae, accuracy, jaccard, macro_f1))
""")(metrics_long)

register("macro_f1", _EVAL + "SELECT model, macro_f1 FROM w")(
    lambda spark, sf: model_eval(spark, sf).select("model", "macro_f1"))

register("accuracy", _EVAL + "SELECT model, accuracy FROM w")(
    lambda spark, sf: model_eval(spark, sf).select("model", "accuracy"))

register("confusion", _LONG + f"""
SELECT m.model, t.cls AS y_true, p.cls AS y_pred,
       CAST((SELECT count(*) FROM ll WHERE NOT failed AND ll.model = m.model AND y_true = t.cls AND y_pred = p.cls) AS BIGINT) AS n
FROM (SELECT DISTINCT model FROM ll) m, ({_CLASSES}) t, ({_CLASSES}) p
""")(confusion_q)

register("failed_counts", _LONG + """
SELECT model, count(*) FILTER (WHERE failed) AS failed, count(*) FILTER (WHERE missing) AS missing FROM ll GROUP BY model
""")(failed_counts)

register("entity_jaccard", f"""
WITH art AS ({S.ARTICLES})
SELECT doc_id, round({_jac(f'{_WORDS}[1:3]', f'{_WORDS}[2:4]')}, 5) AS jaccard FROM art
""")(entity_jaccard)

register("cosine_sim", """
SELECT a.vec_id, a.label AS label_a, b.label AS label_b,
       round(CASE WHEN sqrt(list_sum(list_transform(a.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) = 0
                    OR sqrt(list_sum(list_transform(b.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) = 0 THEN NULL
                  ELSE list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: CAST(p[1] AS DOUBLE) * CAST(p[2] AS DOUBLE)))
                       / (sqrt(list_sum(list_transform(a.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))
                          * sqrt(list_sum(list_transform(b.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))) END, 5) AS cosine
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
""")(cosine_sim)

register("reasoning_similarity", f"""
WITH m AS ({' UNION ALL '.join(f"SELECT {k} AS k, {S.q(m)} AS model" for k, m in enumerate(MODELS))}),
p AS (SELECT m.model, CASE WHEN b.vec_id IS NOT NULL THEN list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) END AS c
      FROM embeddings a CROSS JOIN m LEFT JOIN embeddings b ON b.vec_id = a.vec_id + m.k AND b.vec_id % 7 <> 0)
SELECT model, round(avg(c), 6) AS similarity, count(c) AS n_scored, count(*) FILTER (WHERE c IS NULL) AS n_missing FROM p GROUP BY model
""")(reasoning_similarity_q)
