"""Evaluation and selection."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from framewright.operators import metrics as ops, models
from framewright.plans.common import R, SCORED_SQL, round_all, scored
from framewright.registry import Tables, query


@query("confusion", f"select quality, predicted, count(*) as n from {SCORED_SQL} group by all")
def confusion(t: Tables) -> DataFrame:
    return ops.confusion(scored(t), "quality", "predicted")


def report_sql(by: str = "") -> str:
    """Precision, recall, F1 per class; ``by`` is '' or 'lang, '."""
    return f"""
with s as {SCORED_SQL}, k as (select {by} class, sum(tp) as tp, sum(a) as support, sum(p) as predicted from (
  select {by} quality as class, cast(quality = predicted as integer) as tp, 1 as a, 0 as p from s
  union all select {by} predicted, 0, 0, 1 from s) group by all),
o as (select {by} avg(cast(quality = predicted as double)) as accuracy from s {'group by lang' if by else ''})
select {by} class, round(tp / nullif(cast(predicted as double), 0), 8) as "precision", round(tp / nullif(cast(support as double), 0), 8) as recall,
       round(2 * tp / cast(predicted + support as double), 8) as f1, cast(support as bigint) as support, round(accuracy, 8) as accuracy
from k {'join o using (lang)' if by else 'cross join o'}"""


@query("classification_report", report_sql())
def classification_report(t: Tables) -> DataFrame:
    return round_all(ops.classification_report(scored(t), "quality", "predicted"), 8, "precision", "recall", "f1", "accuracy")


@query("metrics_by_segment", report_sql("lang, "))
def metrics_by_segment(t: Tables) -> DataFrame:
    report = ops.metrics_by_segment(scored(t), "quality", "predicted", "lang")
    return round_all(report, 8, "precision", "recall", "f1", "accuracy")


CURVE_SQL = f"""
with c as (select cast(n_chars as double) as score, sum(quality) as pos, sum(1 - quality) as neg from {SCORED_SQL} group by 1),
r as (select score, sum(pos) over w as tp, sum(neg) over w as fp, sum(pos) over () as p, sum(neg) over () as n, pos, neg
      from c window w as (order by score desc))
"""


def with_score(t: Tables) -> DataFrame:
    return scored(t).withColumn("score", F.col("n_chars").cast("double"))


@query("roc_curve", CURVE_SQL + "select score, round(tp / cast(p as double), 8) as tpr, round(fp / cast(n as double), 8) as fpr from r")
def roc_curve(t: Tables) -> DataFrame:
    return round_all(ops.roc_curve(with_score(t), "quality", "score"), 8, "tpr", "fpr")


@query("pr_curve", CURVE_SQL + """
select score, round(tp / cast(tp + fp as double), 8) as "precision", round(tp / cast(p as double), 8) as recall from r""")
def pr_curve(t: Tables) -> DataFrame:
    return round_all(ops.pr_curve(with_score(t), "quality", "score"), 8, "precision", "recall")


@query("auc", CURVE_SQL + "select round(sum(pos * (n - fp + neg / 2.0)) / max(cast(p as double) * n), 8) as auc from r")
def auc(t: Tables) -> DataFrame:
    return round_all(ops.auc(with_score(t), "quality", "score"), 8, "auc")


@query("calibration", f"""
select least(cast(floor(score * 10) as integer), 9) as bin, count(*) as n, round(avg(score), 8) as predicted,
       round(avg(cast(quality as double)), 8) as observed
from (select n_chars / (n_chars + 1000.0) as score, quality from {SCORED_SQL}) group by 1""")
def calibration(t: Tables) -> DataFrame:
    rows = scored(t).withColumn("score", F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0)))
    return round_all(ops.calibration(rows, "quality", "score"), 8, "predicted", "observed")


@query("regression_metrics", """
select round(sqrt(avg(e * e)), 4) as rmse, round(avg(abs(e)), 4) as mae, round(1 - avg(e * e) / var_pop(y), 6) as r2, count(*) as n
from (select l_extendedprice as y, l_extendedprice - 2000 * l_quantity as e from lineitem)""")
def regression_metrics(t: Tables) -> DataFrame:
    rows = t("lineitem").select("l_extendedprice", (2000 * F.col("l_quantity")).alias("guess"))
    out = ops.regression_metrics(rows, "l_extendedprice", "guess")
    return out.select(R("rmse", 4).alias("rmse"), R("mae", 4).alias("mae"), R("r2", 6).alias("r2"), "n")


@query("silhouette")
def silhouette(t: Tables) -> DataFrame:
    rows = t("embeddings")
    grouped = models.kmeans(rows, "embedding", 10).transform(rows).select("embedding", "prediction")
    return round_all(ops.silhouette(grouped, "embedding", "prediction"), 6, "silhouette")


@query("cross_validate")
def cross_validate(t: Tables) -> DataFrame:
    rows = scored(t).select("doc_id", "quality", F.log1p("n_chars").alias("size"))
    learner = LogisticRegression(labelCol="quality")
    est = models.pipeline(rows, ["size"], learner)
    stage = est.getStages()[-1]
    grid = ParamGridBuilder().addGrid(stage.regParam, [0.0, 0.1, 1.0]).build()
    judge = BinaryClassificationEvaluator(labelCol="quality", metricName="areaUnderROC")
    table, _ = ops.cross_validate(rows, est, grid, judge, "doc_id")
    return round_all(table, 6, "mean", "std")
