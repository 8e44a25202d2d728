"""Evaluation and model selection. Rows are reduced to counts first; curves are
running sums over distinct scores, which split when there are very many."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.ml.evaluation import ClusteringEvaluator, Evaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType

from framewright.functions.exprs import attach, names
from framewright.operators.arrays import equal_width_bin
from framewright.operators.grouping import hash_number
from framewright.operators.ordered import SPLIT_ROWS, scan


def confusion(df: DataFrame, label: str, prediction: str, by: str | Sequence[str] | None = None) -> DataFrame:
    """Confusion matrix in long form."""
    return df.groupBy(*names(by), label, prediction).agg(F.count("*").alias("n"))


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def classification_report(
    df: DataFrame, label: str, prediction: str, by: str | Sequence[str] | None = None
) -> DataFrame:
    """Per class: precision, recall, F1, support, and the accuracy over all classes.

    Undefined ratios are NULL (a class never predicted has no precision).
    """
    by = names(by)
    cells = confusion(df, label, prediction, by)
    hit = F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col(label).alias("class"), hit.alias("tp"), F.col("n").alias("support"), zero.alias("predicted")),
        F.struct(F.col(prediction).alias("class"), zero.alias("tp"), zero.alias("support"), F.col("n").alias("predicted")),
    )
    per_class = (
        cells.select(*by, F.explode(sides).alias("s")).select(*by, "s.*")
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
    )
    overall = cells.groupBy(*by).agg(_share(F.sum(hit), F.sum("n")).alias("accuracy"))
    tp = F.col("tp")
    return attach(per_class, overall, by).select(
        *by, "class",
        _share(tp, F.col("predicted")).alias("precision"),
        _share(tp, F.col("support")).alias("recall"),
        _share(2 * tp, F.col("predicted") + F.col("support")).alias("f1"),
        "support", "accuracy",
    )


def metrics_by_segment(df: DataFrame, label: str, prediction: str, segment: str | Sequence[str]) -> DataFrame:
    """The classification report of each segment."""
    return classification_report(df, label, prediction, segment)


def _per_score(df: DataFrame, label: str, score: str) -> DataFrame:
    known = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    positive = (F.col(label).cast("double") > 0).cast("bigint")
    return known.groupBy(F.col(score).alias("score")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg")
    )


def _cumulated(df: DataFrame, label: str, score: str, split_rows) -> DataFrame:
    """Per distinct score: positives and negatives at or above it, and their totals."""
    return scan(
        _per_score(df, label, score), None, F.col("score").desc(),
        {"tp": ("sum", "pos"), "fp": ("sum", "neg")}, {"p": "pos", "n": "neg"}, split_rows,
    )


def roc_curve(df: DataFrame, label: str, score: str, split_rows: int | None = SPLIT_ROWS) -> DataFrame:
    """(score, tpr, fpr) at every distinct score, taken as the lowest one still positive."""
    c = _cumulated(df, label, score, split_rows)
    return c.select(
        "score", _share(F.col("tp"), F.col("p")).alias("tpr"), _share(F.col("fp"), F.col("n")).alias("fpr")
    )


def pr_curve(df: DataFrame, label: str, score: str, split_rows: int | None = SPLIT_ROWS) -> DataFrame:
    """(score, precision, recall) at every distinct score."""
    c = _cumulated(df, label, score, split_rows)
    return c.select(
        "score",
        _share(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _share(F.col("tp"), F.col("p")).alias("recall"),
    )


def auc(df: DataFrame, label: str, score: str, split_rows: int | None = SPLIT_ROWS) -> DataFrame:
    """Chance that a positive scores above a negative, ties counting one half;
    NULL when one class is missing."""
    c = _cumulated(df, label, score, split_rows)
    # negatives strictly below a score, plus half of those at it
    beaten = (F.col("n") - F.col("fp")) + F.col("neg") / F.lit(2.0)
    return c.agg(
        F.try_divide(
            F.sum(F.col("pos") * beaten), F.max("p").cast("double") * F.max("n").cast("double")
        ).alias("auc")
    )


def calibration(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Mean predicted score and observed rate in equal bins of [0, 1]."""
    place = equal_width_bin(score, F.lit(0.0), F.lit(1.0), bins)
    return df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(place.alias("bin")).agg(
        F.count("*").alias("n"),
        F.avg(score).alias("predicted"),
        F.avg((F.col(label).cast("double") > 0).cast("double")).alias("observed"),
    )


def regression_metrics(
    df: DataFrame, label: str, prediction: str, by: str | Sequence[str] | None = None
) -> DataFrame:
    """RMSE, MAE, R² and the number of rows, in one pass."""
    y, e = F.col(label).cast("double"), F.col(label) - F.col(prediction)
    known = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    return known.groupBy(*names(by)).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (1 - F.try_divide(F.avg(e * e), F.var_pop(y))).alias("r2"),
        F.count("*").alias("n"),
    )


def silhouette(df: DataFrame, features: str, prediction: str, distance: str = "squaredEuclidean") -> DataFrame:
    """Mean silhouette of a clustering, from per-cluster sums (no pairwise distances)."""
    if isinstance(df.schema[features].dataType, ArrayType):
        df = df.withColumn(features, array_to_vector(F.col(features).cast("array<double>")))
    value = ClusteringEvaluator(
        featuresCol=features, predictionCol=prediction, distanceMeasure=distance
    ).evaluate(df)
    return df.sparkSession.createDataFrame([(value,)], "silhouette double")


def with_folds(df: DataFrame, key: str, folds: int, seed: str = "", out: str = "fold") -> DataFrame:
    """Fold number from the key's hash, so folds never depend on partitioning."""
    return df.withColumn(out, F.pmod(hash_number(key, seed), F.lit(folds)).cast("int"))


def cross_validate(
    df: DataFrame, est: Estimator, grid: Sequence[dict], evaluator: Evaluator, key: str,
    folds: int = 3, parallelism: int = 2, seed: str = "",
) -> tuple[DataFrame, CrossValidatorModel]:
    """k-fold search over a grid. Returns one row per grid point (params, mean, std
    of the metric) and the fitted search, refitted on all rows with the best point."""
    folded = with_folds(df, key, folds, seed).persist()
    try:
        search = CrossValidator(
            estimator=est, estimatorParamMaps=list(grid), evaluator=evaluator, numFolds=folds,
            foldCol="fold", parallelism=parallelism,
        ).fit(folded)
    finally:
        folded.unpersist()
    told = [", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda i: i[0].name)) for m in grid]
    rows = [(t, float(a), float(s)) for t, a, s in zip(told, search.avgMetrics, search.stdMetrics)]
    return df.sparkSession.createDataFrame(rows, "params string, mean double, std double"), search
