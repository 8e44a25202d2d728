"""Models. ``fit_*`` functions return a fitted ``PipelineModel``; the functions at
the end compute predictions or coefficients directly as tables.

Fits over several passes read their input from a cached copy of just the columns they need.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml import classification as C, clustering as K, regression as R
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType

from framewright.functions.exprs import join_on, names
from framewright.operators.arrays import as_doubles
from framewright.operators.boosting import fit_cells
from framewright.operators.features import ArrayToVector
from framewright.operators.isotonic import isotonic  # noqa: F401
from framewright.operators.margin import MarginModel, squared_hinge
from framewright.operators.neighbours import topk_similar

VECTOR = "__features"


def vectors(df: DataFrame, features: str | Sequence[str]) -> Transformer:
    """The step that turns ``features`` into a vector."""
    if isinstance(features, str) and isinstance(df.schema[features].dataType, ArrayType):
        return ArrayToVector(inputCol=features, outputCol=VECTOR)
    return VectorAssembler(inputCols=names(features), outputCol=VECTOR)


def pipeline(df: DataFrame, features: str | Sequence[str], estimator: Estimator) -> Pipeline:
    """Estimator behind the step that turns ``features`` into a vector: an array
    column, a vector column, or a list of numeric columns."""
    return Pipeline(stages=[vectors(df, features), estimator.copy({estimator.getParam("featuresCol"): VECTOR})])


def fit(df: DataFrame, features: str | Sequence[str], estimator: Estimator, label: str | None = None) -> PipelineModel:
    needed = df.select(*names(features), *names(label)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipeline(needed, features, estimator).fit(needed)
    finally:
        needed.unpersist()


def ols(df, features, label: str, l2: float = 0.0, elastic_net: float = 0.0) -> PipelineModel:
    """Linear regression; without penalty one pass over the data (normal equations)."""
    solver = "normal" if elastic_net == 0.0 else "l-bfgs"
    return fit(df, features, R.LinearRegression(labelCol=label, regParam=l2, elasticNetParam=elastic_net, solver=solver), label)


def logistic(df, features, label: str, l2: float = 0.0, iterations: int = 100) -> PipelineModel:
    return fit(df, features, C.LogisticRegression(labelCol=label, regParam=l2, maxIter=iterations), label)


def linear_svm(df, features, label: str, l2: float = 0.0, iterations: int = 100) -> PipelineModel:
    """Linear machine with squared hinge loss for labels 0 and 1, by Newton steps (``margin.squared_hinge``): one job a
    step, of which a few are needed, for up to some thousand features."""
    first = vectors(df, features)
    lenient = first.copy({first.getParam("handleInvalid"): "keep"}) if isinstance(first, VectorAssembler) else first
    rows = lenient.transform(df.select(*names(features), *names(label)))
    weights, intercept = squared_hinge(rows, VECTOR, label, l2, iterations)
    return PipelineModel(stages=[first, MarginModel(VECTOR, weights, intercept)])


def naive_bayes(df, features, label: str, kind: str = "gaussian", smoothing: float = 1.0) -> PipelineModel:
    return fit(df, features, C.NaiveBayes(labelCol=label, modelType=kind, smoothing=smoothing), label)


def tree_models(
    df, features, label: str, kind: str = "forest", task: str = "classify", depth: int = 5, trees: int = 20, seed: int = 42
) -> PipelineModel:
    """``kind``: tree, forest or boosted; ``task``: classify or regress. Boosting over up to four features fits the cells
    of their bins (``boosting.fit_cells``), not rows: the same model, with few passes over the data."""
    common = {"labelCol": label, "maxDepth": depth, "seed": seed}
    makers = {
        ("tree", "classify"): lambda: C.DecisionTreeClassifier(**common),
        ("tree", "regress"): lambda: R.DecisionTreeRegressor(**common),
        ("forest", "classify"): lambda: C.RandomForestClassifier(numTrees=trees, **common),
        ("forest", "regress"): lambda: R.RandomForestRegressor(numTrees=trees, **common),
        ("boosted", "classify"): lambda: C.GBTClassifier(maxIter=trees, **common),
        ("boosted", "regress"): lambda: R.GBTRegressor(maxIter=trees, **common),
    }
    estimator = makers[kind, task]()
    if kind != "boosted":
        return fit(df, features, estimator, label)
    needed = df.select(*names(features), *names(label)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = fit_cells(needed, vectors(df, features), VECTOR, estimator, label, task == "classify")
        return found or pipeline(needed, features, estimator).fit(needed)
    finally:
        needed.unpersist()


def mlp(df, features, label: str, layers: Sequence[int], iterations: int = 100, seed: int = 42) -> PipelineModel:
    """Feed-forward net; ``layers`` runs from the number of inputs to that of classes."""
    net = C.MultilayerPerceptronClassifier(labelCol=label, layers=list(layers), maxIter=iterations, seed=seed)
    return fit(df, features, net, label)


def kmeans(df, features, k: int, kind: str = "kmeans", iterations: int = 20, seed: int = 42) -> PipelineModel:
    """``kind``: kmeans (k-means|| start) or bisecting."""
    make = {"kmeans": K.KMeans, "bisecting": K.BisectingKMeans}[kind]
    return fit(df, features, make(k=k, maxIter=iterations, seed=seed))


def gaussian_mixture(df, features, k: int, iterations: int = 100, seed: int = 42) -> PipelineModel:
    return fit(df, features, K.GaussianMixture(k=k, maxIter=iterations, seed=seed))


def ols_by_group(df: DataFrame, x: str, y: str, by: str | Sequence[str]) -> DataFrame:
    """One simple regression per group, from aggregates: slope, intercept, r2, n."""
    return df.groupBy(*names(by)).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def many_models(df: DataFrame, features: Sequence[str], label: str, by: str | Sequence[str]) -> DataFrame:
    """One linear model with several features per group: by…, n, intercept, coefficients.

    Only the moments of a group, its means and its covariances around them, leave the executors'
    partial aggregation; the normal equations are then solved from one short row per group. No group is
    ever gathered, whatever its size.
    """
    by, cols = names(by), [*features, label]
    rows = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).dropna(subset=cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    moments = rows.groupBy(*by).agg(
        F.count("*").alias("__n"),
        F.array(*[F.avg(c) for c in cols]).alias("__s"),
        F.array(*[F.covar_pop(a, b) for a, b in pairs]).alias("__p"),
    )
    d = len(features)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper = np.triu_indices(d + 1)
        for batch in batches:
            beta, constant = [], []
            for s, p in zip(batch["__s"], batch["__p"]):
                cov = np.zeros((d + 1, d + 1))
                cov[upper] = p
                cov = cov + np.triu(cov, 1).T
                b = np.linalg.lstsq(cov[:d, :d], cov[:d, d], rcond=None)[0]
                mean = np.asarray(s)
                beta.append(b)
                constant.append(mean[d] - b @ mean[:d])
            out = batch.drop(columns=["__s", "__p"]).rename(columns={"__n": "n"})
            yield out.assign(intercept=constant, coefficients=beta)

    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*by).schema)
    return moments.mapInPandas(solve, f"{keys}, n bigint, intercept double, coefficients array<double>")


def centroids(df: DataFrame, features: str, label: str) -> DataFrame:
    """Mean vector per class: (label, vec)."""
    means = (
        df.select(F.col(label).alias("label"), F.posexplode(as_doubles(features)).alias("i", "x"))
        .groupBy("label", "i").agg(F.avg("x").alias("x"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("i", "x")))
    return means.groupBy("label").agg(F.transform(ordered, lambda s: s["x"]).alias("vec"))


def nearest_centroid(
    train: DataFrame, df: DataFrame, features: str, label: str, id_col: str = "vec_id"
) -> DataFrame:
    """Class whose mean vector is nearest; the smallest class on ties, NULL for rows without a vector."""
    base = centroids(train, features, label).select(F.col("label").alias(id_col), F.col("vec").alias(features))
    near = topk_similar(df.select(id_col, features), base, 1, "euclidean", id_col, features)
    found = near.select(F.col("q_id").alias(id_col), F.col("b_id").alias("prediction"), (-F.col("similarity")).alias("distance"))
    return join_on(df.select(id_col), found, id_col)
