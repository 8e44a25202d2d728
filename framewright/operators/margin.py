"""Linear machine with squared hinge loss, fitted by Newton steps from sums over partitions."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasRawPredictionCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from framewright.operators.sums import matrix, partition_sums


def numbers(values) -> Column:
    """An array literal that stays one node of the plan, however long it is."""
    return F.split(F.lit(",".join(map(repr, map(float, values)))), ",").cast("array<double>")


def listed(vector: Column) -> Column:
    """A vector's numbers; NULL without one."""
    return F.when(vector.isNotNull(), vector_to_array(vector))


def dot_with(vector: Column, weights) -> Column:
    products = F.zip_with(vector, numbers(weights), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


class MarginModel(Transformer, HasFeaturesCol, HasPredictionCol, HasRawPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``rawPrediction`` (the margin with either sign) and ``prediction`` (1 for a positive margin, else 0) to a vector column."""

    coefficients = Param(Params._dummy(), "coefficients", "a weight for each feature", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "added to every margin", TypeConverters.toFloat)

    def __init__(self, featuresCol: str | None = None, coefficients=None, intercept: float = 0.0):
        super().__init__()
        if featuresCol is not None:
            self._set(featuresCol=featuresCol, coefficients=[float(c) for c in coefficients], intercept=float(intercept))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        vector = listed(F.col(self.getFeaturesCol()))
        raw, margin = self.getRawPredictionCol(), "__margin"
        out = dataset.withColumn(margin, dot_with(vector, self.getOrDefault("coefficients")) + F.lit(self.getOrDefault("intercept")))
        both = array_to_vector(F.array(-F.col(margin), F.col(margin)))
        out = out.withColumn(raw, F.when(F.col(margin).isNotNull(), both))
        return out.withColumn(self.getPredictionCol(), (F.col(margin) > 0).cast("double")).drop(margin)


def newton(at: Callable[[np.ndarray], tuple[float, np.ndarray, np.ndarray]], size: int, steps: int) -> np.ndarray:
    """Least point of a convex, piecewise quadratic function; ``at`` gives value, gradient and Hessian, in one job.

    Full steps, halved as long as the value falls by too little; the end is where a step no longer changes it."""
    w = np.zeros(size)
    value, gradient, hessian = at(w)
    for _ in range(steps):
        step = -np.linalg.lstsq(hessian, gradient, rcond=1e-12)[0]
        slope = float(gradient @ step)
        if slope > -1e-13 * max(value, 1e-12):
            break
        length = 1.0
        new = at(w + step)
        while new[0] > value + 1e-4 * length * slope and length > 1e-4:
            length /= 2
            new = at(w + length * step)
        if new[0] >= value:
            break
        fall, w = value - new[0], w + length * step
        value, gradient, hessian = new
        if fall <= 1e-12 * value:
            break
    return w


def squared_hinge(rows: DataFrame, vector: str, label: str, l2: float, steps: int) -> tuple[np.ndarray, float]:
    """Weights and intercept with the least mean of max(0, 1 - y·margin)² + l2/2·|weights|², for labels 0 and 1 as y = -1 and 1.

    Weights are penalised as those of features of deviation 1, the intercept is not; they are returned for the features as they
    are, 0 for constant ones. A step is one job: every partition sums up value, gradient and Hessian, the driver gets sums
    of (features + 2)² numbers. Rows with a NULL label or a missing or infinite feature are left out; other labels, and no rows at
    all, raise ``ValueError``."""
    x = listed(F.col(vector))
    rows = rows.select(x.alias("x"), (2 * F.col(label).cast("double") - 1).alias("y"), F.col(vector).alias("v"))
    rows = rows.where("x is not null and y is not null")
    rows = rows.where(~F.exists("x", lambda v: F.isnan(v) | (F.abs(v) == float("inf"))))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n, odd = rows.agg(F.count("*"), F.count_if(~F.col("y").isin(-1.0, 1.0))).first()
        if not n or odd:
            raise ValueError("labels must be 0 or 1" if n else "no rows to learn from")
        found = rows.agg(Summarizer.metrics("mean", "std").summary(F.col("v")).alias("s")).first()["s"]
        mean, std = found["mean"].toArray(), found["std"].toArray()
        scale = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)
        d = len(mean)

        def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
            def add(batch: pa.RecordBatch, sums: np.ndarray) -> None:
                y = batch.column("y").to_numpy()
                z = np.ones((len(y), d + 1))
                z[:, :d] = (matrix(batch.column("x"), d) - mean) * scale
                gap = 1 - y * (z @ w)
                active = gap > 0
                z, gap, y = z[active], gap[active], y[active]
                sums[0] += gap @ gap
                sums[1:d + 2] -= 2 * (gap * y) @ z
                sums[d + 2:] += 2 * (z.T @ z).ravel()

            sums = partition_sums(rows.select("x", "y"), 1 + (d + 1) + (d + 1) ** 2, add) / n
            penalty = np.append(np.full(d, l2), 0.0)
            hessian = sums[d + 2:].reshape(d + 1, d + 1) + np.diag(penalty)
            return sums[0] + penalty @ w**2 / 2, sums[1:d + 2] + penalty * w, hessian

        w = newton(at, d + 1, steps)
    finally:
        rows.unpersist()
    weights = w[:d] * scale
    return weights, float(w[d] - weights @ mean)
