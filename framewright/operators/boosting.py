"""Boosted trees over few features, fitted to the cells of their bins instead of to rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

#: Features up to which cells are used: about 32 bins each make about a million cells at most, however many rows there are.
FEW = 4
BINS = 32
CELL_ROWS = 50_000


def bin_of(x: Column, thresholds: Sequence[float]) -> Column:
    """How many of the thresholds lie below ``x``: trees send values equal to a threshold to the left."""
    return reduce(lambda a, b: a + b, [(x > F.lit(t)).cast("double") for t in thresholds], F.lit(0.0))


class Bins(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A vector column as the vector of its elements' bins."""

    thresholds = Param(Params._dummy(), "thresholds", "ascending thresholds of each element", TypeConverters.toListListFloat)

    def __init__(self, inputCol: str | None = None, outputCol: str | None = None, thresholds=None):
        super().__init__()
        if inputCol is not None:
            self._set(inputCol=inputCol, outputCol=outputCol, thresholds=thresholds)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(self.getInputCol())  # evaluated once a row, as long as no condition stands around its uses
        bins = F.array(*[bin_of(x[i], ts) for i, ts in enumerate(self.getOrDefault("thresholds"))])
        return dataset.withColumn(self.getOutputCol(), array_to_vector(bins))


def drawn(rows: DataFrame, fraction: float, seed: int) -> DataFrame:
    """The rows that Spark's tree learners draw for their thresholds: the same ones for the same seed."""
    spark = rows.sparkSession
    first = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    sample = rows._jdf.javaRDD().sample(False, fraction, first)
    return DataFrame(spark._jsparkSession.createDataFrame(sample, rows._jdf.schema()), spark)


def split_points(values: np.ndarray, expected: float, bins: int) -> list[float]:
    """Thresholds between equally full bins, as Spark's tree learners choose them; what is missing from the ``expected``
    number of values counts as zeros."""
    nonzero = values[values != 0.0]
    if not len(nonzero):
        return []
    found, counts = np.unique(nonzero, return_counts=True)
    weights = counts.astype(float)
    if expected - len(nonzero) > np.finfo(float).eps * len(nonzero) * 100:
        at = int(np.searchsorted(found, 0.0))
        found, weights = np.insert(found, at, 0.0), np.insert(weights, at, expected - len(nonzero))
    middles = (found[:-1] + found[1:]) / 2.0
    if len(middles) < bins:
        return middles.tolist()
    stride = target = expected / bins
    out, now = [], weights[0]
    for middle, weight in zip(middles.tolist(), weights[1:].tolist()):
        before, now = now, now + weight
        if abs(before - target) < abs(now - target):
            out.append(middle)
            target += stride
    return out


def plain_numbers(rows: DataFrame, vector: str) -> bool:
    """Whether no element of the vector is marked as a category, which trees split otherwise than a number."""
    kinds = rows.schema[vector].metadata.get("ml_attr", {}).get("attrs", {})
    return not {"nominal", "binary"} & set(kinds)


def fit_cells(needed: DataFrame, first: Transformer, vector: str, estimator: Estimator, label: str, by_label: bool) -> PipelineModel | None:
    """Spark's own boosting over one weighted row for each occupied cell of the features' bins; None where there are more than
    ``FEW`` features, or categories among them.

    Trees see features by their bins only. With squared loss a cell's rows stay together in every tree and residuals are linear
    in the label, so a cell counts as its mean label with its number of rows; with log loss (``by_label``) the rows
    of a cell and a label are alike. Thresholds are those that the learner would take from the rows. So the model is the
    one that Spark fits to the rows, but passes over the rows are a count, the draw for thresholds and one aggregation,
    however many trees there are. ``needed`` should be cached."""
    rows = first.transform(needed).select(F.col(vector).alias("v"), F.col(label).cast("double").alias("y"))
    head = rows.where("v is not null").select("v").first()
    if head is None or not 1 <= len(head["v"]) <= FEW or not plain_numbers(first.transform(needed), vector):
        return None
    d, n = len(head["v"]), needed.count()
    x = vector_to_array("v")
    odd = F.size(x) != d
    for i in range(d):
        odd = odd | F.isnan(x[i]) | (F.abs(x[i]) == float("inf"))
    checked = F.when(F.col("v").isNull() | odd, F.raise_error(F.lit("features must have the same number of finite values in all rows")))
    rows = rows.select(F.coalesce(checked.cast("array<double>"), x).alias("x"), F.coalesce("y", F.lit(math.nan)).alias("y"))

    bins = min(BINS, n)
    asked = max(bins * bins, 10_000)
    fraction = asked / n if asked < n else 1.0
    sample = drawn(rows, fraction, estimator.getSeed()) if fraction < 1.0 else rows
    values = np.array([r["x"] for r in sample.select("x").collect()], dtype=float).reshape(-1, d)  # about 10,000 rows
    thresholds = [split_points(values[:, i], fraction * n, bins) for i in range(d)]

    places = [f"b{i}" for i in range(d)]
    binned = rows.select(*[bin_of(F.col("x")[i], ts).alias(b) for i, (b, ts) in enumerate(zip(places, thresholds))], "y")
    cells = binned.groupBy(*places, *(["y"] if by_label else [])).agg(F.count("*").cast("double").alias("n"), *([] if by_label else [F.avg("y").alias("y")]))
    cells = cells.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        size = cells.count()
        few = cells.coalesce(1 + size // CELL_ROWS).select(
            array_to_vector(F.array(*places)).alias(f"{vector}_bins"), F.col("y").alias(label), "n"
        )
        learner = estimator.copy({
            estimator.featuresCol: f"{vector}_bins", estimator.weightCol: "n",
            # all bins are listed, of which there may be a few more than asked for, and no cell is left out when the learner lists them
            estimator.maxBins: max(BINS, *[len(ts) + 1 for ts in thresholds], math.isqrt(size) + 1),
        })
        return PipelineModel(stages=[first, Bins(vector, f"{vector}_bins", thresholds), learner.fit(few)])
    finally:
        cells.unpersist()
