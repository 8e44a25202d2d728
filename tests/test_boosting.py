"""Boosting over cells of bins gives the model that Spark fits to the rows."""

import math

import numpy as np
import pytest
from pyspark.ml import classification as C, regression as R
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from framewright.operators import models


def close(a, b, rows, value="prediction"):
    value = vector_to_array("probability")[1] if value == "probability" else F.col(value)
    found = [[r["p"] for r in m.transform(rows).select("id", value.alias("p")).orderBy("id").collect()] for m in (a, b)]
    return np.allclose(*found, rtol=1e-9, atol=1e-9)


@pytest.fixture(scope="module")
def numbers(spark):
    """More rows than the 10,000 that thresholds are drawn from, hardly a value twice in ``a`` and ``c``."""
    rows = spark.range(0, 25_000, 1, 3).select("id", (F.randn(3) * 10).alias("a"), F.round(F.randn(4) * 3).alias("b"), F.rand(5).alias("c"))
    rows = rows.withColumn("y", F.sin("a") * 10 + F.col("b") * F.col("c") + F.randn(6))
    return rows.withColumn("l", (F.col("y") > F.randn(7) * 4).cast("int")).persist()


@pytest.mark.parametrize("n", [15, 700, 25_000])
def test_regression_is_that_of_the_rows(numbers, n):
    rows, names = numbers.where(F.col("id") < n), ["a", "b", "c"]
    got = models.tree_models(rows, names, "y", "boosted", "regress", trees=6)
    plain = models.fit(rows, names, R.GBTRegressor(labelCol="y", maxDepth=5, maxIter=6, seed=42), "y")
    assert close(got, plain, rows)


def test_draws_with_more_bins_than_asked(numbers):
    """A draw of more than 10,000 rows leaves room for a 33rd bin; all must stay candidates."""
    most = 0
    for seed in range(1, 5):
        got = models.tree_models(numbers, ["a", "b"], "y", "boosted", "regress", trees=2, seed=seed)
        plain = models.fit(numbers, ["a", "b"], R.GBTRegressor(labelCol="y", maxDepth=5, maxIter=2, seed=seed), "y")
        assert close(got, plain, numbers)
        most = max(most, *map(len, got.stages[1].getOrDefault("thresholds")))
    assert most >= 32


def test_classes_are_those_of_the_rows(numbers):
    rows = numbers.withColumn("v", F.array("a", "b"))
    got = models.tree_models(rows, "v", "l", "boosted", "classify", trees=6)
    plain = models.fit(rows, "v", C.GBTClassifier(labelCol="l", maxDepth=5, maxIter=6, seed=42), "l")
    assert close(got, plain, rows, "probability")


def test_learner_gets_cells_not_rows(numbers, monkeypatch):
    seen = []
    fit = R.GBTRegressor._fit
    monkeypatch.setattr(R.GBTRegressor, "_fit", lambda self, df: seen.append(df.count()) or fit(self, df))
    models.tree_models(numbers, ["a", "b"], "y", "boosted", "regress", depth=2, trees=2)
    assert seen[0] <= 32 * 32


def test_missing_numbers_are_refused(spark):
    for x, y in [(None, 1.0), (math.nan, 1.0), (math.inf, 1.0), (1.0, None), (1.0, math.nan)]:
        rows = spark.createDataFrame([(float(i), 2.0 * i) for i in range(9)] + [(x, y)], "x double, y double")
        with pytest.raises(Exception, match="(?i)null|nan|finite"):
            models.tree_models(rows, ["x"], "y", "boosted", "regress", trees=2)


def test_wide_vectors_are_fitted_by_rows(numbers):
    rows = numbers.where("id < 300").withColumn("v", F.array(*[F.col("a") * k for k in range(6)]))
    got = models.tree_models(rows, "v", "y", "boosted", "regress", trees=2)
    assert [type(s).__name__ for s in got.stages] == ["ArrayToVector", "GBTRegressionModel"]
