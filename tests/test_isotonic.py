"""Isotonic regression in chunks against Spark's own fit."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from framewright.operators.isotonic import IsotonicModel, isotonic, pools
from framewright.plans.common import scored
from framewright.registry import Tables


def sparks(df, x, y, increasing=True):
    d = VectorAssembler(inputCols=[x], outputCol="v").transform(df)
    return IsotonicRegression(featuresCol="v", labelCol=y, isotonic=increasing).fit(d)


def close(spark, df, x, y, increasing=True, chunk_rows=1 << 20, new=None):
    new = df if new is None else new
    want = sparks(df, x, y, increasing).transform(VectorAssembler(inputCols=[x], outputCol="v").transform(new)).select(x, "prediction")
    got = isotonic(df, x, y, increasing, chunk_rows).transform(new).select(x, "prediction")
    a, b = (np.array(sorted(map(tuple, d.collect()))) for d in (got, want))
    assert a.shape == b.shape and np.allclose(a, b, atol=1e-9)


@pytest.mark.parametrize("chunk_rows", [40, 1 << 20])
@pytest.mark.parametrize("increasing", [True, False])
def test_noise(spark, increasing, chunk_rows):
    rng = np.random.default_rng(3)
    data = [(float(x), float(x / 40 + rng.normal() * 2)) for x in rng.integers(0, 300, 800)]
    new = spark.createDataFrame([(float(x),) for x in np.arange(-5, 310, 0.7)], "x double")
    close(spark, spark.createDataFrame(data, "x double, y double").repartition(3), "x", "y", increasing, chunk_rows, new)


@pytest.mark.parametrize("shape", ["rises", "falls", "far pull"])
def test_shapes_over_many_chunks(spark, shape):
    y = {"rises": F.col("x"), "falls": -F.col("x"), "far pull": F.when(F.col("x") > 380, -1e4).otherwise(F.col("x"))}[shape]
    d = spark.range(400).select(F.col("id").cast("double").alias("x")).withColumn("y", y)
    close(spark, d, "x", "y", chunk_rows=37)


def test_whole_table(spark):
    d = scored(Tables(spark, "/root/testdata/sf0.1")).select(F.col("n_chars").cast("double").alias("x"), F.col("quality").cast("double").alias("y"))
    close(spark, d, "x", "y", chunk_rows=500)


def test_missing_values_and_saving(spark, tmp_path):
    d = spark.createDataFrame([(1.0, 1.0), (2.0, 0.0), (3.0, 5.0), (None, 9.0), (4.0, None), (9.0, float("nan"))], "x double, y double")
    model = isotonic(d, "x", "y")
    model.write().save(str(tmp_path / "m"))
    got = {r["x"]: r["prediction"] for r in IsotonicModel.load(str(tmp_path / "m")).transform(d).collect()}
    assert got == {1.0: 0.5, 2.0: 0.5, 3.0: 5.0, None: None, 4.0: 5.0, 9.0: 5.0}
    assert pools(d.where("false"), "x", "y").count() == 0
    assert isotonic(d.where("false"), "x", "y").transform(d).where("prediction is null").count() == 6
