"""Principal components against Spark's own and a plain decomposition."""

import numpy as np
import pytest
from pyspark.ml.feature import PCA
from pyspark.sql import functions as F

from framewright.operators import features
from framewright.operators.components import PrincipalComponents


def fitted(df, k, column="embedding"):
    return features.pca(column, "p", k).fit(df)


def test_same_subspace_as_sparks(t):
    df = t("embeddings").where("embedding is not null").select("vec_id", "embedding")
    model = fitted(df, 4)
    raw = features.ArrayToVector(inputCol="embedding", outputCol="raw").transform(df)
    theirs = PCA(k=4, inputCol="raw", outputCol="q").fit(raw)
    a, b = model.stages[1].pc.toArray(), theirs.pc.toArray()
    assert np.abs(a @ a.T - b @ b.T).max() < 1e-6
    assert np.allclose(model.stages[1].explainedVariance, theirs.explainedVariance, atol=1e-9)
    assert np.allclose(np.abs(a), np.abs(b), atol=1e-5)


@pytest.mark.parametrize("blocks", [2, 8])
def test_slow_decay_and_restarts(spark, blocks):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 120)) * np.linspace(2, 1, 120) + 100
    df = spark.createDataFrame([(r.tolist(),) for r in x], "embedding array<double>").repartition(5)
    df = df.unionByName(spark.createDataFrame([(None,), ([float("nan")] * 120,)], df.schema))
    raw = features.ArrayToVector(inputCol="embedding", outputCol="raw").transform(df)
    got = PrincipalComponents(inputCol="raw", outputCol="p", k=3, blocks=blocks).fit(raw)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    best = vectors[:, ::-1][:, :3]
    a = got.pc.toArray()
    assert np.abs(a @ a.T - best @ best.T).max() < 1e-6
    assert np.allclose(got.explainedVariance, values[::-1][:3] / values.sum(), rtol=1e-9)


def test_wide_vectors(spark):
    """50,000 columns, three of them with most of the variance; all pairs would be 20 GB."""
    d = 50_000
    noise = lambda c: (F.xxhash64("id", c) % 1000) / 1e5
    x = F.transform(F.sequence(F.lit(0), F.lit(d - 1)), lambda c: F.when(c < 3, (c + 1) * (F.xxhash64(F.col("id") + 7, c) % 1000) / 100.0).otherwise(noise(c)))
    df = spark.range(120).repartition(12).select(x.alias("embedding"))
    model = fitted(df, 3).stages[1]
    a = model.pc.toArray()
    assert a.shape == (d, 3) and np.allclose(a.T @ a, np.eye(3), atol=1e-9)
    assert (np.abs(a[:3]) ** 2).sum() > 2.9


def test_few_columns_constant_and_no_rows(spark, tmp_path):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0],)], "embedding array<double>")
    model = fitted(df, 5)
    assert model.stages[1].pc.toArray().shape == (2, 2) and list(model.stages[1].explainedVariance) == [0, 0]
    with pytest.raises(ValueError):
        fitted(df.where("false"), 1)
    path = str(tmp_path / "model")
    model.write().save(path)
    again = type(model).load(path)
    assert again.transform(df).collect() == model.transform(df).collect()
    empty = spark.createDataFrame([(None,)], df.schema)
    assert model.transform(empty).first()["p"] is None
