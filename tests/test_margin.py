"""The squared-hinge machine against a plain optimiser, and its number of jobs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.operators import margin, models


def objective(w, b, x, y, l2):
    gap = np.maximum(0, 1 - y * (x @ w + b))
    return gap @ gap / len(y) + l2 / 2 * ((w * x.std(axis=0, ddof=1)) @ (w * x.std(axis=0, ddof=1)))


@pytest.fixture(scope="module")
def made(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 4)) * [1, 50, 0.01, 3] + [0, 1000, 5, -2]
    y = np.where(x @ [1, 0.02, 40, 0] - 220 + rng.normal(size=600) > 0, 1.0, -1.0)
    rows = [(*map(float, r), int(t > 0)) for r, t in zip(x, y)]
    return x, y, spark.createDataFrame(rows, "a double, b double, c double, d double, y int").repartition(7)


@pytest.mark.parametrize("l2", [0.0, 0.01, 1.0])
def test_least_objective(made, l2, monkeypatch):
    x, y, df = made
    jobs = []
    plain = margin.partition_sums
    monkeypatch.setattr(margin, "partition_sums", lambda *a, **k: jobs.append(1) or plain(*a, **k))
    model = models.linear_svm(df, ["a", "b", "c", "d"], "y", l2=l2).stages[-1]
    w, b = np.array(model.getOrDefault("coefficients")), model.getOrDefault("intercept")
    assert len(jobs) <= 15
    std, mean = x.std(axis=0, ddof=1), x.mean(axis=0)
    z = (x - mean) / std
    u, c = np.zeros(4), 0.0
    for _ in range(100_000):  # plain gradient descent
        gap = np.maximum(0, 1 - y * (z @ u + c)) * y
        u, c = u - 0.05 * (-2 * gap @ z / len(y) + l2 * u), c - 0.05 * (-2 * gap.sum() / len(y))
    assert objective(w, b, x, y, l2) <= objective(u / std, c - (u / std) @ mean, x, y, l2) * (1 + 1e-6)


def test_missing_rows_constant_features_and_saving(made, spark, tmp_path):
    x, y, df = made
    holes = df.withColumn("k", F.lit(3.0)).unionByName(spark.createDataFrame(
        [(None, 1.0, 1.0, 1.0, 1, 3.0), (1.0, float("nan"), 1.0, 1.0, 0, 3.0), (1.0, 1.0, float("inf"), 1.0, 0, 3.0), (1.0, 1.0, 1.0, 1.0, None, 3.0)],
        "a double, b double, c double, d double, y int, k double"))
    clean = models.linear_svm(df, ["a", "b", "c", "d"], "y", l2=0.01).stages[-1]
    model = models.linear_svm(holes, ["a", "b", "c", "d", "k"], "y", l2=0.01)
    got = model.stages[-1].getOrDefault("coefficients")
    assert np.allclose(got[:4], clean.getOrDefault("coefficients"), rtol=1e-9) and got[4] == 0
    out = model.transform(df.withColumn("k", F.lit(3.0)))
    signs = x @ np.array(got[:4]) + 3 * got[4] + model.stages[-1].getOrDefault("intercept") > 0
    assert out.where("prediction = y").count() == int((signs == (y > 0)).sum())  # as by hand
    assert out.where("(rawPrediction is null) or prediction not in (0, 1)").count() == 0
    path = str(tmp_path / "model")
    model.write().save(path)
    again = type(model).load(path)
    assert again.stages[-1].getOrDefault("coefficients") == got


def test_one_class_odd_labels_and_no_rows(made, spark):
    _, _, df = made
    one = models.linear_svm(df.where("y = 1"), ["a"], "y", l2=0.1)
    assert one.transform(df).where("prediction <> 1").count() == 0
    for odd in (df.where("false"), df.withColumn("y", F.lit(2))):
        with pytest.raises(ValueError):
            models.linear_svm(odd, ["a"], "y")
