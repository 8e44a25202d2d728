"""Invariants of fits and searches that SQL cannot repeat."""

import re

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from __spark_entry__ import queries
from framewright.operators import arrays, features, metrics, models, neighbours
from helpers import rows

from conftest import SF


@pytest.fixture(scope="module")
def vectors(t):
    return t("embeddings").persist()


@pytest.fixture(scope="module")
def matrix(vectors):
    pdf = vectors.orderBy("vec_id").toPandas()
    return pdf["vec_id"].to_numpy(), np.asarray(pdf["embedding"].tolist(), float), pdf["label"].to_numpy()


def accuracy(name, spark):
    q = queries()[name](spark, SF).toPandas()
    label = [c for c in q.columns if c not in ("prediction", "n")][0]
    return q.loc[q[label] == q["prediction"], "n"].sum() / q["n"].sum(), q["n"].sum()


@pytest.mark.parametrize("name", ["logistic", "tree_models", "tree_models_single", "mlp"])
def test_classifiers_beat_chance(spark, name):
    share, n = accuracy(name, spark)
    assert n == 500 and share > 0.2


def test_linear_svm_covers_all_rows(spark):
    share, n = accuracy("linear_svm", spark)
    assert n == 399 and share > 0.5


def test_boosted_beats_the_mean(t):
    rows_ = t("lineitem").select("l_quantity", "l_discount", "l_extendedprice")
    model = models.tree_models(rows_, ["l_quantity", "l_discount"], "l_extendedprice", "boosted", "regress", 3, 5)
    r = metrics.regression_metrics(model.transform(rows_), "l_extendedprice", "prediction").first()
    assert r["n"] == 60_000 and r["r2"] >= 0.0


def test_kmeans_rows_sit_at_nearest_centre(vectors):
    model = models.kmeans(vectors, "embedding", 10)
    centres = np.asarray(model.stages[-1].clusterCenters())
    for r in model.transform(vectors).select("embedding", "prediction").collect():
        d = ((centres - np.asarray(r["embedding"], float)) ** 2).sum(axis=1)
        assert d[r["prediction"]] <= d.min() + 1e-9


def test_bisecting_uses_every_cluster(spark):
    out = queries()["kmeans_bisecting"](spark, SF)
    assert out.count() == 500 and out.select("prediction").distinct().count() == 8


def test_mixture_weights_sum_to_one(t):
    model = models.gaussian_mixture(t("events"), ["value"], 2, iterations=5).stages[-1]
    assert sum(model.weights) == pytest.approx(1.0)


def test_isotonic_is_monotone(t):
    d = t("labels").join(t("documents"), "doc_id").select("doc_id", "quality", F.col("n_chars").cast("double").alias("size"))
    out = models.isotonic(d, "size", "quality").transform(d).orderBy("size").select("prediction").collect()
    values = [r[0] for r in out]
    assert all(a <= b + 1e-12 for a, b in zip(values, values[1:]))


def test_pca_is_orthonormal_and_ordered(vectors):
    model = features.pca("embedding", "p", 5).fit(vectors).stages[1]
    components = model.pc.toArray()
    assert np.allclose(components.T @ components, np.eye(5), atol=1e-9)
    shares = list(model.explainedVariance)
    assert shares == sorted(shares, reverse=True) and sum(shares) <= 1


def test_silhouette_in_range(spark):
    value = queries()["silhouette"](spark, SF).first()[0]
    assert -1 <= value <= 1


def test_hash_features_keep_the_sum(t):
    d = t("events").select("event_id", "value")
    out = features.hash_features("value", "v", 16).transform(d)
    gap = F.abs(F.aggregate(vector_to_array("v"), F.lit(0.0), lambda s, x: s + x) - F.col("value"))
    assert out.agg(F.max(gap)).first()[0] < 1e-9


def test_univariate_selection_finds_the_signal(spark):
    d = spark.range(400).select(
        (F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 7).cast("double").alias("noise"),
        ((F.col("id") % 2) * 5 + F.col("id") % 3).cast("double").alias("signal"),
    )
    model = features.select_univariate(["noise", "signal"], "v", "y", 1).fit(d)
    assert features.kept_columns(model, ["noise", "signal"]) == ["signal"]


def test_folds_are_disjoint_and_cover(t):
    d = metrics.with_folds(t("labels"), "doc_id", 3)
    assert d.count() == 399
    assert {r[0] for r in d.select("fold").distinct().collect()} == {0, 1, 2}
    assert d.groupBy("doc_id").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0


def test_cross_validation_scores_every_point(spark):
    out = queries()["cross_validate"](spark, SF).collect()
    assert [r["params"] for r in out] == ["regParam=0.0", "regParam=0.1", "regParam=1.0"]
    assert all(0 <= r["mean"] <= 1 for r in out)


def brute(x, ids, k, metric):
    if metric == "cosine":
        s = x @ x.T / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1))
    elif metric == "dot":
        s = x @ x.T
    else:
        s = -np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(s, -np.inf)
    top = np.argsort(-s, axis=1, kind="stable")[:, :k]
    return {(int(ids[i]), int(ids[j]), r + 1) for i in range(len(ids)) for r, j in enumerate(top[i])}


@pytest.mark.parametrize("metric", neighbours.METRICS)
@pytest.mark.parametrize("block_rows", [4096, 300, 60])
def test_exact_neighbours(vectors, matrix, metric, block_rows):
    ids, x, _ = matrix
    out = neighbours.topk_similar(vectors, vectors.repartition(3), 3, metric, skip_self=True, block_rows=block_rows)
    assert {(r["q_id"], r["b_id"], r["rank"]) for r in out.collect()} == brute(x, ids, 3, metric)


def test_lsh_recall_and_hot_bucket(vectors, matrix):
    ids, x, _ = matrix
    want = {p[:2] for p in brute(x, ids, 3, "cosine")}
    found = {(r["q_id"], r["b_id"]) for r in neighbours.topk_similar_lsh(vectors, vectors, 3, skip_self=True).collect()}
    assert len(found & want) / len(want) > 0.6
    # one cell holds everything: the blocks inside it still find every neighbour
    whole = neighbours.topk_similar_lsh(
        vectors, vectors, 3, skip_self=True, tables=1, projections=1, width=1e6, block_rows=90
    )
    assert {(r["q_id"], r["b_id"]) for r in whole.collect()} == want


def test_zero_vectors_have_no_cosine(spark):
    d = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.1])], "vec_id bigint, embedding array<double>")
    out = neighbours.topk_similar(d, d, 2, skip_self=True)
    assert {(r["q_id"], r["b_id"]) for r in out.collect()} == {(2, 3), (3, 2)}


def test_any_id_and_no_row_lost(spark):
    d = spark.createDataFrame(
        [("a", [1.0, 0.0], "x"), ("b", [0.9, 0.1], "x"), ("c", [0.0, 1.0], "y"), ("d", None, "y"), ("e", [0.0, 0.0], "y")],
        "vec_id string, embedding array<double>, label string",
    )
    near = {(r["q_id"], r["b_id"]) for r in neighbours.topk_similar(d, d, 1, skip_self=True).collect()}
    assert near == {("a", "b"), ("b", "a"), ("c", "b")}
    voted = {r["vec_id"]: r["prediction"] for r in neighbours.knn_classify(d, d, "embedding", "label", 1).collect()}
    assert voted == {"a": "x", "b": "x", "c": "y", "d": None, "e": None}
    closest = {r["vec_id"]: r["prediction"] for r in models.nearest_centroid(d, d, "embedding", "label").collect()}
    assert closest == {"a": "x", "b": "x", "c": "y", "d": None, "e": "y"}


def test_matmul_against_numpy(spark):
    rng = np.random.default_rng(3)
    a = np.where(rng.random((23, 31)) < 0.3, rng.integers(-5, 5, (23, 31)), 0).astype(float)
    b = np.where(rng.random((31, 12)) < 0.3, rng.integers(-5, 5, (31, 12)), 0).astype(float)

    def coo(m):
        i, j = np.nonzero(m)
        return spark.createDataFrame([(int(r), int(c), float(m[r, c])) for r, c in zip(i, j)], "i int, j int, v double")

    for block in (5, 256):
        got = np.zeros((23, 12))
        for r in arrays.matmul_coo(coo(a), coo(b), block).collect():
            got[r["i"], r["j"]] = r["v"]
        assert np.allclose(got, a @ b)


def test_gram_against_numpy(vectors, matrix):
    _, x, _ = matrix
    got = arrays.gram(vectors.repartition(7), "embedding").collect()
    want = x.T @ x
    assert len(got) == 64 * 65 // 2
    assert max(abs(r["v"] - want[r["i"], r["j"]]) for r in got) < 1e-9


def test_many_models_match_spark_ml(t):
    d = t("lineitem").select("l_returnflag", "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    cols = ["l_quantity", "l_discount", "l_tax"]
    for r in models.many_models(d, cols, "l_extendedprice", "l_returnflag").collect():
        part = d.where(F.col("l_returnflag") == r["l_returnflag"])
        fit = models.fit(part, cols, LinearRegression(labelCol="l_extendedprice", solver="normal"), "l_extendedprice").stages[-1]
        assert r["intercept"] == pytest.approx(fit.intercept, rel=1e-7)
        assert r["coefficients"] == pytest.approx(list(fit.coefficients), rel=1e-6)


def test_nearest_centroid_separates_clear_classes(spark):
    d = spark.createDataFrame([(i, [float(i % 2) * 10 + i / 100, 0.0], i % 2) for i in range(20)],
                              "vec_id bigint, embedding array<double>, label int")
    out = models.nearest_centroid(d, d, "embedding", "label").collect()
    assert all(r["prediction"] == r["vec_id"] % 2 for r in out)


def test_rows_only_queries_keep_their_rows(spark):
    from __spark_entry__ import oracle_sql

    optional = re.compile(r"op\d+_|pipeline$")  # of the training-data part, which may be absent
    unchecked = {q for q in set(queries()) - set(oracle_sql()) if not optional.match(q)}
    assert unchecked == {
        "topk_similar_lsh", "topk_similar_ivf", "hash_features", "pca", "logistic", "linear_svm", "tree_models",
        "tree_models_single", "tree_models_boosted", "mlp", "kmeans", "kmeans_bisecting", "gaussian_mixture",
        "isotonic", "silhouette", "cross_validate",
    }
    assert rows(queries()["select_univariate"](spark, SF).select("n")) == [(60_000,)] * 2
