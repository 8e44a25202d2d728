"""Encoders with dictionaries as tables, the chi² test, and selection with missing values."""

import json
import math
import os
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import StringIndexer
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from framewright.functions.special import beta_share, chi2_tail, f_tail, gamma_tail
from framewright.operators import categories, features, selection
from helpers import rows

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(
        [("b", 1, 1.0), ("a", 2, 2.0), ("b", 2, 4.0), (None, 10, 9.0), ("é", None, None)], "c string, d int, y double"
    )


def test_one_hot(spark, train):
    model = categories.one_hot(["c", "d"], "v").fit(train)
    new = spark.createDataFrame([("a", 10), ("zz", 1), (None, None), ("é", 2)], "c string, d int")
    got = {(r["c"], r["d"]): list(r["v"].toArray()) for r in model.transform(new).collect()}
    # a, b, é; then 1, 10, 2 as strings
    assert got == {
        ("a", 10): [1, 0, 0, 0, 1, 0], ("zz", 1): [0, 0, 0, 1, 0, 0], (None, None): [0] * 6, ("é", 2): [0, 0, 1, 0, 0, 1],
    }
    assert model.transform(new).columns == ["c", "d", "v"]
    with pytest.raises(Exception, match="was not there"):
        categories.one_hot("c", "v", unseen="error").fit(train).transform(new).collect()


def test_ordinal(spark, train):
    new = spark.createDataFrame([("b",), ("a",), ("x",), (None,)], "c string")
    assert rows(categories.ordinal_encode("c", "i", "keep").fit(train).transform(new)) == rows(
        spark.createDataFrame([("b", 0.0), ("a", 1.0), ("x", 3.0), (None, 3.0)], "c string, i double"))
    assert categories.ordinal_encode("c", "i", "skip").fit(train).transform(new).count() == 2
    with pytest.raises(Exception, match="was not there"):
        categories.ordinal_encode("c", "i").fit(train).transform(new).collect()


def test_target(spark, train):
    new = spark.createDataFrame([("b",), ("x",), (None,)], "c string")
    got = {r["c"]: r["m"] for r in categories.target_encode("c", "m", "y", smoothing=2.0).fit(train).transform(new).collect()}
    assert got == {"b": pytest.approx(0.5 * 2.5 + 0.5 * 4.0), "x": 4.0, None: pytest.approx(9 / 3 + 4 * 2 / 3)}


def test_encoders_in_a_saved_pipeline(spark, train, tmp_path):
    model = Pipeline(stages=[categories.one_hot("c", "v", path=str(tmp_path / "d"))]).fit(train)
    model.stages[0].write().save(str(tmp_path / "m"))
    again = categories.CategoryModel.load(str(tmp_path / "m"))
    assert rows(again.transform(train).select("c", vector_to_array("v").alias("v"))) == rows(model.transform(train).select("c", vector_to_array("v").alias("v")))


def test_numbering_in_chunks(spark, monkeypatch):
    """Categories are numbered the same when they do not fit into one chunk."""
    monkeypatch.setattr("framewright.operators.categories.positions", lambda d, by, order, name: features_positions(d, by, order, name, split_rows=50))
    from framewright.operators.ordered import positions as features_positions

    d = spark.range(500).select(F.format_string("k%04d", F.col("id") * 7 % 500).alias("c"))
    out = categories.ordinal_encode("c", "i").fit(d).transform(d).collect()
    assert all(r["i"] == int(r["c"][1:]) for r in out)


def test_empty_table_and_extra_columns(spark, train):
    none = train.where("false")
    assert categories.one_hot("c", "v").fit(none).transform(none).count() == 0
    assert categories.target_encode("c", "m", "y").fit(none).transform(train).agg(F.sum("m")).first()[0] == 0.0


def test_chi2_against_spark(spark):
    rng = random.Random(4)
    d = spark.createDataFrame([(rng.choice("abcd"), rng.choice("xyz"), rng.choice("pq")) for _ in range(400)], "a string, b string, y string")
    got = {r["column"]: r for r in categories.chi2_independence(d, ["a", "b"], "y").collect()}
    coded = Pipeline(stages=[StringIndexer(inputCols=["a", "b", "y"], outputCols=["i", "j", "z"]), VectorAssembler(inputCols=["i", "j"], outputCol="v")]).fit(d).transform(d)
    for r, c in zip(ChiSquareTest.test(coded, "v", "z", flatten=True).collect(), "ab"):
        assert got[c]["statistic"] == pytest.approx(r["statistic"]) and got[c]["dof"] == r["degreesOfFreedom"]
        assert got[c]["p_value"] == pytest.approx(r["pValue"], rel=1e-9)


def test_a_million_categories_beside_a_small_driver():
    """Fit and transform with far more categories than a driver of this size could list."""
    code = """
import json, sys
from framewright.session import get_session
from framewright.operators import categories
from pyspark.sql import functions as F
s = get_session("local[4]", spark__driver__memory="1g", spark__driver__maxResultSize="4m", spark__sql__shuffle__partitions="8",
    spark__sql__autoBroadcastJoinThreshold="1m", spark__sql__warehouse__dir=sys.argv[1])
s.sparkContext.setLogLevel("ERROR")
d = s.range(1_200_000).select(F.format_string("category %09d", F.col("id") % 1_000_000).alias("c"), F.col("id").cast("double").alias("y"))
hot = categories.one_hot("c", "v").fit(d)
ordinal = categories.ordinal_encode("c", "i").fit(d).transform(d).agg(F.max("i"), F.min("i")).first()
target = categories.target_encode("c", "m", "y").fit(d).transform(d.limit(1000)).count()
vectors = hot.transform(d.where("y < 5")).collect()
chi = categories.chi2_independence(d.withColumn("z", F.col("y") % 3), ["c"], "z").first()
print(json.dumps([list(ordinal), target, sorted(int(r["v"].indices[0]) for r in vectors), vectors[0]["v"].size, chi["dof"]]))
"""
    import tempfile

    folder = tempfile.mkdtemp(prefix="run-")
    out = subprocess.run([sys.executable, "-c", code, folder], cwd=ROOT, capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    assert json.loads(out.stdout.strip().splitlines()[-1]) == [[999999.0, 0.0], 1000, [0, 1, 2, 3, 4], 1_000_000, 1_999_998]


# ---- selection


def with_gaps(spark, seed=1, n=300):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        y = rng.choice("pqr")
        data.append((rng.gauss("pqr".index(y), 1), rng.gauss(0, 2), 1.0, float(i), y, rng.choice("abc") if y != "p" else "a"))
    return spark.createDataFrame(data, "s double, n double, c double, t double, y string, k string")


def test_anova_and_correlation_against_numpy(spark):
    d = with_gaps(spark)
    data = d.toPandas()
    got = {r["feature"]: r for r in selection.univariate_scores(d, ["s", "n", "c"], "y").collect()}
    for c in "sn":
        groups = [g.to_numpy() for _, g in data.groupby("y")[c]]
        between = sum(len(g) * (g.mean() - data[c].mean()) ** 2 for g in groups) / (len(groups) - 1)
        within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (len(data) - len(groups))
        assert got[c]["statistic"] == pytest.approx(between / within) and (got[c]["dof"], got[c]["rest"]) == (2, 297)
    assert got["c"]["statistic"] == 0.0 and got["c"]["p_value"] == 1.0 and got["s"]["p_value"] < 1e-20 < got["n"]["p_value"]
    lines = {r["feature"]: r for r in selection.univariate_scores(d, ["s", "n"], "t", label_type="continuous").collect()}
    for c in "sn":
        r = np.corrcoef(data[c], data["t"])[0, 1]
        assert lines[c]["statistic"] == pytest.approx(r * r / (1 - r * r) * 298) and lines[c]["rest"] == 298


def test_missing_values_are_left_out_by_feature(spark):
    d = with_gaps(spark)
    holes = d.withColumn("s", F.when(F.col("t") % 5 != 0, F.col("s"))).withColumn("n", F.when(F.col("t") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("n")))
    got = {r["feature"]: r for r in selection.univariate_scores(holes, ["s", "n"], "y").collect()}
    for c, rest in (("s", "t % 5 <> 0"), ("n", "t % 7 <> 0")):
        alone = selection.univariate_scores(d.where(rest), [c], "y").first()
        assert (got[c]["statistic"], got[c]["n"]) == (pytest.approx(alone["statistic"]), alone["n"])
    assert features.kept_columns(selection.select_univariate(["n", "s"], "v", "y", 1).fit(holes), ["n", "s"]) == ["s"]
    model = selection.select_variance(["s", "c", "n"], "v").fit(holes)
    assert features.kept_columns(model, ["s", "c", "n"]) == ["s", "n"]
    out = model.transform(holes).select("t", vector_to_array("v").alias("v")).orderBy("t").first()["v"]
    assert math.isnan(out[0]) and math.isnan(out[1])


def test_selection_edges(spark):
    none = spark.createDataFrame([], "a double, y string")
    assert features.kept_columns(selection.select_variance(["a"], "v").fit(none), ["a"]) == []
    assert selection.univariate_scores(none, ["a"], "y").count() == 0
    one = spark.createDataFrame([(1.0, "p"), (2.0, "p"), (None, "q")], "a double, y string")
    r = selection.univariate_scores(one, ["a"], "y").first()
    assert r["statistic"] is None and math.isnan(r["p_value"])
    split = spark.createDataFrame([(1.0, "p"), (1.0, "p"), (2.0, "q"), (2.0, "q")], "a double, y string")
    r = selection.univariate_scores(split, ["a"], "y").first()
    assert r["statistic"] == math.inf and r["p_value"] == 0.0


def test_categorical_selection(spark):
    d = with_gaps(spark).withColumn("j", F.when(F.col("t") % 4 != 0, F.lit("u")).otherwise("w"))
    assert features.kept_columns(selection.select_univariate(["j", "k"], "v", "y", 1, "categorical").fit(d), ["j", "k"]) == ["k"]


def test_vector_input_keeps_sparks_selector(spark):
    d = VectorAssembler(inputCols=["s", "n"], outputCol="v").transform(with_gaps(spark)).withColumn("z", F.ascii("y").cast("double"))
    model = selection.select_univariate("v", "w", "z", 1).fit(d)
    assert features.kept_columns(model, ["s", "n"]) == ["s"]
    assert isinstance(UnivariateFeatureSelector(), UnivariateFeatureSelector)


def test_tails():
    poisson = sum(math.exp(k * math.log(230) - 230 - math.lgamma(k + 1)) for k in range(200))
    assert chi2_tail(3.841458820694124, 1) == pytest.approx(0.05) and chi2_tail(0.0, 3) == 1.0
    assert chi2_tail(2 * 7.5, 2) == pytest.approx(math.exp(-7.5)) and gamma_tail(200.0, 230.0) == pytest.approx(poisson, rel=1e-9)
    assert f_tail(4.9646027437307145, 1, 10) == pytest.approx(0.05) and f_tail(1.0, 7, 7) == pytest.approx(0.5)
    assert beta_share(2, 3, 0.4) == pytest.approx(0.5248) and f_tail(math.inf, 1, 1) == 0.0 and math.isnan(chi2_tail(1.0, 0))
