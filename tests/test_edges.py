"""NULLs, NaN, infinities, empty frames, constants, unmatched and unseen values."""

import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from framewright.functions.exprs import finite
from framewright.operators import arrays, charts, cleaning, features, grouping, joining, metrics, timeseries as ts_ops
from framewright.operators.inference import batch_predict, class_weights
from helpers import rows

NULLS = [
    (1, "a", 1.0), (2, "a", None), (3, "a", 3.0), (4, None, 5.0), (5, None, None), (6, "empty", None), (7, "empty", None),
]


@pytest.fixture(scope="module")
def nulls(spark):
    return spark.createDataFrame(NULLS, "id int, g string, v double")


def by_id(df, col="v"):
    return {r["id"]: r[col] for r in df.collect()}


def test_impute_nulls(nulls):
    assert by_id(cleaning.impute(nulls, "v", "mean", "g")) == {
        1: 1.0, 2: 2.0, 3: 3.0, 4: 5.0, 5: 5.0, 6: None, 7: None
    }
    assert by_id(cleaning.impute(nulls, "v", "median"))[6] == 3.0
    assert by_id(cleaning.impute(nulls, "v", "mode"))[6] == 1.0
    assert by_id(cleaning.impute(nulls, "v", "constant", value=9.0))[7] == 9.0


def test_impute_fits_on_train_only(nulls):
    filled = cleaning.impute(nulls, "v", "mean", train=nulls.where("id = 1"))
    assert by_id(filled)[6] == 1.0


def test_profile_counts_nulls(nulls):
    r = cleaning.profile(nulls, ["v", "id"]).where("column = 'v'").first()
    assert (r["count"], r["nulls"], r["distinct"], r["min"], r["max"], r["q50"]) == (3, 4, 3, 1.0, 5.0, 3.0)
    r = cleaning.profile(nulls, ["v", "id"], exact=False).where("column = 'v'").first()
    assert (r["count"], r["nulls"], r["distinct"], r["q50"]) == (3, 4, 3, 3.0)
    assert cleaning.profile(nulls.where("id = 2"), ["v"]).first()["distinct"] == 0


def test_nan_becomes_missing(spark):
    d = spark.createDataFrame([(1, math.nan), (2, math.inf), (3, 1.0)], "id int, v double")
    assert by_id(cleaning.nan_to_null(d, "v")) == {1: None, 2: math.inf, 3: 1.0}
    assert by_id(d.withColumn("v", finite("v")))[1] is None


def test_coerce_separates_rejects(spark):
    d = spark.createDataFrame([(1, "5", "x"), (2, "no", "2024-01-01"), (3, None, None)], "id int, a string, b string")
    typed, rejects = cleaning.coerce(d, {"a": "int", "b": "date"})
    assert by_id(typed, "a") == {1: 5, 2: None, 3: None}
    assert sorted((r["id"], r["column"], r["text"], r["wanted"]) for r in rejects.collect()) == [
        (1, "b", "x", "date"), (2, "a", "no", "int")
    ]


def test_fill_leaves_edges_missing(nulls):
    filled = cleaning.interpolate(nulls, "v", "g", "id")
    assert by_id(filled) == {1: 1.0, 2: 2.0, 3: 3.0, 4: 5.0, 5: None, 6: None, 7: None}
    assert by_id(cleaning.bfill(nulls, "v", "g", "id"))[2] == 3.0


def test_zscore_of_a_constant_is_missing(spark):
    d = spark.createDataFrame([(1, 2.0), (2, 2.0)], "id int, v double")
    assert by_id(cleaning.zscore(d, "v"), "z") == {1: None, 2: None}
    assert rows(arrays.histogram(d, "v", 2).select("bin", "n")) == [(0, 2), (1, 0)]
    assert charts.histogram_2d(d, "v", "v", 2, 2).collect()[0]["n"] == 2
    assert charts.corr_heatmap(d, ["v", "id"]).where("a <> b").first()["r"] is None


def test_empty_frames(spark):
    d = spark.createDataFrame([], "id int, g string, v double, ts timestamp_ntz")
    for out in (
        cleaning.profile(d, ["v"]), cleaning.ffill(d, "v", "g", "id"), cleaning.drop_duplicates(d, "g", "id"),
        cleaning.impute(d, "v", "median", "g"), cleaning.outliers_iqr(d, "v", "g"), cleaning.winsorize(d, "v", 0.1, 0.9),
        ts_ops.rank_by(d, "g", "v"), ts_ops.cumulative(d, "g", "id", "v"), ts_ops.ewm_mean(d, "g", "id", "v", 0.5),
        ts_ops.rolling_time(d, "g", "ts", "v", 10), ts_ops.resample(d, "ts", "hour", [F.count("*").alias("n")]),
        arrays.quantiles(d, "v", [0.5], "g"), grouping.sample_stratified(d, "id", "g", 0.5),
        metrics.roc_curve(d, "id", "v"), charts.ecdf(d, "v"), charts.box_stats(d, "v", "g"),
        class_weights(d, "g"), features.bag_of_words(d, "g", "id"), joining.merge_asof(d, d.select("ts", "g"), "ts", "g"),
    ):
        assert out.count() == 0
    assert metrics.auc(d, "id", "v").first()["auc"] is None
    assert arrays.histogram(d, "v", 3).agg(F.sum("n")).first()[0] == 0


def test_one_class_has_no_auc(spark):
    d = spark.createDataFrame([(1, 0.1), (1, 0.9)], "label int, score double")
    assert metrics.auc(d, "label", "score").first()["auc"] is None
    assert {r["tpr"] for r in metrics.roc_curve(d, "label", "score").collect()} == {0.5, 1.0}


def test_report_undefined_ratios(spark):
    d = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, p int")
    report = {r["class"]: r for r in metrics.classification_report(d, "y", "p").collect()}
    assert report[1]["precision"] is None and report[1]["recall"] == 0.0
    assert report[0]["precision"] == pytest.approx(2 / 3) and report[0]["accuracy"] == pytest.approx(2 / 3)


def test_unmatched_joins(spark):
    left = spark.createDataFrame([(1, "l1"), (2, "l2"), (None, "l3")], "k int, a string")
    right = spark.createDataFrame([(2, "r2"), (3, "r3"), (None, "r4")], "k int, b string")
    assert joining.merge(left, right, "k", "outer").count() == 5
    assert rows(joining.merge_semi_anti(left, right, "k", "semi").select("a")) == [("l2",)]
    assert rows(joining.merge_semi_anti(left, right, "k", "anti").select("a")) == [("l1",), ("l3",)]
    assert rows(joining.merge(left, right, "k", "left", salt=3)) == rows(joining.merge(left, right, "k", "left"))
    with pytest.raises(ValueError):
        joining.merge(left, right, "k", "outer", salt=3)


def test_set_operations_treat_nulls_as_equal(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    assert rows(joining.set_ops(a, b, "intersect")) == [(1,), (None,)]
    assert rows(joining.set_ops(a, b, "except")) == [(2,)]
    assert rows(joining.set_ops(a, b, "except_all")) == [(1,), (2,)]
    assert rows(joining.set_ops(a, b, "union")) == [(1,), (2,), (3,), (None,)]


def test_concat_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([(2, 0.5)], "id int, v double")
    assert rows(joining.concat([a, b])) == [(1, "x", None), (2, None, 0.5)]


def test_interval_join_against_brute_force(spark):
    points = [(i, float((i * 37) % 101)) for i in range(120)]
    spans = [(j, float(j * 3 % 90), float(j * 3 % 90 + (80 if j == 5 else j % 4))) for j in range(40)]
    left = spark.createDataFrame(points, "id int, x double")
    right = spark.createDataFrame(spans + [(99, 50.0, 40.0)], "sid int, lo double, hi double")
    want = sorted((i, s) for i, x in points for s, lo, hi in spans if lo <= x <= hi)
    for width in (None, 0.7, 500.0):
        got = joining.merge_where(left, right, "x", "lo", "hi", width=width)
        assert sorted((r["id"], r["sid"]) for r in got.collect()) == want


def test_unseen_categories(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "c string, y double")
    new = spark.createDataFrame([("a", 0.0), ("zzz", 0.0)], "c string, y double")
    hot = features.one_hot("c", "v").fit(train).transform(new).select("c", vector_to_array("v").alias("v"))
    assert {r["c"]: r["v"] for r in hot.collect()} == {"a": [1.0, 0.0], "zzz": [0.0, 0.0]}
    mean = features.target_encode("c", "m", "y").fit(train).transform(new)
    assert {r["c"]: r["m"] for r in mean.collect()} == {"a": 2.0, "zzz": 3.0}
    with pytest.raises(Exception):
        features.ordinal_encode("c", "i").fit(train).transform(new).collect()


def test_scalers_learn_from_train_only(spark):
    train = spark.createDataFrame([(0.0,), (2.0,), (4.0,)], "x double")
    new = spark.createDataFrame([(10.0,)], "x double")
    for step, want in (
        (features.scale_standard("x", "v"), 4.0), (features.scale_minmax("x", "v"), 2.5),
        (features.scale_maxabs("x", "v"), 2.5), (features.scale_robust("x", "v"), 4.0),
    ):
        out = step.fit(train).transform(new)
        assert out.columns == ["x", "v"]
        assert out.select(vector_to_array("v")[0]).first()[0] == pytest.approx(want)


def test_fitted_steps_survive_saving(spark, tmp_path):
    from pyspark.ml import PipelineModel

    train = spark.createDataFrame([(float(i), [float(i), 1.0]) for i in range(9)], "x double, v array<double>")
    model = features.scale_robust("x", "r").fit(train)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert rows(again.transform(train).select(vector_to_array("r")[0].alias("r"))) == rows(
        model.transform(train).select(vector_to_array("r")[0].alias("r"))
    )


def test_bin_quantile(spark):
    d = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 3, 4, 5, 6, 7, 8])], "id int, v double")
    out = by_id(features.bin_quantile("v", "b", 4).fit(d).transform(d), "b")
    assert list(out.values()) == [0, 0, 1, 1, 2, 2, 3, 3]
    same = d.withColumn("v", F.lit(1.0))
    assert set(by_id(features.bin_quantile("v", "b", 4).fit(same).transform(same), "b").values()) == {1.0}


def test_unicode_tokens(spark):
    d = spark.createDataFrame([(1, "Été à l'ÉTÉ!"), (2, ""), (3, "...!"), (4, None)], "id int, text string")
    assert rows(features.bag_of_words(d, "text", "id")) == [(1, 1, "l"), (1, 1, "à"), (1, 2, "été")]


def test_flatten_json(spark):
    from framewright.sources.tables import flatten_json

    d = spark.createDataFrame([(1, '{"a": 5, "b": {"c": "x"}}'), (2, "broken"), (3, None)], "id int, j string")
    out = flatten_json(d, "j", "a int, b struct<c: string>")
    assert by_id(out, "a") == {1: 5, 2: None, 3: None} and out.columns == ["id", "a", "b"]


def test_text_formats_need_a_schema(spark, tmp_path):
    from framewright.sources.tables import read_table, write_table

    d = spark.createDataFrame([(1, 'say "hi", ok', None), (2, "", 0.5)], "id int, s string, v double")
    for fmt in ("csv", "json", "parquet", "orc"):
        path = str(tmp_path / fmt)
        write_table(d, path, fmt, files=2)
        if fmt in ("csv", "json"):
            with pytest.raises(ValueError):
                read_table(spark, path, fmt)
        back = {r["id"]: (r["s"], r["v"]) for r in read_table(spark, path, fmt, d.schema).collect()}
        assert back[1] == ('say "hi", ok', None) and back[2][1] == 0.5
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path), "avro")


def test_hot_partition_is_written_by_many_tasks(spark, tmp_path):
    from framewright.sources.tables import write_table

    d = spark.range(2_000).withColumn("k", F.when(F.col("id") % 10 == 0, "cold").otherwise("hot"))
    write_table(d, str(tmp_path / "t"), keys="k", files=8)
    assert len(list((tmp_path / "t" / "k=hot").glob("*.parquet"))) > 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2_000


def test_groupby_functions(nulls):
    out = grouping.groupby_agg(nulls, "g", {
        "n": ("nunique", "v"), "q": ("quantile", "v", 0.5), "first": ("argmin", "id", "v"), "last": ("argmax", "id", "v"),
        "size": ("size", "v"), "count": ("count", "v"),
    })
    assert {r["g"]: tuple(r)[1:] for r in out.collect()} == {
        "a": (2, 2.0, 1, 3, 3, 2), None: (1, 5.0, 4, 4, 2, 1), "empty": (0, None, None, None, 2, 0)
    }
    only = grouping.groupby_agg(nulls, "g", {"n": ("nunique", "v")})
    assert {r["g"]: r["n"] for r in only.collect()} == {"a": 2, None: 1, "empty": 0}
    whole = grouping.groupby_agg(nulls, None, {"n": ("nunique", "v"), "q": ("quantile", "v", 0.5)}).first()
    assert tuple(whole) == (3, 3.0)


def test_class_weights_balance(spark):
    d = spark.createDataFrame([(0,), (0,), (0,), (1,), (None,)], "y int")
    out = {r["y"]: r["weight"] for r in class_weights(d, "y").collect()}
    assert out == {0: pytest.approx(4 / 6), 1: pytest.approx(2.0), None: None}


def test_batch_predict_scalars_and_arrays(spark):
    d = spark.createDataFrame([(1, 2.0, [1.0, 2.0]), (2, 3.0, [0.0, 1.0])], "id int, x double, v array<double>")

    def load():
        return lambda x, v: x + v.sum(axis=1)

    assert by_id(batch_predict(d, load, ["x", "v"]), "prediction") == {1: 5.0, 2: 4.0}


def test_kde_and_bars(spark):
    d = spark.createDataFrame([("a", 0.0), ("a", 2.0), ("b", 1.0)], "g string, v double")
    at0 = {r["g"]: r["density"] for r in charts.kde_grid(d, "v", [0.0], 1.0, "g").collect()}
    assert at0["b"] == pytest.approx(math.exp(-0.5) / math.sqrt(2 * math.pi))
    bars = {r["g"]: r for r in charts.bar_ci(d, "v", "g").collect()}
    assert bars["a"]["low"] == pytest.approx(1 - 1.96 * math.sqrt(2) / math.sqrt(2)) and bars["b"]["low"] is None


def test_unknown_choices_are_refused(nulls):
    with pytest.raises(ValueError):
        cleaning.impute(nulls, "v", "guess")
    with pytest.raises(ValueError):
        cleaning.clean_text(nulls, "g", [("shout",)])
    with pytest.raises(ValueError):
        joining.set_ops(nulls, nulls, "xor")
    with pytest.raises(ValueError):
        ts_ops.ewm_mean(nulls, "g", "id", "v", 0.0)
    with pytest.raises(ValueError):
        arrays.vec_ops(nulls, "cross", "v", "v")
