"""Properties that hold for any input."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from framewright.operators import arrays, features, grouping
from helpers import rows

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
numbers = st.lists(st.floats(-1e3, 1e3, allow_nan=False).map(lambda x: round(x, 3)), min_size=1, max_size=30)


@few
@given(numbers, st.floats(0, 1))
def test_quantile_matches_definition(spark, values, p):
    d = spark.createDataFrame([(v,) for v in values], "v double")
    got = arrays.quantiles(d, "v", [p]).first()["value"]
    s = sorted(values)
    k = p * (len(s) - 1)
    lo, hi = s[int(k)], s[min(int(k) + 1, len(s) - 1)]
    assert abs(got - (lo + (k - int(k)) * (hi - lo))) < 1e-9


@few
@given(numbers)
def test_pivot_undoes_melt(spark, values):
    d = spark.createDataFrame([(i, v, v * 2) for i, v in enumerate(values)], "id int, a double, b double")
    long = grouping.melt(d, ["id"], ["a", "b"])
    back = grouping.pivot_table(long, "id", "variable", ["a", "b"], F.first("value"))
    assert rows(back) == rows(d)


@few
@given(st.integers(1, 9), st.integers(1, 9), st.text("abc", max_size=3))
def test_split_covers_and_repeats(spark, a, b, seed):
    d = spark.range(200)
    one = grouping.split_by_hash(d, "id", {"x": a, "y": b}, seed)
    two = grouping.split_by_hash(d.repartition(3), "id", {"x": a, "y": b}, seed)
    assert rows(one) == rows(two)
    assert one.where("split is null").count() == 0


@few
@given(numbers)
def test_standard_scaling_can_be_undone(spark, values):
    d = spark.createDataFrame([(v,) for v in [*values, 1.0, 2.0]], "v double")
    model = features.scale_standard("v", "z").fit(d)
    known = d.agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("std")).first()
    back = model.transform(d).select("v", (vector_to_array("z")[0] * F.lit(known["std"]) + F.lit(known["mean"])).alias("w"))
    assert all(abs(r["v"] - r["w"]) < 1e-6 for r in back.collect())


@few
@given(numbers, st.integers(1, 7))
def test_histogram_counts_every_row(spark, values, bins):
    d = spark.createDataFrame([(v,) for v in values], "v double")
    out = arrays.histogram(d, "v", bins)
    assert out.count() == bins and out.agg(F.sum("n")).first()[0] == len(values)


@few
@given(numbers, st.floats(0.01, 1))
def test_stratified_share_is_exact(spark, values, frac):
    d = spark.createDataFrame([(i, i % 3) for i in range(len(values))], "id int, g int")
    want = {g: -(-round(n * frac, 9) // 1) for g, n in ((r["g"], r["n"]) for r in grouping.value_counts(d, "g").collect())}
    got = {r["g"]: r["n"] for r in grouping.value_counts(grouping.sample_stratified(d, "id", "g", frac), "g").collect()}
    assert all(abs(got[g] - want[g]) <= 1 for g in want)
