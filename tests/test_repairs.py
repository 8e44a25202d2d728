"""Long memories, long frames, values far from zero, infinities, dates, missing values, sequences."""

import math
import random
from datetime import date, datetime

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from framewright.operators import arrays, features, grouping, joining, models, sequences, timeseries as ts
from framewright.operators.inference import batch_predict
from framewright.operators.ordered import quantile_table


def by_id(df, col):
    return {r["id"]: r[col] for r in df.collect()}


@pytest.mark.parametrize("block", [1_000_000, 7])
@pytest.mark.parametrize("alpha", [0.001, 0.9999])
def test_ewm_chains_its_blocks(spark, monkeypatch, block, alpha):
    monkeypatch.setattr(ts, "BLOCK_ROWS", block)
    rng = random.Random(1)
    data = [(i, "a" if i % 3 else "b", rng.random()) for i in range(300)]
    want, last = {}, {}
    for i, k, v in data:
        last[k] = v if k not in last else (1 - alpha) * last[k] + alpha * v
        want[i] = last[k]
    got = by_id(ts.ewm_mean(spark.createDataFrame(data, "id int, k string, v double"), "k", "id", "v", alpha), "ewm")
    assert got == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("stat", ["std", "sum", "count"])
def test_rolling_on_both_sides_of_the_switch(spark, monkeypatch, stat):
    rng = random.Random(2)
    data = [(i, "h" if i % 2 else "g", (1e9 if i % 2 else 0) + rng.random() * 7, None if i % 11 == 0 else i * 3) for i in range(400)]
    d = spark.createDataFrame(data, "id int, k string, v double, s int").withColumn(
        "ts", F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, s)")
    )
    plain = by_id(ts.rolling_time(d, "k", "ts", "v", 600, stat, split_rows=None), "rolling")
    assert by_id(ts.rolling_time(d, "k", "ts", "v", 600, stat, split_rows=20), "rolling") == pytest.approx(plain, abs=1e-3)
    monkeypatch.setattr(ts, "FRAME_ROWS", 10)
    plain = by_id(ts.rolling_rows(d, "k", "id", "v", 60, stat, split_rows=None), "rolling")
    assert by_id(ts.rolling_rows(d, "k", "id", "v", 60, stat, split_rows=15), "rolling") == pytest.approx(plain, abs=1e-3)


def test_sums_far_from_zero(spark):
    v = spark.createDataFrame([([1e8 + 0.01 * x, 2.0 * x],) for x in range(5)], "v array<double>")
    assert [round(r["v"], 6) for r in arrays.gram(v, "v", centered=True).orderBy("i", "j").collect()] == [0.00025, 0.05, 10.0]
    rows = [("a", float(x), 2.0 * x + 1) for x in range(5)] + [("b", 1e9 + x, 2.0 * (1e9 + x)) for x in range(5)]
    found = models.many_models(spark.createDataFrame(rows, "k string, x double, y double"), ["x"], "y", "k").collect()
    assert [r["coefficients"][0] for r in found] == pytest.approx([2.0, 2.0], abs=1e-6)


def test_sparse_product_with_odd_cells(spark):
    a = spark.createDataFrame([(-1, 0, 2.0), (0, 1, math.inf), (300, 5, 1.0), (7, 10**12, 1.0)], "i bigint, j bigint, v double")
    b = spark.createDataFrame([(0, -7, 3.0), (1, 2, 4.0), (5, 2, 1.0), (0, 2, 1.0), (10**12, 3, 5.0)], "i bigint, j bigint, v double")
    assert sorted(map(tuple, arrays.matmul_coo(a, b).collect())) == [(-1, -7, 6.0), (-1, 2, 2.0), (0, 2, math.inf), (7, 3, 5.0), (300, 2, 1.0)]


def test_infinite_quantile(spark):
    d = spark.createDataFrame([(1.0,), (2.0,), (math.inf,), (math.inf,)], "v double")
    assert quantile_table(d, "v", [0.25, 1.0]).select("q0", "q1").first() == (1.75, math.inf)


def test_dates(spark):
    d = spark.createDataFrame([("a", 1, date(2024, 1, 5)), ("a", 2, date(2024, 8, 1))], "k string, v int, t date")
    assert grouping.groupby_agg(d, "k", {"x": ("argmax", "v", "t"), "y": ("argmin", "v", "t")}).first()[1:] == (2, 1)
    slots = ts.resample(d.withColumn("t", F.col("t").cast("timestamp_ntz")), "t", "quarter", [F.sum("v").alias("s")])
    assert sorted(map(tuple, slots.collect())) == [(datetime(2024, 1, 1), 1), (datetime(2024, 4, 1), None), (datetime(2024, 7, 1), 2)]
    near = d.select("k", F.date_add("t", -3).alias("t"), F.col("v").alias("w"))
    for days, want in ((2, [None, None]), (3, [1, 2])):
        assert [r["w"] for r in joining.merge_asof(d, near, on="t", by="k", tolerance=days).orderBy("v").collect()] == want


def test_scalers_pass_over_missing_values(spark):
    d = spark.createDataFrame([(1.0, None, 5), (2.0, None, 5), (None, None, 5), (4.0, None, 5)], "x double, y double, z int")
    want = {
        features.scale_standard: [-0.872872, -0.218218, None, 1.091089], features.scale_minmax: [0.0, 1 / 3, None, 1.0],
        features.scale_maxabs: [0.25, 0.5, None, 1.0], features.scale_robust: [-2 / 3, 0.0, None, 4 / 3],
    }
    for make, xs in want.items():
        out = make(["x", "y", "z"], "v").fit(d).transform(d).select(vector_to_array("v").alias("v")).collect()
        assert [None if math.isnan(r["v"][0]) else round(r["v"][0], 5) for r in out] == [x if x is None else round(x, 5) for x in xs]
        assert all(math.isnan(r["v"][1]) for r in out)


def test_predict_nothing_for_nothing(spark):
    d = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "id int, v array<double>")

    def make():
        return lambda x: x.sum(axis=1)

    assert by_id(batch_predict(d, make, "v"), "prediction") == {1: 3.0, 2: None}


def test_sequences(spark, tmp_path):
    d = spark.createDataFrame([(1, "B a  b"), (2, "c b"), (3, None), (4, "zz")], "id int, text string")
    vocab = sequences.build_vocab(d.where("id < 4"), "text")
    assert sorted(map(tuple, vocab.collect())) == [("a", 1, 2), ("b", 3, 1), ("c", 1, 3)]
    assert sequences.build_vocab(d, "text", min_count=2).count() == 1 and sequences.build_vocab(d, "text", size=2).count() == 2
    coded = sequences.encode_tokens(d, vocab, "text", "id")
    assert by_id(coded, "ids") == {1: [1, 2, 1], 2: [3, 1], 3: [], 4: [0]}
    wide = spark.createDataFrame([(1, list(range(7))), (2, [9]), (3, [])], "id int, ids array<int>")
    cut = sequences.sequence_windows(wide, "ids", 4, 2).orderBy("id", "start").collect()
    assert [(r["id"], r["start"], r["window"]) for r in cut] == [(1, 0, [0, 1, 2, 3]), (1, 2, [2, 3, 4, 5]), (1, 4, [4, 5, 6]), (2, 0, [9])]
    shards = sequences.write_shards(spark.range(4000), str(tmp_path / "s"), 4)
    sizes = [r["count"] for r in shards.groupBy("shard").count().collect()]
    assert len(sizes) == 4 and sum(sizes) == 4000 and max(sizes) < 1200
    assert shards.select("id").distinct().count() == 4000
