"""Splitting hot keys changes the plan, never the result."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from framewright.operators import charts, cleaning, grouping, joining, metrics, timeseries as ts_ops
from framewright.operators.arrays import quantiles
from framewright.operators.ordered import hot_keys, positions, quantile_table, scan
from helpers import plan, rows, skewed

ORDER = ["ts", "id"]

OPS = {
    "ffill": lambda d, s: cleaning.ffill(d, "v", "k", ORDER, split_rows=s),
    "bfill": lambda d, s: cleaning.bfill(d, "v", "k", ORDER, split_rows=s),
    "interpolate": lambda d, s: cleaning.interpolate(d, "v", "k", "ts", split_rows=s),
    "impute": lambda d, s: cleaning.impute(d, "v", "median", "k", split_rows=s),
    "outliers": lambda d, s: cleaning.outliers_iqr(d, "v", "k", 0.1, split_rows=s),
    "winsorize": lambda d, s: cleaning.winsorize(d, "v", 0.1, 0.9, split_rows=s),
    "winsorize_by": lambda d, s: cleaning.winsorize(d, "v", 0.1, 0.9, "k", split_rows=s),
    "profile": lambda d, s: cleaning.profile(d, ["v", "id"], split_rows=s),
    "cumulative": lambda d, s: ts_ops.cumulative(d, "k", ORDER, "v", split_rows=s),
    "lag": lambda d, s: ts_ops.shift_diff(d, "k", ORDER, "v", 3, split_rows=s),
    "lead": lambda d, s: ts_ops.shift_diff(d, "k", ORDER, "v", -2, split_rows=s),
    "lag_far": lambda d, s: ts_ops.shift_diff(d, "k", ORDER, "v", 45, split_rows=s),
    "rolling_rows": lambda d, s: ts_ops.rolling_rows(d, "k", ORDER, "v", 7, "sum", split_rows=s),
    **{
        f"rolling_time_{m}": lambda d, s, m=m: ts_ops.rolling_time(d, "k", "ts", "v", 20_000, m, split_rows=s)
        for m in ts_ops.STATS
    },
    "rolling_time_short": lambda d, s: ts_ops.rolling_time(d, "k", "ts", "v", 600, "sum", split_rows=s),
    "rolling_time_all": lambda d, s: ts_ops.rolling_time(d, None, "ts", "v", 7_000, "mean", split_rows=s),
    "ewm": lambda d, s: ts_ops.ewm_mean(d, "k", ORDER, "v", 0.3, split_rows=s),
    "ewm_fast": lambda d, s: ts_ops.ewm_mean(d, "k", ORDER, "v", 0.999999, split_rows=s),
    "ewm_all": lambda d, s: ts_ops.ewm_mean(d, "k", ORDER, "v", 1.0, split_rows=s),
    "positions": lambda d, s: positions(d, "k", ORDER, "p", "size", split_rows=s),
    "positions_all": lambda d, s: positions(d, None, ORDER, "p", "size", split_rows=s),
    "positions_down": lambda d, s: positions(d, "k", [F.col("v").desc_nulls_last(), "id"], "p", split_rows=s),
    "sample": lambda d, s: grouping.sample_stratified(d, "id", "k", 0.3, split_rows=s),
    "nlargest": lambda d, s: grouping.nlargest(d, "k", ORDER, 1_001, split_rows=s),
    "quantiles": lambda d, s: quantiles(d, "v", [0.0, 0.1, 0.5, 0.99, 1.0], "k", split_rows=s),
    "quantiles_all": lambda d, s: quantiles(d, "v", [0.0, 0.1, 0.5, 0.99, 1.0], split_rows=s),
    "ecdf": lambda d, s: charts.ecdf(d, "v", "k", split_rows=s),
    "box_stats": lambda d, s: charts.box_stats(d, "v", "k", 0.2, split_rows=s),
    "groupby_quantile": lambda d, s: grouping.groupby_agg(
        d, "k", {"q": ("quantile", "v", 0.3), "n": ("nunique", "v"), "s": ("size", "v")}, split_rows=s
    ),
    "roc": lambda d, s: metrics.roc_curve(d.withColumn("y", F.col("id") % 2), "y", "v", split_rows=s),
    "pr": lambda d, s: metrics.pr_curve(d.withColumn("y", F.col("id") % 2), "y", "v", split_rows=s),
    "auc": lambda d, s: metrics.auc(d.withColumn("y", F.col("id") % 2), "y", "v", split_rows=s),
    **{
        f"rank_{m}": lambda d, s, m=m: ts_ops.rank_by(d, "k", "v", m, ["id"], split_rows=s)
        for m in ("average", "min", "max", "dense", "first")
    },
    **{
        f"asof_{m}": lambda d, s, m=m: joining.merge_asof(
            d.select("k", "ts", "id"), d.where("id % 3 = 0").select("k", "ts", F.col("v").alias("price")),
            "ts", "k", m, tolerance=600, split_rows=s,
        )
        for m in ("backward", "forward", "nearest")
    },
}


@pytest.mark.parametrize("name", sorted(OPS))
def test_split_equals_plain(spark, name):
    d = skewed(spark)
    assert rows(OPS[name](d, 40)) == rows(OPS[name](d, None))


@pytest.mark.parametrize("parts", [1, 17])
def test_partitioning_does_not_matter(spark, parts):
    d = skewed(spark)
    for name in ("ffill", "ewm", "rank_average", "quantiles", "asof_nearest"):
        assert rows(OPS[name](d.repartition(parts), 40)) == rows(OPS[name](d, None))


def test_hot_keys_are_found(spark):
    d = skewed(spark)
    hot = hot_keys(d, "k", 100)
    assert [r["k"] for r in hot.keys] == ["hot"]
    assert hot_keys(d, "k", 10_000).keys == []


def test_one_key_only(spark):
    """All rows under one key, far more rows than one chunk takes."""
    d = spark.range(5_000).select(F.lit("x").alias("k"), F.col("id"), (F.col("id") % 7).alias("v"))
    out = scan(d, "k", "id", {"s": ("sum", "v")}, {"total": "v"}, split_rows=100)
    running, want = 0, []
    for i in range(5_000):
        running += i % 7
        want.append((i, running, running))
    got = [(r["id"], r["s"], r["s"]) for r in out.orderBy("id").collect()]
    assert got == want
    assert out.select("total").distinct().collect()[0][0] == running


def test_many_equal_values(spark):
    """One value held by most rows of a key."""
    data = [("x", 1.0)] * 500 + [("x", 2.0)] * 3 + [("y", 5.0)]
    d = spark.createDataFrame(data, "k string, v double")
    q = quantile_table(d, "v", [0.5, 0.999], "k", split_rows=10)
    want = pd.DataFrame(data, columns=["k", "v"]).groupby("k")["v"].quantile([0.5, 0.999])
    for r in q.collect():
        assert r["q0"] == pytest.approx(want[r["k"], 0.5]) and r["q1"] == pytest.approx(want[r["k"], 0.999])


def test_against_pandas(spark):
    d = skewed(spark, n=600, seed=3)
    p = d.toPandas().sort_values(["ts", "id"])
    g = p.groupby("k", dropna=False)["v"]
    want = {
        "fill": g.ffill(), "roll": g.transform(lambda s: s.rolling(6, min_periods=1).sum()),
        "ewm": g.transform(lambda s: s.ewm(alpha=0.2, adjust=False, ignore_na=True).mean()),
        "rank": g.rank(), "shift": g.shift(2),
    }
    got = {
        "fill": cleaning.ffill(d, "v", "k", ORDER, "out", split_rows=20),
        "roll": ts_ops.rolling_rows(d, "k", ORDER, "v", 6, "sum", "out", split_rows=20),
        "ewm": ts_ops.ewm_mean(d, "k", ORDER, "v", 0.2, "out", split_rows=20),
        "rank": ts_ops.rank_by(d, "k", "v", out="out", split_rows=20),
        "shift": ts_ops.shift_diff(d, "k", ORDER, "v", 2, split_rows=20).withColumnRenamed("lag", "out"),
    }
    for name, series in want.items():
        found = got[name].select("id", "out").toPandas().set_index("id")["out"].astype(float)
        expected = pd.Series(series.values, index=p["id"].values).reindex(found.index).astype(float)
        if name == "ewm":  # pandas shows the mean so far on missing values as well
            assert found.isna().sum() == expected.isna().sum()
        pd.testing.assert_series_equal(found, expected, check_names=False, check_index_type=False, atol=1e-9, rtol=1e-9)


def brute_asof(left, right, direction, tolerance):
    out = []
    for i, k, t in left:
        best = None
        for rk, rt, rv in right:
            if k is None or rk != k or t is None or rt is None:
                continue
            gap = (t - rt).total_seconds()
            if direction == "backward" and gap < 0 or direction == "forward" and gap > 0:
                continue
            if tolerance is not None and abs(gap) > tolerance:
                continue
            # nearest: the earlier of two that are as far
            rank = (abs(gap), gap < 0)
            if best is None or rank < best[0]:
                best = (rank, rv)
        out.append((i, None if best is None else best[1]))
    return sorted(out)


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("tolerance", [None, 900])
def test_asof_against_brute_force(spark, direction, tolerance):
    d = skewed(spark, n=200, seed=11)
    left = d.where("id % 2 = 0").select("id", "k", "ts")
    right = d.where("id % 2 = 1").select("k", "ts", F.col("id").alias("rid"))
    got = joining.merge_asof(left, right, "ts", "k", direction, tolerance, split_rows=25)
    want = brute_asof(
        [tuple(r) for r in left.collect()], [tuple(r) for r in right.collect()], direction, tolerance
    )
    assert sorted((r["id"], r["rid"]) for r in got.collect()) == want


def test_asof_ties(spark):
    """Equal times, no earlier row, the tolerance's edge, NULL key and NULL time."""
    s = "timestamp_ntz"
    left = spark.createDataFrame(
        [(1, "a", 10), (2, "a", 5), (3, None, 10), (4, "a", None), (5, "a", 20)], "id int, k string, s int"
    ).withColumn("t", F.timestamp_seconds("s").cast(s)).drop("s")
    right = spark.createDataFrame(
        [("a", 10, 1), ("a", 10, 2), (None, 10, 9)], "k string, s int, r int"
    ).withColumn("t", F.timestamp_seconds("s").cast(s)).drop("s")
    out = joining.merge_asof(left, right, "t", "k", tolerance=10, ties=["r"])
    assert sorted((r["id"], r["r"]) for r in out.collect()) == [(1, 2), (2, None), (3, None), (4, None), (5, 2)]
    out = joining.merge_asof(left, right, "t", "k", tolerance=9.999, ties=["r"])
    assert dict((r["id"], r["r"]) for r in out.collect())[5] is None
    out = joining.merge_asof(left, right, "t", "k", "forward", ties=["r"])
    assert sorted((r["id"], r["r"]) for r in out.collect()) == [(1, 1), (2, 1), (3, None), (4, None), (5, None)]


@pytest.mark.parametrize("stat", sorted(ts_ops.STATS))
def test_long_frames_in_blocks(spark, monkeypatch, stat):
    d = skewed(spark)
    monkeypatch.setattr(ts_ops, "FRAME_ROWS", 10)
    for split in (1_000_000, 30):
        got = ts_ops.rolling_rows(d, "k", ORDER, "v", 26, stat, split_rows=split)
        assert rows(got) == rows(ts_ops.rolling_rows(d, "k", ORDER, "v", 26, stat, split_rows=None))
        got = ts_ops.rolling_time(d, "k", "ts", "v", 9_000, stat, split_rows=split)
        assert rows(got) == rows(ts_ops.rolling_time(d, "k", "ts", "v", 9_000, stat, split_rows=None))


def test_random_seeds_ewm(spark):
    rng = random.Random(5)
    data = [(i, rng.uniform(-1, 1)) for i in range(3_000)]
    d = spark.createDataFrame(data, "id int, v double").withColumn("k", F.lit(1))
    for alpha in (0.001, 0.5, 0.97):
        out = ts_ops.ewm_mean(d, "k", "id", "v", alpha, split_rows=500).orderBy("id").collect()
        y = None
        for r, (_, x) in zip(out, data):
            y = x if y is None else (1 - alpha) * y + alpha * x
            assert r["ewm"] == pytest.approx(y, abs=1e-12)


@pytest.mark.parametrize("split_rows", [None, 60])
def test_next_value_needs_no_frame_to_the_end(spark, split_rows):
    """A frame that ends with the group is summed up anew for each row: 100,000 rows of one group took minutes."""
    rng = random.Random(5)
    data = [(i, i // 3, rng.choice([None, None, i]), rng.choice("ab") if i % 7 else None) for i in range(300)]
    d = spark.createDataFrame(data, "id int, t int, v int, k string").repartition(4)
    out = scan(d, "k", ["t", "id"], {"ahead": ("next", "v"), "back": ("last", "v"), "v": ("next", "v")}, split_rows=split_rows)
    assert out.columns == ["id", "t", "v", "k", "ahead", "back"]
    assert split_rows or "unboundedfollowing" not in plan(out).lower()
    for r in out.collect():
        own = [(i, v) for i, _, v, k in data if k == r["k"] and v is not None]
        want = next((v for i, v in own if i >= r["id"]), None)
        assert (r["ahead"], r["v"], r["back"]) == (want, want, next((v for i, v in reversed(own) if i <= r["id"]), None))
