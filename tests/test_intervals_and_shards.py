"""Interval joins over cells of doubling size, with open ends, and shards of equal length."""

import math
import random

import pytest
from pyspark.sql import functions as F

from framewright.operators import joining, sequences
from helpers import rows

INF, NAN = math.inf, math.nan


def brute(points, spans):
    def below(a, b):  # Spark's order: NaN is larger than any number
        return math.isnan(b) or (not math.isnan(a) and a <= b)

    return sorted(
        (i, s) for i, g, x in points for s, h, lo, hi in spans
        if None not in (x, lo, hi) and g is not None and g == h and below(lo, x) and below(x, hi)
    )


@pytest.mark.parametrize("width", [None, 0.3, 1e4])
def test_open_ends_and_odd_values(spark, width):
    rng = random.Random(2)
    value = lambda: rng.choice([None, NAN, INF, -INF, 0.0, *[rng.uniform(-50, 50) for _ in range(20)]])
    points = [(i, rng.choice("aab") if i % 9 else None, value()) for i in range(250)]
    spans = [(j, rng.choice("ab"), lo, lo + rng.expovariate(0.3) if lo is not None and j % 4 else value()) for j in range(120) for lo in [value()]]
    left = spark.createDataFrame(points, "id int, g string, x double").repartition(3)
    right = spark.createDataFrame(spans, "sid int, g string, lo double, hi double")
    got = joining.merge_where(left, right, "x", "lo", "hi", by="g", width=width, cell_rows=20)
    assert sorted((r["id"], r["sid"]) for r in got.collect()) == brute(points, spans)


def test_integers_far_ends_and_nothing(spark):
    left = spark.createDataFrame([(i, i) for i in range(50)], "id int, x bigint")
    right = spark.createDataFrame([(1, 3, 3), (2, 10, 20), (3, 49, 2**60), (4, -(2**60), 0), (5, 7, 6)], "sid int, lo bigint, hi bigint")
    want = sorted((i, s) for i in range(50) for s, lo, hi in [(1, 3, 3), (2, 10, 20), (3, 49, 2**60), (4, -(2**60), 0)] if lo <= i <= hi)
    got = joining.merge_where(left, right, "x", "lo", "hi")
    assert sorted((r["id"], r["sid"]) for r in got.collect()) == want
    assert joining.merge_where(left, right.where("false"), "x", "lo", "hi").count() == 0
    assert joining.merge_where(left.where("false"), right, "x", "lo", "hi").count() == 0
    wide = spark.createDataFrame([(1, -1.7e308, 1.7e308)], "sid int, lo double, hi double")
    assert joining.merge_where(left, wide, "x", "lo", "hi").count() == 50


def test_open_intervals_do_not_make_a_hot_task(spark):
    """One interval in a hundred is open: the largest task does not read much more than the median."""
    left = spark.range(20_000).select("id", (F.col("id") * 7919 % 100_000 / 100).alias("x"))
    spans = spark.range(2_000).select(
        F.col("id").alias("sid"), (F.col("id") / 2).alias("lo"),
        F.when(F.col("id") % 100 == 0, F.lit(INF)).otherwise(F.col("id") / 2 + 1).alias("hi"),
    )
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for c, v in zip(old, ("false", "-1", "16")):
            spark.conf.set(c, v)
        out = joining.merge_where(left, spans, "x", "lo", "hi", cell_rows=200)
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 16 and sizes[-1] <= 2.2 * sizes[8]
        want = left.join(spans, (F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi"))).count()
        assert sum(sizes) == want
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_tasks_follow_the_pairs_not_the_files(spark, monkeypatch):
    """One file and few cells: the pairs are still spread, without a broadcast, and copies of points are not."""
    monkeypatch.setattr(joining, "TASK_PAIRS", 10_000, raising=False)
    left = spark.range(0, 3000, 1, 1).select("id", F.lit(5.0).alias("x")).coalesce(1)
    spans = spark.range(0, 200, 1, 1).select(F.col("id").alias("sid"), F.lit(0.0).alias("lo"), (F.col("id") % 20).cast("double").alias("hi"))
    out = joining.merge_where(left, spans, "x", "lo", "hi", cell_rows=100)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3000 * 150 and len(sizes) >= 12 and max(sizes) <= 0.25 * sum(sizes)
    assert out.select("id", "sid").distinct().count() == 3000 * 150


@pytest.mark.parametrize("cells", [1, 3, 1 << 14])
@pytest.mark.parametrize("pairs", [30, 1 << 25])
def test_any_largest_cell_and_any_blocks(spark, monkeypatch, cells, pairs):
    """However far cells grow and however their pairs are cut, each pair is found once."""
    for name, value in (("MOST_CELLS", cells), ("TASK_PAIRS", pairs), ("SHARES", 10**9)):
        monkeypatch.setattr(joining, name, value, raising=False)
    rng = random.Random(9)
    odd = [None, NAN, INF, -INF, -20.0, 70.0]
    points = [(i, rng.choice("aaab"), rng.choice(odd) if i % 5 == 0 else 7.0 if i % 5 == 1 else rng.uniform(-30, 80)) for i in range(200)]
    spans = []
    for j in range(60):
        lo = rng.choice(odd) if j % 6 == 0 else rng.uniform(-20, 60)
        spans.append((j, rng.choice("ab"), lo, INF if j % 4 == 0 else NAN if j % 13 == 0 else lo and lo + rng.expovariate(rng.choice([0.03, 2]))))
    left = spark.createDataFrame(points * 2, "id int, g string, x double").repartition(3)
    right = spark.createDataFrame(spans + spans[:20], "sid int, g string, lo double, hi double")
    for rows in (None, 7):
        got = joining.merge_where(left, right, "x", "lo", "hi", by="g", cell_rows=rows)
        assert sorted((r["id"], r["sid"]) for r in got.collect()) == sorted(brute(points, spans + spans[:20]) * 2)


def test_rows_that_meet_many_are_not_listed_often(spark, monkeypatch):
    """Dense pairs: rows are shuffled about once, nothing is checkpointed, and what is written does not follow the pairs."""
    listed, kept = [], []
    dealt, kind = type(spark.range(1)).repartition, type(spark.range(1))
    monkeypatch.setattr(kind, "repartition", lambda self, n, *on: listed.append(self.count()) or dealt(self, n, *on) if on else dealt(self, n))
    monkeypatch.setattr(joining, "checkpointed", lambda d: kept.append(d) or d)
    left = spark.range(30_000).select("id", (F.col("id") * 7919 % 100_000 / 100).alias("x"))
    spans = spark.range(500).select(
        F.col("id").alias("sid"), (F.col("id") * 2).cast("double").alias("lo"),
        F.when(F.col("id") % 10 == 0, F.lit(INF)).otherwise(F.col("id") * 2 + 4).alias("hi"),
    )
    out = joining.merge_where(left, spans, "x", "lo", "hi")
    want = left.join(spans, (F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi"))).count()
    assert out.count() == want and want > 700_000
    assert len(listed) == 2 and listed[0] == 30_000 and listed[1] <= 16_000 and not kept


@pytest.mark.parametrize("split_rows", [None, 500])
def test_shards_of_equal_rows(spark, tmp_path, split_rows):
    d = spark.range(3000).select(F.lit("same").alias("v"), F.lit(None).cast("int").alias("n")).repartition(5)
    out = sequences.write_shards(d, str(tmp_path / "s"), 4, split_rows=split_rows)
    assert sorted(r["count"] for r in out.groupBy("shard").count().collect()) == [750] * 4


def test_shards_keep_the_rows_and_do_not_depend_on_partitions(spark, tmp_path):
    d = spark.range(1001).select((F.col("id") % 700).alias("id"), F.array(F.lit(1.5)).alias("a"))
    one = sequences.write_shards(d, str(tmp_path / "a"), 4)
    two = sequences.write_shards(d.repartition(7), str(tmp_path / "b"), 4, split_rows=300)
    assert rows(one) == rows(two) and rows(one.drop("shard")) == rows(d)
    assert sorted(r["count"] for r in one.groupBy("shard").count().collect()) == [250, 250, 250, 251]


def test_shards_of_nothing(spark, tmp_path):
    assert sequences.write_shards(spark.range(0), str(tmp_path / "s"), 2).count() == 0
