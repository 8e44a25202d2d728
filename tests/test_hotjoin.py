"""Joins that split hot keys: the rows of the plain join, and no task with a whole hot key."""

import random

import pytest
from pyspark.sql import functions as F

from framewright.operators.hotjoin import hot_cells, hot_join
from framewright.operators.joining import merge, merge_semi_anti
from helpers import rows

KINDS = ["inner", "left", "right", "outer", "semi", "anti"]


def sides(spark, seed, hot_left=True, hot_right=False):
    rng = random.Random(seed)
    key = lambda hot: "hot" if hot and rng.random() < 0.34 else rng.choice(["a", "b", "c", "d", "only", None, "e"])
    left = [(key(hot_left), rng.randrange(3) or None, i // 3, "x") for i in range(300)]
    right = [(key(hot_right).replace("only", "other") if (k := key(hot_right)) and hot_right else rng.choice(["a", "a", "hot", "z", None, "e"]), rng.randrange(3) or None, i // 2) for i in range(90) if not hot_right or key(True)]
    return (
        spark.createDataFrame(left, "k string, m int, v int, w string").repartition(3),
        spark.createDataFrame(right, "k string, m int, v int").repartition(3),
    )


def named(df):
    return df.toDF(*[f"{c}{i}" for i, c in enumerate(df.columns)])


@pytest.mark.parametrize("how", KINDS)
@pytest.mark.parametrize("on", [["k"], ["k", "m"]])
def test_rows_of_the_plain_join(spark, how, on):
    for seed in (1,):
        left, right = sides(spark, seed)
        plain = left.join(right, on, f"left_{how}" if how in ("semi", "anti") else how)
        split = hot_join(left, right, on, how, cell_rows=8)
        if how in ("semi", "anti"):
            plain = plain.select(*split.columns)
        assert rows(named(split)) == rows(named(plain)), (seed, how)
        assert split.columns == plain.columns


@pytest.mark.parametrize("how", ["inner", "left", "outer"])
def test_hot_on_both_sides(spark, how):
    left = spark.range(240).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("int").alias("k"), F.col("id").alias("l"))
    right = spark.range(120).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 40).cast("int").alias("k"), F.col("id").alias("r"))
    assert rows(hot_join(left, right, "k", how, cell_rows=10)) == rows(left.join(right, "k", how))


def test_hot_only_on_the_right(spark):
    right = spark.range(300).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).cast("int").alias("k"), F.col("id").alias("r"))
    left = spark.range(20).select(F.col("id").cast("int").alias("k"), F.col("id").alias("l"))
    for how in ("inner", "left", "right", "outer"):
        assert rows(hot_join(left, right, "k", how, cell_rows=10)) == rows(left.join(right, "k", how))


def test_equal_rows_and_empty_sides(spark):
    left = spark.createDataFrame([(1, "x")] * 500 + [(None, "x")] * 500, "k int, v string")
    none = left.where("false").withColumnRenamed("v", "r")
    one = spark.createDataFrame([(1, "r"), (1, "r")], "k int, r string")
    for how in KINDS:
        for right in (none, one):
            plain = left.join(right, "k", f"left_{how}" if how in ("semi", "anti") else how)
            assert rows(hot_join(left, right, "k", how, cell_rows=20)) == rows(plain)
    assert hot_join(left.where("false"), one, "k", "outer", cell_rows=1).count() == 2


def test_no_task_holds_a_hot_key(spark):
    """A third of the rows under one key: every task reads at most twice the median."""
    left = spark.range(120_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 9000).alias("k"), "id")
    right = spark.range(-1, 9000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("r"))
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        for how in ("semi", "anti", "inner", "left", "outer"):
            keys = right if how != "anti" else right.where("k = -5")
            joined = hot_join(left, keys, "k", how, cell_rows=500)
            sizes = sorted(r["count"] for r in joined.where("id is not null").groupBy(F.spark_partition_id()).count().collect())
            sizes = [n for n in sizes if n > 100]
            assert sum(sizes) >= 119_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2], how
        worst = left.join(right, "k", "left_semi").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert worst > 40_000  # what the plain join does
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_sketch_finds_hot_keys_only(spark):
    df = spark.range(50_000).select(F.when(F.col("id") % 4 == 0, 5).otherwise(F.col("id")).alias("k"), F.lit(None).cast("int").alias("n"))
    [(_, cells)] = hot_cells(df, ["k"], 1000).items()
    assert 12 <= cells <= 14
    assert hot_cells(df, ["n"], 10) == {} and hot_cells(df, ["k"]) == {}  # NULLs, and keys below two cells of the usual size


def test_merges_use_it(spark):
    left, right = sides(spark, 5)
    assert rows(named(merge(left, right, "k", "outer", cell_rows=8))) == rows(named(left.join(right, "k", "outer")))
    assert rows(named(merge(left, right, "k", split=True, cell_rows=8))) == rows(named(left.join(right, "k")))
    assert rows(merge_semi_anti(left, right, "k", "anti", cell_rows=8)) == rows(left.join(right, "k", "left_anti").select("k", "m", "v", "w"))
    with pytest.raises(ValueError):
        hot_join(left, right, "k", "cross")
