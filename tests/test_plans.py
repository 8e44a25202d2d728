"""Plans that promise to scale contain no nested loop, and read only what they need."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from framewright.operators import grouping, joining
from helpers import plan

from conftest import SF

SMALL_RESULT_ONLY = {"BroadcastNestedLoopJoin", "CartesianProduct"}


@pytest.mark.parametrize("name", [
    "merge_where", "merge_asof", "merge_asof_nearest", "interpolate", "rank_by", "zscore", "winsorize", "box_stats",
    "quantiles", "histogram", "resample", "crosstab", "impute_median", "outliers_iqr", "tfidf", "set_ops_intersect",
    "classification_report", "class_weights", "ewm_mean", "customer_features",
])
def test_no_nested_loops(spark, name):
    text = plan(queries()[name](spark, SF))
    assert not [bad for bad in SMALL_RESULT_ONLY if bad in text]


@pytest.mark.parametrize("name", ["ffill", "cumulative", "rolling_rows", "shift_diff", "zscore", "merge_asof", "ewm_mean"])
def test_grouped_operators_never_use_one_partition(spark, name):
    assert "SinglePartition" not in plan(queries()[name](spark, SF))


def test_rank_is_pruned_before_the_shuffle(spark):
    for name in ("drop_duplicates", "nlargest"):
        text = plan(queries()[name](spark, SF))
        assert "Partial" in text and "WindowGroupLimit" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(queries()["select_filter"](spark, SF))
    assert "LessThan(l_quantity,24.0)" in text
    assert "l_tax" not in text and "l_comment" not in text


def test_set_operations_merge_copies_before_the_shuffle(spark, t):
    d = t("nation").select("n_regionkey")
    text = plan(joining.set_ops(d, d, "intersect"))
    assert "Join" not in text and "partial_max" in text


def test_large_n_uses_positions(spark, t):
    d = t("orders").select("o_custkey", "o_orderkey")
    assert grouping.nlargest(d, "o_custkey", "o_orderkey", 2_000).count() == d.count()


def test_pivot_needs_no_extra_job(spark, t):
    wide = grouping.pivot_table(t("events"), "user_id", "event_type", ["click", "none"], F.sum("value"))
    assert wide.columns == ["user_id", "click", "none"]
    assert wide.where("none is not null").count() == 0
