"""Hot lines, payloads and classes: AQE splits the joins that meet them."""

import pytest
from pyspark.sql import functions as F

from framewright.llm import lines, neardup, warc
from framewright.llm.common import written

HOT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "12",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture
def hot(spark):
    old = {c: spark.conf.get(c) for c in HOT}
    for c, v in HOT.items():
        spark.conf.set(c, v)
    yield
    for c, v in old.items():
        spark.conf.set(c, v)


def final_plan(df):
    """The plan after all of its stages have run."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString()


def test_hot_line(spark, hot):
    own = F.concat_ws("\n", F.lit("the one line that every document holds"), F.concat(F.lit("a line of this document alone "), F.col("id")))
    docs = spark.range(0, 20_000, 1, 12).select(F.col("id").alias("doc_id"), own.alias("text"))
    out = lines.drop_repeated_lines(docs)
    assert "skew=true" in final_plan(out)
    assert out.agg(F.sum("n_dropped")).first()[0] == 19_999


def test_hot_payload(spark, hot, monkeypatch):
    rows = spark.range(0, 300_000, 1, 12).select(
        F.xxhash64("id").alias("page"), F.sha2(F.when(F.col("id") % 3 == 0, F.lit("x")).otherwise((F.col("id") % 90_000).cast("string")), 256).alias("digest"), F.lit(500).alias("bytes"),
    )
    plans = []
    monkeypatch.setattr(warc, "written", lambda df, name: plans.append(final_plan(df)) or written(df, name))
    out = warc.revisits(rows, "page", 100)
    assert "skew=true" in plans[1]
    assert out.where(F.col("digest") == F.sha2(F.lit("x"), 256)).count() == 99_999


def test_hot_class(spark, hot):
    """A third of the rows are copies of one text."""
    text = F.when(F.col("id") % 3 == 0, F.lit("one text that a third of all documents hold word by word")).otherwise(
        F.concat_ws(" ", *[F.sha2(F.concat(F.col("id"), F.lit(i)), 256) for i in range(6)])
    )
    docs = spark.range(0, 12_000, 1, 12).select(F.col("id").alias("doc_id"), text.alias("text"))
    out = neardup.near_duplicates(docs)
    assert "skew=true" in final_plan(out)
    found = out.groupBy("class_size").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("k"))
    assert {tuple(r) for r in found.collect()} == {(4000, 4000, 1), (1, 8000, 8000)}
