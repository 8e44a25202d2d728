"""Isotonic regression in chunks: neighbouring values that fall are pooled inside chunks, then across their borders."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from framewright.functions.exprs import finite
from framewright.operators.ordered import scan
from framewright.session import checkpointed, new_path, stored

#: Different feature values, or pools, of a chunk.
CHUNK_ROWS = 1 << 20
POOLS = "chunk int, lo double, hi double, w double, y double"


class Stack:
    """Pools (chunk, lo, hi, weight, mean) with rising means. A pushed pool swallows those before it that are not below it."""

    def __init__(self):
        self.pools: list[list] = []

    def push(self, chunk: int, lo: float, hi: float, w: float, y: float) -> None:
        while self.pools and self.pools[-1][4] >= y:
            chunk, lo, _, before, mean = self.pools.pop()
            y = mean + (y - mean) * (w / (before + w))
            w += before
        self.pools.append([chunk, lo, hi, w, y])

    def table(self) -> pa.Table:
        columns = list(zip(*self.pools)) or [()] * 5
        kinds = [pa.int32(), *[pa.float64()] * 4]
        return pa.table({c: pa.array(v, k) for c, v, k in zip(["chunk", "lo", "hi", "w", "y"], columns, kinds)})


def pools(df: DataFrame, feature: str, label: str, increasing: bool = True, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(lo, hi, value): the pools of the isotonic fit, as a table.

    Rows are added up by feature value and cut by it into chunks of about ``chunk_rows`` values. A task pools one chunk.
    Then two neighbouring chunks at a time are put together in a task, in pairs that shift by one each round; what is pooled
    across a border belongs to the left chunk, empty chunks drop out, and it ends when no border falls. A task holds the pools
    of two chunks at most, the driver the first and last value of each chunk.
    """
    sign = 1.0 if increasing else -1.0
    rows = df.select(F.col(feature).cast("double").alias("x"), (sign * finite(F.col(label).cast("double"))).alias("y")).dropna(subset=["y"])
    points = stored(rows.where("x is not null").groupBy("x").agg(F.count("*").cast("double").alias("w"), F.avg("y").alias("y")), "isotonic-points")
    chunks = max(1, -(-points.count() // chunk_rows))
    cut = checkpointed(points.repartitionByRange(chunks, "x").withColumn("chunk", F.spark_partition_id()))  # bounds are sampled

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack = Stack()
        for batch in batches:
            for chunk, x, w, y in zip(*(c.to_pylist() for c in batch.columns)):
                stack.push(chunk, x, x, w, y)
        yield from stack.table().to_batches()

    def put_together(table: pa.Table) -> pa.Table:
        stack = Stack()
        for row in zip(*(c.to_pylist() for c in table.sort_by("lo").select(["chunk", "lo", "hi", "w", "y"]).columns)):
            stack.push(*row)
        return stack.table()

    done = stored(cut.sortWithinPartitions("x").select("chunk", "x", "w", "y").mapInArrow(pool, POOLS), "isotonic-pools")
    turn = 0
    while True:
        ends = done.groupBy("chunk").agg(F.min_by("y", "lo").alias("first"), F.max_by("y", "lo").alias("last")).orderBy("chunk").collect()
        falls = [i for i in range(1, len(ends)) if ends[i - 1]["last"] >= ends[i]["first"]]
        if not falls:
            break
        shift = turn % 2 if any((i + turn) % 2 for i in falls) else (turn + 1) % 2  # pairs that have a falling border
        pairs = {r["chunk"]: (i + shift) // 2 for i, r in enumerate(ends)}
        table = df.sparkSession.createDataFrame(list(pairs.items()), "c int, pair int")
        paired = done.join(F.broadcast(table), F.col("chunk") == F.col("c")).drop("c")  # one row a chunk
        done = stored(paired.groupBy("pair").applyInArrow(put_together, POOLS), "isotonic-pools")
        turn += 1
    return done.select("lo", "hi", (sign * F.col("y")).alias("value"))


class IsotonicModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted monotone step: the pool's value inside a pool, a straight line between two, the outermost values beyond. The
    pools are a table; rows and pools are put in one order and the neighbours carried along, so neither side is sent whole."""

    feature = Param(Params._dummy(), "feature", "name of the feature", TypeConverters.toString)
    path = Param(Params._dummy(), "path", "folder of the pools", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, feature: str | None = None, path: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        found = dataset.sparkSession.read.schema("lo double, hi double, value double").parquet(self.getOrDefault("path"))
        corner = F.explode(F.array_distinct(F.array(F.struct(F.col("lo").alias("x"), "value"), F.struct(F.col("hi").alias("x"), "value"))))
        corners = found.select(corner.alias("b")).select(F.col("b.x").alias("__x"), F.lit(0).alias("__own"), "b")
        rows = dataset.select(F.col(self.getOrDefault("feature")).cast("double").alias("__x"), F.lit(1).alias("__own"), F.struct(*dataset.columns).alias("__row"))
        both = rows.unionByName(corners, allowMissingColumns=True)
        both = scan(both, [], ["__x", "__own"], {"__last": ("last", "b"), "__next": ("next", "b")}).where("__own = 1")
        a, b, x = F.col("__last"), F.col("__next"), F.col("__x")
        line = a["value"] + (b["value"] - a["value"]) * ((x - a["x"]) / (b["x"] - a["x"]))
        value = F.when(x.isNull(), None).when(a["x"] == x, a["value"]).when(b.isNull(), a["value"]).when(a.isNull(), b["value"]).otherwise(line)
        return both.select("__row.*", value.alias("prediction"))


def isotonic(df: DataFrame, feature: str, label: str, increasing: bool = True, chunk_rows: int = CHUNK_ROWS) -> IsotonicModel:
    """Monotone calibration of one score. Rows without score or label are not learnt from; a missing score is
    predicted as NULL. Without any rows every prediction is NULL."""
    path = new_path(df.sparkSession, "isotonic")
    stored(pools(df, feature, label, increasing, chunk_rows), "isotonic", path)
    return IsotonicModel(feature=feature, path=path)
