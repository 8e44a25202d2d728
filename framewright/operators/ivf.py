"""Inverted-file index for nearest neighbours: rows in cells of bounded size around sampled centres."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from framewright.operators.hotjoin import hot_join
from framewright.operators.neighbours import BLOCK_ROWS, METRICS, _blockwise, _keep_best, _prepared, topk_similar
from framewright.session import stored

#: Coarse centres and rows they are fitted on, at most. Larger tables get finer cells by splitting.
MOST_CENTRES, MOST_SAMPLE = 4_096, 200_000
#: Rounds of splitting by distance; what is still too large then holds nearly equal vectors.
SPLITS = 8


@dataclass
class InvertedFile:
    """Two tables: ``cells`` (cell, centre) and ``rows`` (cell, id, vec). ``most`` is the largest number of rows of a cell."""

    cells: DataFrame
    rows: DataFrame
    metric: str
    most: int
    longest: float

    def save(self, path: str) -> None:
        head = self.rows.sparkSession.createDataFrame([(self.metric, self.most, self.longest)], "metric string, most bigint, longest double")
        for name, df in (("cells", self.cells), ("rows", self.rows), ("head", head)):
            df.write.parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> InvertedFile:
        head = spark.read.parquet(f"{path}/head").first()
        return cls(spark.read.parquet(f"{path}/cells"), spark.read.parquet(f"{path}/rows"), head["metric"], head["most"], head["longest"])


def _placed(df: DataFrame, metric: str, longest: float, query: bool) -> DataFrame:
    """``df`` with ``at``: where a vector lies so that the nearest by distance is the most similar. Cosine: on the unit
    sphere (a zero vector has no similarity and is left out). Dot product: one more coordinate makes all base vectors as long as the longest."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("vec").to_pylist(), float).reshape(batch.num_rows, -1)
            length = np.linalg.norm(x, axis=1, keepdims=True)
            keep = np.ones(len(x), bool)
            if metric == "cosine":
                keep = length[:, 0] > 0
                x = np.divide(x, length, out=np.zeros_like(x), where=length > 0)
            elif metric == "dot":
                more = np.zeros_like(length) if query else np.sqrt(np.maximum(longest * longest - length * length, 0.0))
                x = np.hstack([x, more])
            at = pa.array([r.tolist() for r in x], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, at], [*batch.schema.names, "at"]).filter(pa.array(keep))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(place, f"{kinds}, at array<double>")


def _nearest(df: DataFrame, centres: DataFrame, k: int, block_rows: int) -> DataFrame:
    """(id, cell): the ``k`` nearest centres of each row, searched in blocks, so no list of centres is sent whole."""
    base = centres.select(F.col("cell").alias("id"), F.col("centre").alias("at"))
    found = topk_similar(df.select("id", "at"), base, k, "euclidean", "id", "at", block_rows=block_rows)
    return found.select(F.col("q_id").alias("id"), F.col("b_id").alias("cell"))


def _apart(a: Column, b: Column) -> Column:
    """Squared distance."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def build_ivf(
    base: DataFrame, metric: str = "cosine", id_col: str = "vec_id", vec: str = "embedding", cell_rows: int | None = None,
    seed: int = 42, block_rows: int = BLOCK_ROWS,
) -> InvertedFile:
    """Index every row of ``base`` that has a vector; ids must differ.

    As many coarse centres as the root of the number of rows (``MOST_CENTRES`` at most) are the means of a sample of
    at most ``MOST_SAMPLE`` rows, those with the smallest hashes. Each row goes to the nearest. A cell with more than ``cell_rows``
    rows (default: four times the root of the number of rows) is split: some of its rows become centres, and its rows go to the
    nearest of these, until no cell is too large. What cannot be split by distance, as its vectors are equal, is dealt to cells with one
    centre by a hash. So the rows of ``probes`` cells grow with the root of the table. Cells and rows are written as tables.
    """
    if metric not in METRICS:
        raise ValueError(f"metric {metric!r} is not one of {METRICS}")
    spark, rows = base.sparkSession, _prepared(base, id_col, vec)
    longest = 0.0
    if metric == "dot":
        square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
        longest = sqrt(rows.agg(F.max(square)).first()[0] or 0.0)
    rows = stored(_placed(rows, metric, longest, False), "ivf-placed")
    n = rows.count()
    most = cell_rows or max(1, 4 * ceil(sqrt(n)))
    wanted = min(MOST_CENTRES, max(1, ceil(sqrt(n))))
    if not n:
        return InvertedFile(spark.createDataFrame([], "cell string, centre array<double>"), rows.select(F.lit("").alias("cell"), "id", "vec"), metric, most, longest)
    sample = rows.orderBy(F.xxhash64("id", F.lit(seed))).limit(min(MOST_SAMPLE, 64 * wanted)).select(array_to_vector("at").alias("features"))
    sample = stored(sample, "ivf-sample")
    means = KMeans(k=wanted, maxIter=10, seed=seed).fit(sample).clusterCenters() if n > 1 else [np.asarray(rows.first()["at"])]
    cells = spark.createDataFrame([(f"{i:05d}", [float(x) for x in c]) for i, c in enumerate(means)], "cell string, centre array<double>")
    placed = stored(rows.join(_nearest(rows, cells, 1, block_rows), "id"), "ivf-rows")

    def sizes(df: DataFrame) -> DataFrame:
        return df.groupBy("cell").agg(F.count("*").alias("c")).where(F.col("c") > most)

    for turn in range(SPLITS):
        large = stored(sizes(placed), "ivf-large")
        if large.isEmpty():
            break
        inside = hot_join(placed, large, "cell", "inner")
        rank = F.row_number().over(W.partitionBy("cell").orderBy(F.xxhash64("id", F.lit(seed + turn + 1)), "id"))
        heads = inside.withColumn("r", rank).where(F.col("r") <= F.ceil(2 * F.col("c") / most)).groupBy("cell").agg(
            F.array_distinct(F.collect_list("at")).alias("heads")  # as many as the cell is to have parts
        )
        split = hot_join(inside.drop("c"), stored(heads, "ivf-heads"), "cell", "inner")
        best = F.array_min(F.transform("heads", lambda h, i: F.struct(_apart(h, F.col("at")).alias("d"), i.alias("i"))))["i"]
        split = split.withColumn("cell", F.concat_ws(".", "cell", best.cast("string"))).drop("heads")
        rest = hot_join(placed, large.select("cell"), "cell", "anti")
        placed = stored(rest.unionByName(split.select(rest.columns)), "ivf-rows")
    large = sizes(placed)
    parts = F.coalesce(F.ceil(F.col("c") / most), F.lit(1))
    dealt = hot_join(placed, stored(large, "ivf-large"), "cell", "left")
    dealt = dealt.withColumn("part", F.when(parts > 1, F.concat(F.lit("#"), F.pmod(F.xxhash64("id"), parts))).otherwise(F.lit("")))
    dealt = dealt.withColumn("cell", F.concat("cell", "part")).drop("part", "c")
    done = stored(dealt, "ivf-rows")
    mean = done.select("cell", F.posexplode("at").alias("i", "x")).groupBy("cell", "i").agg(F.avg("x").alias("x"))
    centre = F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"])
    cells = stored(mean.groupBy("cell").agg(centre.alias("centre")), "ivf-cells")
    return InvertedFile(cells, stored(done.select("cell", "id", "vec"), "ivf"), metric, most, longest)


def topk_similar_ivf(
    q: DataFrame, index: InvertedFile, k: int, id_col: str = "vec_id", vec: str = "embedding", skip_self: bool = False,
    probes: int = 24, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Approximate ``k`` most similar rows of ``index`` per query: q_id, b_id, similarity, rank.

    A query looks into the ``probes`` cells with the nearest centres; their rows are ranked by their own vectors, in
    blocks, as in the exact search. At most ``probes`` times ``index.most`` rows are scored for a query. More probes find more."""
    q = _placed(_prepared(q, id_col, vec), index.metric, index.longest, True)
    looking = q.join(_nearest(q, index.cells, probes, block_rows).withColumnRenamed("id", "__q"), F.col("id") == F.col("__q")).select("cell", "id", "vec")
    found = _blockwise(looking, index.rows.select("cell", "id", "vec"), ["cell"], k, index.metric, skip_self, block_rows)
    return _keep_best(found, k)
