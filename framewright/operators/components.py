"""Principal components of wide vectors, without a matrix of all pairs of columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from framewright.operators.margin import dot_with, listed
from framewright.operators.sums import matrix, partition_sums


class Projection(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Projects a vector column on fixed directions; a NULL vector stays NULL."""

    directions = Param(Params._dummy(), "directions", "the directions, one after the other", TypeConverters.toListFloat)
    variances = Param(Params._dummy(), "variances", "share of the variance along each", TypeConverters.toListFloat)

    def __init__(self, inputCol: str | None = None, outputCol: str | None = None, directions=None, variances=None):
        super().__init__()
        if inputCol is not None:
            flat = [float(x) for x in np.asarray(directions).T.ravel()]
            self._set(inputCol=inputCol, outputCol=outputCol, directions=flat, variances=[float(v) for v in variances])

    @property
    def pc(self) -> DenseMatrix:
        flat, k = self.getOrDefault("directions"), len(self.getOrDefault("variances"))
        return DenseMatrix(len(flat) // k, k, flat)

    @property
    def explainedVariance(self) -> DenseVector:
        return DenseVector(self.getOrDefault("variances"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        vector = F.col(self.getInputCol())
        parts = [dot_with(listed(vector), row) for row in self.pc.toArray().T]
        return dataset.withColumn(self.getOutputCol(), F.when(vector.isNotNull(), array_to_vector(F.array(*parts))))


class PrincipalComponents(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """First ``k`` principal components by a block Krylov method with a random start.

    A pass multiplies the centred rows with a block of ``k`` + 8 directions, up to 64 of short vectors: each partition adds up XᵀXQ for its rows, a tall
    narrow array, and these are added as a tree. The driver makes the products orthonormal to the earlier ones and takes the best
    directions within their span. It holds ``blocks`` such arrays and their products, never one of all pairs of columns. When all
    ``k`` leave a residual below ``tolerance`` of the largest variance the fit is done, mostly after a few passes; when ``blocks``
    are full it starts again from the best directions found. Signs are such that a direction's largest entry is positive.

    Rows without a vector or with a missing or infinite number are left out; no rows raise ``ValueError``. With fewer columns than
    ``k`` there are as many components as columns; directions without variance are any orthonormal ones."""

    k = Param(Params._dummy(), "k", "number of components", TypeConverters.toInt)
    tolerance = Param(Params._dummy(), "tolerance", "largest residual", TypeConverters.toFloat)
    blocks = Param(Params._dummy(), "blocks", "blocks of directions kept", TypeConverters.toInt)
    passes = Param(Params._dummy(), "passes", "most passes", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "of the random start", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None, k: int = 1, tolerance: float = 1e-9,
                 blocks: int = 8, passes: int = 100, seed: int = 42):
        super().__init__()
        self._set(**{"k": 1, "tolerance": 1e-9, "blocks": 8, "passes": 100, "seed": 42} | self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> Projection:
        rows = dataset.select(F.col(self.getInputCol()).alias("v")).withColumn("x", listed(F.col("v"))).where("x is not null")
        rows = rows.where(~F.exists("x", lambda x: F.isnan(x) | (F.abs(x) == float("inf")))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n = rows.count()
            if not n:
                raise ValueError("no rows to learn from")
            found = rows.agg(Summarizer.metrics("mean", "variance").summary(F.col("v")).alias("s")).first()["s"]
            mean, whole = found["mean"].toArray(), float(found["variance"].toArray().sum())
            values, directions = self.leading(rows.select("x"), mean, n)
        finally:
            rows.unpersist()
        directions = directions * np.where(directions[np.abs(directions).argmax(0), np.arange(len(values))] < 0, -1.0, 1.0)
        shares = np.maximum(values, 0) / whole if whole > 0 else np.zeros(len(values))
        return Projection(self.getInputCol(), self.getOutputCol(), directions, shares)

    def leading(self, rows: DataFrame, mean: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        d = len(mean)
        k = min(self.getOrDefault("k"), d)
        width = min(max(k + 8, min(64, (1 << 20) // d)), d)

        def spread(q: np.ndarray) -> np.ndarray:
            """The covariance times ``q``."""

            def add(batch: pa.RecordBatch, sums: np.ndarray) -> None:
                for at in range(0, batch.num_rows, most):  # some rows at a time: a centred copy of them is made
                    x = matrix(batch.column("x").slice(at, most), d) - mean
                    sums += (x.T @ (x @ q)).ravel()

            most = max(1, (1 << 22) // d)
            return partition_sums(rows, q.size, add).reshape(q.shape) / max(1, n - 1)

        block = np.linalg.qr(np.random.default_rng(self.getOrDefault("seed")).normal(size=(d, width)))[0]
        basis, images = np.zeros((d, 0)), np.zeros((d, 0))
        for _ in range(self.getOrDefault("passes")):
            image = spread(block)
            basis, images = np.hstack([basis, block]), np.hstack([images, image])
            inner = basis.T @ images
            values, inside = np.linalg.eigh((inner + inner.T) / 2)
            values, inside = values[::-1][:width], inside[:, ::-1][:, :width]
            best, moved = basis @ inside, images @ inside
            gaps = np.linalg.norm(moved - best * values, axis=0)[:k]
            if gaps.max() <= self.getOrDefault("tolerance") * max(values[0], 0.0) or basis.shape[1] >= d:
                break
            if basis.shape[1] + width > self.getOrDefault("blocks") * width:
                basis, images = best, moved
            block = moved - best * values if basis.shape[1] == width else image
            for _ in range(2):
                block = block - basis @ (basis.T @ block)
            u, size, _ = np.linalg.svd(block, full_matrices=False)
            block = u[:, size > 1e-13 * max(values[0], 0.0)][:, :d - basis.shape[1]]
            if not block.shape[1]:
                break
            block = np.linalg.qr(block - basis @ (basis.T @ block))[0]
        return values[:k], best[:, :k]
