"""Sums of arrays over the rows of a table, added up as a tree: what fits by passes needs from the data."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SUMS = "part int, sums binary"
SUMS_ARROW = pa.schema([("part", pa.int32()), ("sums", pa.binary())])


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """An Arrow list column without NULLs as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), width)


def partition_sums(rows: DataFrame, size: int, add: Callable[[pa.RecordBatch, np.ndarray], None], parts: int = 1024) -> np.ndarray:
    """``size`` numbers summed over all ``rows``: ``add(batch, sums)`` adds a batch's share in place.

    Each partition gives one array; arrays are added in √``parts`` tasks, ``parts`` being about the number of partitions, and the
    driver adds theirs."""
    fan = max(1, math.isqrt(parts))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sums = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                add(batch, sums)
        yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId() % fan, "sums": sums.tobytes()}], SUMS_ARROW)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size)
        for batch in batches:
            for raw in batch.column("sums"):
                sums += np.frombuffer(raw.as_buffer(), dtype=float)
        yield pa.RecordBatch.from_pylist([{"part": 0, "sums": sums.tobytes()}], SUMS_ARROW)

    out = rows.mapInArrow(first, SUMS)
    if fan > 1:
        out = out.repartition(fan, F.col("part")).mapInArrow(merged, SUMS)
    total = np.zeros(size)
    for r in out.toLocalIterator() if size > 1 << 20 else out.collect():
        total += np.frombuffer(bytes(r["sums"]), dtype=float)
    return total
