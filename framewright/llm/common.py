"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from framewright.session import new_path

#: ASCII white space: the characters [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Byte table: A-Z to a-z, every other byte that is no word character to a space. Words of
#: the UTF-8 bytes are those of the code points [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ in lower case.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text in lower case (A-Z only), as UTF-8; NULL has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def text_key(*cols: str | Column) -> list[Column]:
    """Two independent 64-bit hashes: 128 bits that stand for the values."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and it outlives executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows with up to about ``most`` bytes of text each (one row at least)."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = size = 0
    for i, n in enumerate(lengths):
        if i > start and size + n > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (u, v); root is the smallest
    node that can be reached. Large-star and small-star steps in turn: each links nodes to the smallest
    neighbour, so the number of steps grows with the logarithm of the longest chain.
    Only counts and sums reach the driver; every step is written to the shared folder, in as many
    partitions as its edges need.
    """
    parts = 8

    def star(e: DataFrame, larger: bool) -> DataFrame:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if not larger:
            both = both.where("v < u")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("w"), F.least("m", "u").alias("m")
        ).coalesce(parts)
        linked = both.join(least, F.col("u") == F.col("w")).coalesce(parts)
        out = linked.where("v > u" if larger else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not larger:
            out = out.union(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
        return out.where("u <> v").distinct().coalesce(parts)

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = written(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), name
    )
    seen = state(edges)
    parts = max(8, -(-seen[0] // 250_000))
    while seen[0]:
        edges = written(star(star(edges, True), False), name)
        now = state(edges)
        if now == seen:
            break
        seen = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
