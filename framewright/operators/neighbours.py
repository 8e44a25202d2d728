"""Nearest neighbours: exact in blocks, approximate by hashing, and a classifier on top.

No pair ever becomes a row. Both sides are cut into blocks of bounded size, and a task scores
one query block against one base block. Scoring is a matrix product in strips, of which only scores above a
query's ``k``-th best so far are looked at; a task emits the best ``k`` per query, and the best of those are kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from framewright.functions.exprs import join_on
from framewright.operators.arrays import as_doubles

BLOCK_ROWS = 4_096
#: Rows of a block at most where the caller names no number, and blocks that a smaller table is cut into, for tasks enough.
MOST_ROWS, BLOCKS = 32_768, 16
#: Scores are made for a strip of queries and a chunk of base rows at a time; the first chunks are small.
STRIP, CHUNK, LEAST_CHUNK = 256, 1_024, 16
METRICS = ("cosine", "dot", "euclidean")


def _lengths(x: np.ndarray, metric: str) -> np.ndarray | None:
    """What scores need of each row: its squared length or its length."""
    if metric == "dot":
        return None
    return (x * x).sum(1) if metric == "euclidean" else np.linalg.norm(x, axis=1)


def _score(q: np.ndarray, b: np.ndarray, metric: str, of_q: np.ndarray, of_b: np.ndarray, out: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Similarity of all rows of q and b, written to ``out``; larger is closer. NaN counts as none."""
    s, room = (a[: len(q) * len(b)].reshape(len(q), len(b)) for a in (out, room))
    np.matmul(q, b.T, out=s)
    if metric == "euclidean":
        s *= -2.0
        s += np.add(of_q[:, None], of_b[None, :], out=room)
        np.sqrt(np.maximum(s, 0.0, out=s), out=s)
        np.negative(s, out=s)
    elif metric == "cosine":
        with np.errstate(divide="ignore", invalid="ignore"):  # a zero vector has no similarity: 0 / 0
            s /= np.multiply(of_q[:, None], of_b[None, :], out=room)
    return s


def _rows(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows of a matrix."""
    lists = column.combine_chunks()
    width = pc.list_value_length(lists).unique()
    if len(width) > 1:
        raise ValueError("vectors differ in length")
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(float, copy=False).reshape(len(lists), width[0].as_py() if len(width) else 0)


def _same(q_ids: pa.ChunkedArray, b_ids: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """For each id of ``q_ids`` the first and one past the last place where ascending ``b_ids`` hold it."""
    none = np.zeros(len(q_ids), dtype=np.int64)
    try:
        both = pa.concat_tables([pa.table({"id": b_ids}), pa.table({"id": q_ids})], promote_options="permissive")
    except pa.ArrowTypeError:  # ids of different kinds are never equal
        return none, none
    codes = both["id"].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    of_b, of_q = codes[: len(b_ids)], codes[len(b_ids):]
    of_b = of_b[of_b >= 0]  # ids ascend, so their codes do; NULL ids stand at the end and equal none
    return np.searchsorted(of_b, of_q, "left"), np.where(of_q < 0, 0, np.searchsorted(of_b, of_q, "right"))


def _best(q: pa.Table, b: pa.Table, k: int, metric: str, skip_self: bool) -> pa.Table:
    """Best ``k`` of b for each row of q, ties to the smaller id. Scores are made for a few rows at a time; only what
    beats a row's ``k``-th best so far is looked at, so nothing is sorted whole."""
    # base ids ascend and a later one has to be better, so ties go to the smaller id
    b = b.take(pc.sort_indices(b["id"]))
    x, y = _rows(q["vec"]), _rows(b["vec"])
    first, last = _same(q["id"], b["id"]) if skip_self else (np.zeros(len(x), np.int64),) * 2
    of_x, of_y = _lengths(x, metric), _lengths(y, metric)
    out, room, above = (np.empty(STRIP * CHUNK, t) for t in (float, float, bool))  # used again and again: fresh memory is slow
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for start in range(0, len(x) if len(y) else 0, STRIP):
        part = x[start:start + STRIP]
        top = np.full((len(part), k), -np.inf)
        at = np.full((len(part), k), -1)
        done = 0
        while done < len(y):
            end = min(len(y), done + min(max(done, LEAST_CHUNK), CHUNK))
            lengths = (None, None) if of_x is None else (of_x[start:start + STRIP], of_y[done:end])
            s = _score(part, y[done:end], metric, *lengths, out, room)
            low, high = (np.clip(e[start:start + STRIP] - done, 0, end - done) for e in (first, last))
            own = high - low
            if own.any():
                rows = np.repeat(np.arange(len(part)), own)
                s[rows, np.arange(len(rows)) - np.repeat(np.cumsum(own) - own, own) + np.repeat(low, own)] = -np.inf
            hits = np.flatnonzero(np.greater(s, top[:, -1:], out=above[: s.size].reshape(s.shape)))
            if len(hits):
                row, col = np.divmod(hits, end - done)
                better = np.unique(row)
                rows = np.concatenate([np.repeat(better, k), row])
                score = np.concatenate([top[better].ravel(), s.ravel()[hits]])
                place = np.concatenate([at[better].ravel(), col + done])
                order = np.lexsort((place, -score, rows))
                rows, begins = rows[order], np.searchsorted(rows[order], better)
                keep = (begins[:, None] + np.arange(k)).ravel()
                top[better] = score[order][keep].reshape(-1, k)
                at[better] = place[order][keep].reshape(-1, k)
            done = end
        row, col = np.nonzero(np.isfinite(top))
        found.append((row + start, at[row, col], top[row, col]))
    q_at, b_at, similarity = (np.concatenate(c) for c in zip(*found))
    return pa.table({"q_id": q["id"].take(pa.array(q_at)), "b_id": b["id"].take(pa.array(b_at)), "similarity": similarity})


def _dealt(df: DataFrame, bucket: Sequence[str], rows: int | None) -> tuple[DataFrame, DataFrame]:
    """(rows with a block number ``__at`` below their bucket's number of blocks,
    buckets with that number ``__blocks``). A bucket of any size is cut evenly."""
    n = F.count("*")
    if rows is None:
        rows = F.least(F.lit(MOST_ROWS), F.greatest(F.lit(BLOCK_ROWS), F.ceil(n / BLOCKS)))
    sizes = df.groupBy(*bucket).agg(F.ceil(n / rows).cast("int").alias("__blocks"))
    out = join_on(df, sizes, bucket).withColumn(
        "__at", F.pmod(F.xxhash64("id"), F.col("__blocks")).cast("int")
    )
    return out.drop("__blocks"), sizes


def _blockwise(
    q: DataFrame, base: DataFrame, bucket: Sequence[str], k: int, metric: str, skip_self: bool, rows: int | None
) -> DataFrame:
    """Best ``k`` per query and block pair inside equal buckets."""
    bucket = list(bucket)
    q, q_sizes = _dealt(q, bucket, rows)
    base, b_sizes = _dealt(base, bucket, rows)

    def copies(d: DataFrame, other: DataFrame, own: str, theirs: str) -> DataFrame:
        """Rows, once per block of the other side in their bucket."""
        spread = F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)).alias(theirs)
        return join_on(d, other, bucket, "inner").select(*bucket, "id", "vec", F.col("__at").alias(own), spread)

    keys = [*bucket, "__qb", "__bb"]
    left = copies(q, b_sizes, "__qb", "__bb").groupBy(*keys)
    right = copies(base, q_sizes, "__bb", "__qb").groupBy(*keys)
    return left.cogroup(right).applyInArrow(
        lambda l, r: _best(l, r, k, metric, skip_self), f"q_id {_id_kind(q)}, b_id {_id_kind(base)}, similarity double"
    )


def _keep_best(found: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("q_id").orderBy(F.col("similarity").desc(), "b_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _id_kind(df: DataFrame) -> str:
    return df.schema["id"].dataType.simpleString()


def _prepared(df: DataFrame, id_col: str, vec: str, floats: bool = False) -> DataFrame:
    """Ids of any type, and vectors; rows without a vector have no neighbours and are none. ``floats`` keeps 32-bit numbers,
    half as long on their way, for a reader that widens them."""
    kept = floats and df.schema[vec].dataType.simpleString() == "array<float>"
    return df.where(F.col(vec).isNotNull()).select(F.col(id_col).alias("id"), (F.col(vec) if kept else as_doubles(vec)).alias("vec"))


def topk_similar(
    q: DataFrame, base: DataFrame, k: int, metric: str = "cosine", id_col: str = "vec_id", vec: str = "embedding",
    skip_self: bool = False, block_rows: int | None = None,
) -> DataFrame:
    """Exact ``k`` most similar base rows per query: q_id, b_id, similarity, rank.

    Scores every pair (as any exact search without an index must), in blocks of ``block_rows`` or a number that
    follows the table. For a base too large for that, use ``topk_similar_lsh``.
    """
    if metric not in METRICS:
        raise ValueError(f"metric {metric!r} is not one of {METRICS}")
    q, base = _prepared(q, id_col, vec, True), _prepared(base, id_col, vec, True)
    one = F.lit(0).alias("__all")
    found = _blockwise(q.select("*", one), base.select("*", one), ["__all"], k, metric, skip_self, block_rows)
    return _keep_best(found, k)


def topk_similar_lsh(
    q: DataFrame, base: DataFrame, k: int, metric: str = "cosine", id_col: str = "vec_id", vec: str = "embedding",
    skip_self: bool = False, tables: int = 12, projections: int = 3, width: float = 2.0, seed: int = 42,
    block_rows: int = MOST_ROWS,
) -> DataFrame:
    """Approximate ``k`` most similar: exact search among base rows that share a
    bucket with the query in at least one of ``tables``.

    A bucket is a cell of ``width`` on ``projections`` random directions; for cosine the
    vectors are scaled to length one first. Wider cells, fewer projections and more
    tables find more neighbours and cost more. A bucket that holds a large share of
    the rows is searched in blocks like the exact form; nothing in it is skipped.
    """
    if metric not in METRICS:
        raise ValueError(f"metric {metric!r} is not one of {METRICS}")
    q, base = _prepared(q, id_col, vec, True), _prepared(base, id_col, vec, True)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows(pa.chunked_array([batch.column("vec")]))
            lengths = np.linalg.norm(x, axis=1, keepdims=True)
            unit = np.divide(x, lengths, out=np.zeros_like(x), where=lengths > 0) if metric == "cosine" else x
            rng = np.random.default_rng(seed)
            directions = rng.standard_normal((x.shape[1], tables * projections))
            offsets = rng.uniform(0, width, tables * projections)
            cells = np.floor((unit @ directions + offsets) / width).astype(np.int64)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(cells.ravel()), projections).cast(pa.list_(pa.int64()))
            starts = pa.array(np.arange(0, len(flat) + 1, tables, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(starts, flat)], ["id", "vec", "cells"])

    def bucketed(d: DataFrame) -> DataFrame:
        kind = d.schema["vec"].dataType.simpleString()
        out = d.mapInArrow(hashed, f"id {_id_kind(d)}, vec {kind}, cells array<array<bigint>>")
        return out.select("id", "vec", F.posexplode("cells").alias("table", "bucket"))

    found = _blockwise(bucketed(q), bucketed(base), ["table", "bucket"], k, metric, skip_self, block_rows)
    once = found.groupBy("q_id", "b_id").agg(F.max("similarity").alias("similarity"))
    return _keep_best(once, k)


def knn_classify(
    train: DataFrame, df: DataFrame, features: str, label: str, k: int, id_col: str = "vec_id",
    metric: str = "cosine", skip_self: bool = False,
) -> DataFrame:
    """Majority label of the exact ``k`` nearest training rows, the smallest label on ties. Rows without a
    vector, or with no neighbour, get a NULL label."""
    near = topk_similar(df, train, k, metric, id_col, features, skip_self)
    labels = train.select(F.col(id_col).alias("b_id"), F.col(label).alias("__label"))
    votes = near.join(labels, "b_id").groupBy("q_id", "__label").agg(F.count("*").alias("__n"))
    best = F.min(F.struct((-F.col("__n")).alias("n"), F.col("__label").alias("label")))
    found = votes.groupBy("q_id").agg(best.alias("b")).select(F.col("q_id").alias(id_col), F.col("b.label").alias("prediction"))
    return join_on(df.select(id_col), found, id_col)
