"""Hard negatives by Fagin's threshold algorithm on integer vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from framewright.llm.common import written

#: Rows of a block of candidates, and of anchors, that meet in one task.
BLOCK, ANCHORS = 4096, 4096
#: Largest sum of products that doubles add up exactly.
EXACT = 1 << 53
FIRST_DEPTH = 32
PAIRS = "anchor_id bigint, positive_score bigint, vec_id bigint, score bigint"


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Integer vectors as rows, shorter ones filled up with zeros. Doubles where they hold sums of products exactly, else
    Python's integers."""
    lists = column.combine_chunks()
    sizes = np.asarray(lists.value_lengths(), np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


def exact_pair(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in a type in which inner products are exact."""
    most = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (a, b)]
    kind = float if most[0] * most[1] * max(1, a.shape[1]) < EXACT else object
    return a.astype(kind), b.astype(kind)


class Lists:
    """The candidates of a block, sorted by each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")  # rows by rising value, dimension by dimension
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)

    def depths(self) -> list[int]:
        """How far all lists are read before the threshold is looked at: twice as far each time, at last to their ends."""
        n, out, d = len(self.ids), [], FIRST_DEPTH
        while d < n // 2:
            out.append(d)
            d *= 2
        return [*out, n]

    def thresholds(self, anchors: np.ndarray, depth: int) -> np.ndarray:
        """For each anchor, the largest score of a row not met in the first ``depth`` entries of any list.

        A list is read from its high end where the anchor's component is positive, from its low end where it is negative."""
        high, low = self.sorted[len(self.ids) - depth], self.sorted[depth - 1]
        zero = anchors * 0
        return np.maximum(anchors, zero) @ high + np.minimum(anchors, zero) @ low

    def met(self, anchor: np.ndarray, start: int, depth: int) -> np.ndarray:
        """Rows in the entries ``start`` to ``depth`` of the lists, from the ends that the anchor's signs name."""
        n = len(self.ids)
        up, down = np.flatnonzero(anchor < 0), np.flatnonzero(anchor > 0)
        return np.concatenate([self.order[start:depth, up].ravel(), self.order[n - depth:n - start, down].ravel()])


def search(lists: Lists, anchor: np.ndarray, thresholds: list, depths: list[int], enough) -> tuple[np.ndarray, np.ndarray]:
    """(rows met, their scores): sorted access list by list, each new row scored in full, until ``enough(rows, scores,
    threshold)`` says that no row left can matter, or the lists end."""
    seen = np.zeros(len(lists.ids), bool)
    rows, scores, start = np.zeros(0, np.int64), np.zeros(0, lists.vectors.dtype), 0
    for depth, threshold in zip(depths, thresholds):
        if depth == len(lists.ids):
            new = np.flatnonzero(~seen)
        else:
            fresh = np.zeros(len(lists.ids), bool)
            fresh[lists.met(anchor, start, depth)] = True
            new = np.flatnonzero(fresh & ~seen)
        seen[new] = True
        rows, scores, start = np.concatenate([rows, new]), np.concatenate([scores, lists.vectors[new] @ anchor]), depth
        if depth < len(lists.ids) and enough(rows, scores, threshold):
            break
    return rows, scores


def first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, smaller ids first among equal ones."""
    if len(ids) > 4 * k and scores.dtype != object:
        bound = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= bound)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))
    return np.array(order[:k], np.int64)


def positives_of(lists: Lists, anchor: np.ndarray, own: int, label: int, thresholds: list, depths: list[int], k: int):
    """(rows, scores) of the first ``k`` other rows with the anchor's label."""
    fits = (lists.labels == label) & (lists.ids != own)

    def enough(rows, scores, threshold) -> bool:
        found = scores[fits[rows]]
        return len(found) >= k and threshold < np.sort(found)[len(found) - k]

    rows, scores = search(lists, anchor, thresholds, depths, enough)
    mine = fits[rows]
    rows, scores = rows[mine], scores[mine]
    best = first(lists.ids[rows], scores, k)
    return rows[best], scores[best]


def negatives_of(lists: Lists, anchor: np.ndarray, label: int, windows: list[tuple[int, int]], thresholds: list, depths: list[int], k: int):
    """For each window (low, high) of scores, (rows, scores) of its first ``k`` rows of another label."""
    fits = lists.labels != label

    def inside(scores, window):
        return (scores >= window[0]) & (scores <= window[1])

    def enough(rows, scores, threshold) -> bool:
        found = scores[fits[rows]]
        for window in windows:
            if threshold < window[0]:  # what is left lies below the window
                continue
            held = found[inside(found, window)]
            if len(held) < k or not threshold < np.sort(held)[len(held) - k]:
                return False
        return True

    rows, scores = search(lists, anchor, thresholds, depths, enough)
    mine = fits[rows]
    rows, scores = rows[mine], scores[mine]
    out = []
    for window in windows:
        held = np.flatnonzero(inside(scores, window))
        best = held[first(lists.ids[rows[held]], scores[held], k)]
        out.append((rows[best], scores[best]))
    return out


def window_of(positive: int) -> tuple[int, int]:
    """Scores s with 30 p <= 100 s <= 90 p."""
    return -(-30 * positive // 100), 90 * positive // 100


def blocks_of(anchors: pa.Table, rows: pa.Table, width: int, k: int, negatives: bool) -> Iterator[tuple]:
    """What one block of candidates gives to a block of anchors: (anchor, positive's score, id, score)."""
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    a, b = exact_pair(matrix(anchors["vec"], width), matrix(rows["vec"], width))
    lists = Lists(ids, labels, b)
    depths = lists.depths()
    bounds = np.array([lists.thresholds(a, d) for d in depths]).T
    known = anchors["positives"].to_pylist() if negatives else [None] * len(a)
    for anchor, own, label, limits, scores in zip(a, anchors["vec_id"].to_pylist(), anchors["label"].to_pylist(), bounds, known):
        if not negatives:
            found, values = positives_of(lists, anchor, own, label, limits, depths, k)
            yield from ((own, None, int(ids[r]), int(s)) for r, s in zip(found, values))
            continue
        different = sorted({s for s in scores if s >= 0})  # the window of a negative score is empty
        for p, (found, values) in zip(different, negatives_of(lists, anchor, label, [window_of(p) for p in different], limits, depths, k)):
            yield from ((own, p, int(ids[r]), int(s)) for r, s in zip(found, values))


def meet(anchors: DataFrame, rows: DataFrame, width: int, k: int, negatives: bool, anchor_blocks: int, row_blocks: int) -> DataFrame:
    """The best of every block of ``rows`` for every anchor. Each pair of blocks is one group of bounded size, whatever the labels are."""

    def spread(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        at = F.pmod(F.xxhash64("vec_id", F.lit(17)), F.lit(n)).cast("int").alias(own)
        return df.select(*[F.col(c).alias(c) for c in df.columns], at, F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other))

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        found = list(blocks_of(left, right, width, k, negatives)) if left.num_rows and right.num_rows else []
        columns = list(zip(*found)) or [()] * 4
        names = ["anchor_id", "positive_score", "vec_id", "score"]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(names, columns)})

    left = spread(anchors, "ab", anchor_blocks, "rb", row_blocks).groupBy("ab", "rb")
    right = spread(rows, "rb", row_blocks, "ab", anchor_blocks).groupBy("ab", "rb")
    return left.cogroup(right).applyInArrow(best, PAIRS)


def hard_negatives(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", anchor_every: int = 100,
    positives: int = 5, negatives: int = 10, scale: int = 256, block: int = BLOCK, anchor_block: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its first
    ``positives`` other rows of the same label, the first ``negatives`` rows of other labels whose score s fulfils
    30 p <= 100 s <= 90 p, p being the positive's.

    Components become floor(``scale`` * x); scores are integer inner products, higher first, ties by smaller id. Anchors are the rows
    whose id is divisible by ``anchor_every``. Candidates lie in blocks by a hash of their ids; in each, an anchor reads
    lists sorted by dimension from the ends that its signs name, scores every row it meets, and stops once the threshold (the
    sum of its components times the values it has come to) is strictly below the kth score of each of its windows, or below
    the window itself: a row with the kth score but a smaller id is still met. The first search finds the positives, the second
    the negatives of all of an anchor's windows; the best of the blocks are ranked in Spark. Every anchor meets every block, so the work
    grows with anchors times rows; nothing is emitted but the best.

    Rows with a NULL id, label or vector, or a component that is NULL or not finite, take no part. Vectors of different
    lengths are filled up with zeros; empty ones score 0. Rows repeated with label and vector count once; different rows with one
    id are rows of their own, and none is a partner of its own id. Components and scores must fit into 64 bits. A positive with
    no negative in its window gives no row; an empty table gives none. Other columns are ignored.
    """
    given = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), F.col(vector).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = given.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).where(finite)
    whole = F.transform("x", lambda v: F.floor(v * F.lit(float(scale))))
    rows = written(rows.select("vec_id", "label", whole.alias("vec")).dropDuplicates(), "negatives-rows")
    size = rows.agg(F.count("*"), F.max(F.size("vec")), F.count(F.when(F.col("vec_id") % anchor_every == 0, 1))).first()
    width, row_blocks, anchor_blocks = size[1] or 0, -(-size[0] // block) or 1, -(-size[2] // anchor_block) or 1
    anchors = rows.where(F.col("vec_id") % anchor_every == 0)

    def ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        order = W.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    near = meet(anchors, rows, width, positives, False, anchor_blocks, row_blocks)
    near = written(ranked(near, ["anchor_id"], positives).select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("p")), "negatives-positives")
    windows = near.groupBy("anchor_id").agg(F.collect_set("p").alias("positives"))  # at most ``positives`` numbers
    with_windows = anchors.join(windows, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    far = ranked(meet(with_windows, rows, width, negatives, True, anchor_blocks, row_blocks), ["anchor_id", "positive_score"], negatives)
    far = far.withColumnsRenamed({"anchor_id": "a", "vec_id": "negative_id", "score": "negative_score"})
    out = near.join(far, (F.col("anchor_id") == F.col("a")) & (F.col("p") == F.col("positive_score")))
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
