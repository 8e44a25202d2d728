"""Block scoring of the neighbour searches: few scores are sorted, ties go to the smaller id, repeated and NULL ids."""

import numpy as np
import pyarrow as pa
import pytest

from framewright.operators import neighbours


def table(ids, x):
    return pa.table({"id": pa.array(ids, pa.int64()), "vec": pa.array(list(x), pa.list_(pa.float64()))})


def brute(q_ids, b_ids, scores, k):
    order = sorted(range(len(b_ids)), key=lambda j: (b_ids[j] is None, b_ids[j] or 0))
    out = []
    for i, q in enumerate(q_ids):
        mine = [j for j in order if q is None or b_ids[j] != q]
        best = sorted(mine, key=lambda j: -scores[i, j])[:k]
        out += [(q, b_ids[j], float(scores[i, j])) for j in best]
    return out


@pytest.mark.parametrize("metric", neighbours.METRICS)
def test_few_scores_are_sorted_and_ties_go_to_the_smaller_id(monkeypatch, metric):
    rng = np.random.default_rng(5)
    x, y = rng.integers(-9, 9, (300, 8)).astype(float), rng.integers(-9, 9, (5000, 8)).astype(float)
    x[x.any(1) == 0], y[y.any(1) == 0] = 1.0, 1.0
    y[1000:1900] = y[0]  # copies
    b_ids = [None if i % 997 == 0 else int(v) for i, v in enumerate(rng.integers(0, 4000, len(y)))]
    q_ids = [None if i % 50 == 0 else int(v) for i, v in enumerate(rng.integers(0, 4000, len(x)))]
    s = x @ y.T
    if metric == "cosine":
        s = s / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1)[None, :])
    if metric == "euclidean":
        s = -np.sqrt(np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * s, 0.0))

    sorted_ = []
    plain = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys, *a: sorted_.append(len(keys[0])) or plain(keys, *a))
    monkeypatch.setattr(np, "argsort", lambda *a, **k: pytest.fail("scores of a whole block are sorted"))
    got = neighbours._best(table(q_ids, x), table(b_ids, y), 4, metric, True).to_pylist()
    found = sorted((str(r["q_id"]), round(r["similarity"], 9), str(r["b_id"])) for r in got)
    want = sorted((str(q), round(v, 9), str(b)) for q, b, v in brute(q_ids, b_ids, s, 4))
    assert found == want
    assert sum(sorted_) < 0.05 * s.size


def test_vectors_of_unlike_length_are_refused():
    with pytest.raises(ValueError):
        neighbours._best(table([1, 2], [[1.0], [1.0, 2.0]]), table([3], [[1.0]]), 1, "dot", False)


def test_blocks_follow_the_size_of_the_table(spark):
    from pyspark.sql import functions as F

    def blocks(n):
        d = spark.range(n).select("id", F.lit(None).cast("array<double>").alias("vec"), F.lit(0).alias("b"))
        return neighbours._dealt(d, ["b"], None)[1].first()["__blocks"]

    assert [blocks(n) for n in (100, 4096, 120_000, 1_200_000)] == [1, 1, 16, 37]
