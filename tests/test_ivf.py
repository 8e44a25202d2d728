"""The inverted-file index: bounded cells, recall against the exact search, every row indexed."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.operators import ivf, neighbours
from helpers import rows


def recall(found, exact):
    a, b = ({(r["q_id"], r["b_id"]) for r in d.select("q_id", "b_id").collect()} for d in (found, exact))
    return len(a & b) / len(b)


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
def test_recall_on_embeddings(spark, metric):
    base = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    q = base.where("vec_id % 20 = 0")
    index = ivf.build_ivf(base, metric)
    found = ivf.topk_similar_ivf(q, index, 10)
    assert recall(found, neighbours.topk_similar(q, base, 10, metric)) >= 0.9
    assert index.rows.count() == base.count()
    assert index.rows.groupBy("cell").count().agg(F.max("count")).first()[0] <= index.most == 4 * 45


def test_clusters_and_equal_vectors(spark):
    """A third of the rows are one vector, the rest lie in a few dense places: cells stay bounded all the same."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 8)) * 10
    data = [(i, (centres[0] if i % 3 == 0 else centres[i % 5] + rng.normal(size=8) * 0.1).tolist()) for i in range(3000)]
    base = spark.createDataFrame(data + [(9000, None)], "vec_id bigint, embedding array<double>").repartition(4)
    index = ivf.build_ivf(base, "euclidean", cell_rows=100)
    sizes = [r["count"] for r in index.rows.groupBy("cell").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 160  # a part dealt by hash is even only on average
    q = base.where("vec_id % 100 = 1")
    found, exact = ivf.topk_similar_ivf(q, index, 5), neighbours.topk_similar(q, base, 5, "euclidean")
    assert recall(found, exact) >= 0.9


def test_saved_and_empty(spark, tmp_path):
    base = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(30)], "vec_id bigint, embedding array<float>")
    index = ivf.build_ivf(base, "dot")
    index.save(str(tmp_path / "i"))
    again = ivf.InvertedFile.load(spark, str(tmp_path / "i"))
    exact = neighbours.topk_similar(base, base, 3, "dot", skip_self=True)
    assert rows(ivf.topk_similar_ivf(base, again, 3, skip_self=True)) == rows(exact)
    none = base.where("false")
    assert ivf.topk_similar_ivf(base, ivf.build_ivf(none), 3).count() == 0
    assert ivf.topk_similar_ivf(none, index, 3).count() == 0
    with pytest.raises(ValueError):
        ivf.build_ivf(base, "hamming")
