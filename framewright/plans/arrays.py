"""Arrays, matrices, neighbours, inference on arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from framewright.operators import arrays as ops
from framewright.operators.inference import batch_predict
from framewright.operators.models import centroids
from framewright.operators.ivf import build_ivf, topk_similar_ivf
from framewright.operators.neighbours import topk_similar, topk_similar_lsh
from framewright.plans.common import R, round_all
from framewright.registry import Tables, query

CELLS_SQL = """(select vec_id, label, unnest(range(len(embedding))) as i, cast(unnest(embedding) as double) as x from embeddings)"""


@query("vec_ops", """
with v as (select vec_id, cast(embedding as double[]) as a, list_reverse(cast(embedding as double[])) as b from embeddings)
select vec_id, round(list_dot_product(a, b), 6) + 0.0 as dot, round(sqrt(list_dot_product(a, a)), 6) as norm,
       round(list_cosine_similarity(a, b), 6) + 0.0 as cosine from v""")
def vec_dot(t: Tables) -> DataFrame:
    v = t("embeddings").select("vec_id", "embedding", F.reverse("embedding").alias("turned"))
    v = ops.vec_ops(ops.vec_ops(v, "dot", "embedding", "turned"), "norm", "embedding")
    v = ops.vec_ops(v, "cosine", "embedding", "turned")
    return round_all(v.select("vec_id", "dot", "norm", "cosine"), 6, "dot", "norm", "cosine")


@query("vec_ops_elements", f"""
select a.vec_id, cast(a.i as integer) as i, round(a.x + b.x, 6) + 0.0 as added, round(2.5 * a.x, 6) + 0.0 as scaled
from {CELLS_SQL} a join {CELLS_SQL} b on a.vec_id = b.vec_id and a.i = 63 - b.i""")
def vec_elements(t: Tables) -> DataFrame:
    v = t("embeddings").select("vec_id", "embedding", F.reverse("embedding").alias("turned"))
    v = ops.vec_ops(ops.vec_ops(v, "add", "embedding", "turned"), "scale", "embedding", 2.5)
    cells = v.select("vec_id", F.posexplode(F.arrays_zip("add", "scale")).alias("i", "c"))
    return cells.select("vec_id", "i", R("c.add", 6).alias("added"), R("c.scale", 6).alias("scaled"))


@query("topk_similar", """
with s as (select q.vec_id as q_id, b.vec_id as b_id,
  list_cosine_similarity(cast(q.embedding as double[]), cast(b.embedding as double[])) as similarity
  from embeddings q join embeddings b on q.vec_id <> b.vec_id)
select q_id, b_id, round(similarity, 6) + 0.0 as similarity, cast(rn as integer) as "rank" from (
  select *, row_number() over (partition by q_id order by similarity desc, b_id) as rn from s) where rn <= 3""")
def topk(t: Tables) -> DataFrame:
    v = t("embeddings")
    return round_all(topk_similar(v, v, 3, skip_self=True), 6, "similarity")


@query("topk_similar_lsh")
def topk_lsh(t: Tables) -> DataFrame:
    v = t("embeddings")
    return round_all(topk_similar_lsh(v, v, 3, skip_self=True), 6, "similarity")


@query("topk_similar_ivf")
def topk_ivf(t: Tables) -> DataFrame:
    """Every twentieth vector against an inverted-file index of all."""
    v = t("embeddings")
    found = topk_similar_ivf(v.where("vec_id % 20 = 0"), build_ivf(v), 10, skip_self=True)
    return round_all(found, 6, "similarity")


@query("gram", f"""
select cast(a.i as integer) as i, cast(b.i as integer) as j, round(sum(a.x * b.x), 4) + 0.0 as v
from {CELLS_SQL} a join {CELLS_SQL} b on a.vec_id = b.vec_id and a.i <= b.i group by all""")
def gram(t: Tables) -> DataFrame:
    return round_all(ops.gram(t("embeddings"), "embedding"), 4, "v")


@query("gram_covariance", f"""
select cast(a.i as integer) as i, cast(b.i as integer) as j, round(covar_samp(a.x, b.x), 6) + 0.0 as v
from {CELLS_SQL} a join {CELLS_SQL} b on a.vec_id = b.vec_id and a.i <= b.i group by all""")
def covariance(t: Tables) -> DataFrame:
    return round_all(ops.gram(t("embeddings"), "embedding", centered=True), 6, "v")


@query("matmul_coo", f"""
with c as (select label, i, avg(x) as v from {CELLS_SQL} group by all)
select cast(a.label as bigint) as i, cast(b.label as bigint) as j, round(sum(a.v * b.v), 6) + 0.0 as v
from c a join c b on a.i = b.i group by all""")
def matmul(t: Tables) -> DataFrame:
    means = centroids(t("embeddings"), "embedding", "label")
    a = means.select(F.col("label").alias("i"), F.posexplode("vec").alias("j", "v"))
    turned = a.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")
    return round_all(ops.matmul_coo(a, turned), 6, "v")


@query("histogram", """
with e as (select min(value) as lo, max(value) as hi from events),
c as (select least(cast(floor((value - lo) * 20 / (hi - lo)) as integer), 19) as bin, count(*) as n from events, e group by 1)
select cast(g as integer) as bin, round(lo + (hi - lo) / 20 * g, 6) as low, round(lo + (hi - lo) / 20 * (g + 1), 6) as high,
       coalesce(n, 0) as n
from (select unnest(range(20)) as g) cross join e left join c on c.bin = g""")
def histogram(t: Tables) -> DataFrame:
    return round_all(ops.histogram(t("events"), "value", 20), 6, "low", "high")


PS = [0.05, 0.25, 0.5, 0.75, 0.95]


@query("quantiles", " union all ".join(
    f"select event_type, cast({p} as double) as p, round(quantile_cont(value, {p}), 6) as value from events group by event_type"
    for p in PS))
def quantiles(t: Tables) -> DataFrame:
    return round_all(ops.quantiles(t("events"), "value", PS, "event_type"), 6, "value")


@query("batch_predict", f"""
select vec_id, round(sum(x * (i + 1)) + 0.5, 5) + 0.0 as prediction from {CELLS_SQL} group by vec_id""")
def predict(t: Tables) -> DataFrame:
    def load():
        weights = np.arange(1.0, 65.0)
        return lambda embedding: embedding.astype(float) @ weights + 0.5

    out = batch_predict(t("embeddings"), load, "embedding", return_type=DoubleType())
    return out.select("vec_id", R("prediction", 5).alias("prediction"))
