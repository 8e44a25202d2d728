"""Models. Where SQL cannot repeat a fit, the query returns predictions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from framewright.operators import models as ops
from framewright.operators.inference import class_weights
from framewright.operators.neighbours import knn_classify
from framewright.plans.arrays import CELLS_SQL
from framewright.plans.common import LINE_KEYS, LINE_SQL, R, round_all, scored
from framewright.registry import Tables, query


@query("ols", f"""
with m as (select regr_slope(l_extendedprice, l_quantity) as a, regr_intercept(l_extendedprice, l_quantity) as b from lineitem)
select {LINE_SQL}, round(b + a * l_quantity, 4) as prediction from lineitem, m""")
def ols(t: Tables) -> DataFrame:
    rows = t("lineitem").select(*LINE_KEYS, "l_quantity", "l_extendedprice")
    model = ops.ols(rows, ["l_quantity"], "l_extendedprice")
    return model.transform(rows).select(*LINE_KEYS, R("prediction", 4).alias("prediction"))


@query("ols_by_group", """
select l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) + 0.0 as slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) as intercept,
       round(regr_r2(l_extendedprice, l_quantity), 8) as r2, cast(regr_count(l_extendedprice, l_quantity) as bigint) as n
from lineitem group by l_returnflag""")
def ols_by_group(t: Tables) -> DataFrame:
    out = ops.ols_by_group(t("lineitem"), "l_quantity", "l_extendedprice", "l_returnflag")
    return out.select("l_returnflag", R("slope", 6).alias("slope"), R("intercept", 4).alias("intercept"), R("r2", 8).alias("r2"), "n")


@query("many_models", """
with s as (select l_returnflag, count(*) as n, avg(l_quantity) as m1, avg(l_discount) as m2, avg(l_extendedprice) as my,
  covar_pop(l_quantity, l_quantity) as s11, covar_pop(l_discount, l_discount) as s22, covar_pop(l_quantity, l_discount) as s12,
  covar_pop(l_quantity, l_extendedprice) as s1y, covar_pop(l_discount, l_extendedprice) as s2y from lineitem group by l_returnflag),
b as (select *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) as b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) as b2 from s)
select l_returnflag, n, round(my - b1 * m1 - b2 * m2, 3) + 0.0 as intercept, round(b1, 4) + 0.0 as b_quantity, round(b2, 3) + 0.0 as b_discount
from b""")
def many_models(t: Tables) -> DataFrame:
    out = ops.many_models(t("lineitem"), ["l_quantity", "l_discount"], "l_extendedprice", "l_returnflag")
    b = F.col("coefficients")
    return out.select(
        "l_returnflag", "n", R("intercept", 3).alias("intercept"), R(b[0], 4).alias("b_quantity"), R(b[1], 3).alias("b_discount")
    )


@query("naive_bayes", f"""
with c as {CELLS_SQL},
m as (select label, i, avg(x) as mu, var_pop(x) as var from c group by all),
e as (select 1e-9 * max(v) as eps from (select var_pop(x) as v from c group by i)),
p as (select label, ln(count(*) / (select cast(count(*) as double) from embeddings)) as prior from embeddings group by label),
s as (select c.vec_id, m.label, any_value(prior) + sum(-0.5 * ln(2 * pi() * (var + eps)) - (x - mu) * (x - mu) / (2 * (var + eps))) as score
  from c join m on c.i = m.i join p on p.label = m.label, e group by c.vec_id, m.label)
select vec_id, cast(label as integer) as prediction from (
  select *, row_number() over (partition by vec_id order by score desc, label) as rn from s) where rn = 1""")
def naive_bayes(t: Tables) -> DataFrame:
    rows = t("embeddings")
    model = ops.naive_bayes(rows, "embedding", "label")
    return model.transform(rows).select("vec_id", F.col("prediction").cast("int").alias("prediction"))


def counted(rows: DataFrame, label: str = "label") -> DataFrame:
    return rows.groupBy(label, F.col("prediction").cast("int").alias("prediction")).agg(F.count("*").alias("n"))


@query("logistic")
def logistic(t: Tables) -> DataFrame:
    rows = t("embeddings")
    return counted(ops.logistic(rows, "embedding", "label", l2=0.01).transform(rows))


@query("linear_svm")
def linear_svm(t: Tables) -> DataFrame:
    rows = scored(t).withColumn("size", F.log1p("n_chars"))
    return counted(ops.linear_svm(rows, ["size"], "quality", l2=0.01).transform(rows), "quality")


def forest(t: Tables, kind: str) -> DataFrame:
    rows = t("embeddings")
    return counted(ops.tree_models(rows, "embedding", "label", kind).transform(rows))


@query("tree_models")
def random_forest(t: Tables) -> DataFrame:
    return forest(t, "forest")


@query("tree_models_single")
def single_tree(t: Tables) -> DataFrame:
    return forest(t, "tree")


@query("tree_models_boosted")
def boosted(t: Tables) -> DataFrame:
    rows = t("lineitem").select(*LINE_KEYS, "l_quantity", "l_discount", "l_extendedprice")
    model = ops.tree_models(rows, ["l_quantity", "l_discount"], "l_extendedprice", "boosted", "regress")
    return model.transform(rows).select(*LINE_KEYS, R("prediction", 4).alias("prediction"))


@query("mlp")
def mlp(t: Tables) -> DataFrame:
    rows = t("embeddings")
    return counted(ops.mlp(rows, "embedding", "label", [64, 16, 10]).transform(rows))


@query("nearest_centroid", f"""
with c as {CELLS_SQL}, m as (select label, i, avg(x) as mu from c group by all),
d as (select c.vec_id, m.label, sqrt(sum((x - mu) * (x - mu))) as distance from c join m on c.i = m.i group by c.vec_id, m.label)
select vec_id, cast(label as bigint) as prediction, round(distance, 5) as distance from (
  select *, row_number() over (partition by vec_id order by distance, label) as rn from d) where rn = 1""")
def nearest_centroid(t: Tables) -> DataFrame:
    v = t("embeddings")
    return round_all(ops.nearest_centroid(v, v, "embedding", "label"), 5, "distance")


@query("knn_classify", """
with s as (select q.vec_id, b.label, b.vec_id as b_id,
  list_dot_product(cast(q.embedding as double[]), cast(b.embedding as double[])) as s
  from embeddings q join embeddings b on q.vec_id <> b.vec_id),
k as (select *, row_number() over (partition by vec_id order by s desc, b_id) as rn from s),
v as (select vec_id, label, count(*) as n from k where rn <= 5 group by all)
select vec_id, label as prediction from (select *, row_number() over (partition by vec_id order by n desc, label) as rn from v) where rn = 1""")
def knn(t: Tables) -> DataFrame:
    v = t("embeddings")
    return knn_classify(v, v, "embedding", "label", 5, metric="dot", skip_self=True)


@query("kmeans")
def kmeans(t: Tables) -> DataFrame:
    rows = t("embeddings")
    return ops.kmeans(rows, "embedding", 10).transform(rows).select("vec_id", "prediction")


@query("kmeans_bisecting")
def bisecting(t: Tables) -> DataFrame:
    rows = t("embeddings")
    return ops.kmeans(rows, "embedding", 8, "bisecting").transform(rows).select("vec_id", "prediction")


@query("gaussian_mixture")
def gaussian_mixture(t: Tables) -> DataFrame:
    rows = t("lineitem").select(*LINE_KEYS, "l_quantity", "l_discount")
    model = ops.gaussian_mixture(rows, ["l_quantity", "l_discount"], 3)
    share = vector_to_array("probability")
    return model.transform(rows).select(*LINE_KEYS, "prediction", R(F.array_max(share), 4).alias("probability"))


@query("isotonic")
def isotonic(t: Tables) -> DataFrame:
    rows = scored(t).withColumn("size", F.col("n_chars").cast("double"))
    model = ops.isotonic(rows, "size", "quality")
    return model.transform(rows).select("doc_id", R("prediction", 6).alias("prediction"))


@query("class_weights", """
select doc_id, quality, round(n / cast(k * c as double), 6) as weight from (
  select doc_id, quality, count(*) over () as n, count(*) over (partition by quality) as c,
         (select count(distinct quality) from labels) as k from labels)""")
def weights(t: Tables) -> DataFrame:
    return round_all(class_weights(t("labels").select("doc_id", "quality"), "quality"), 6, "weight")
