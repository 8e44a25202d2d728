"""Feature preparation."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from framewright.operators import features as ops
from framewright.operators.grouping import split_by_hash
from framewright.plans.common import LINE_KEYS, LINE_SQL, R, round_all
from framewright.plans.grouping import HASH_SQL
from framewright.registry import Tables, query

PAIR = ["l_quantity", "l_extendedprice"]


def scaled(t: Tables, step, names=("a", "b")) -> DataFrame:
    rows = t("lineitem").select(*LINE_KEYS, *PAIR)
    out = step.fit(rows).transform(rows)
    vec = vector_to_array("v")
    return out.select(*LINE_KEYS, *[R(vec[i], 6).alias(n) for i, n in enumerate(names)])


def two(sql: str) -> str:
    cols = ", ".join(f"round({sql.format(c=c)}, 6) + 0.0 as {n}" for n, c in zip("ab", PAIR))
    return f"select {LINE_SQL}, {cols} from lineitem"


@query("scale_standard", two("({c} - (select avg({c}) from lineitem)) / (select stddev_samp({c}) from lineitem)"))
def scale_standard(t: Tables) -> DataFrame:
    return scaled(t, ops.scale_standard(PAIR, "v"))


@query("scale_minmax", two("({c} - (select min({c}) from lineitem)) / (select max({c}) - min({c}) from lineitem)"))
def scale_minmax(t: Tables) -> DataFrame:
    return scaled(t, ops.scale_minmax(PAIR, "v"))


@query("scale_maxabs", two("{c} / (select max(abs({c})) from lineitem)"))
def scale_maxabs(t: Tables) -> DataFrame:
    return scaled(t, ops.scale_maxabs(PAIR, "v"))


@query("scale_robust", two(
    "({c} - (select quantile_cont({c}, 0.5) from lineitem)) / "
    "(select quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) from lineitem)"))
def scale_robust(t: Tables) -> DataFrame:
    return scaled(t, ops.scale_robust(PAIR, "v"))


@query("normalize_rows", two("{c} / sqrt(l_quantity * l_quantity + l_extendedprice * l_extendedprice)"))
def normalize_rows(t: Tables) -> DataFrame:
    return scaled(t, ops.normalize_rows(PAIR, "v"))


@query("polynomial", f"""
select {LINE_SQL}, round(x, 6) as x, round(x * x, 6) as xx, round(y, 6) as y, round(x * y, 6) as xy, round(y * y, 6) as yy
from (select *, l_quantity as x, l_discount as y from lineitem)""")
def polynomial(t: Tables) -> DataFrame:
    rows = t("lineitem").select(*LINE_KEYS, "l_quantity", "l_discount")
    step = ops.polynomial(["l_quantity", "l_discount"], "v")
    vec = vector_to_array("v")
    return step.fit(rows).transform(rows).select(
        *LINE_KEYS, *[R(vec[i], 6).alias(n) for i, n in enumerate(["x", "xx", "y", "xy", "yy"])]
    )


TYPES = ["click", "error", "purchase", "signup", "view"]


@query("one_hot", "select event_id, " + ", ".join(
    f"cast(event_type = '{v}' as double) as is_{v}" for v in TYPES) + " from events")
def one_hot(t: Tables) -> DataFrame:
    rows = t("events").select("event_id", "event_type")
    vec = vector_to_array("v")
    return ops.one_hot("event_type", "v").fit(rows).transform(rows).select(
        "event_id", *[vec[i].alias(f"is_{v}") for i, v in enumerate(TYPES)]
    )


@query("ordinal_encode", """
with c as (select p_brand, cast(row_number() over (order by count(*) desc, p_brand) - 1 as double) as code from part group by p_brand)
select p_partkey, code from part join c using (p_brand)""")
def ordinal_encode(t: Tables) -> DataFrame:
    rows = t("part").select("p_partkey", "p_brand")
    return ops.ordinal_encode("p_brand", "code").fit(rows).transform(rows).drop("p_brand")


@query("target_encode", f"""
with s as (select p_partkey, p_brand, p_retailprice, {HASH_SQL.format('p_partkey')} % 10 as h from part),
m as (select p_brand, avg(p_retailprice) as code from s where h < 8 group by p_brand)
select p_partkey, round(coalesce(code, (select avg(p_retailprice) from s where h < 8)), 6) as code from s left join m using (p_brand)""")
def target_encode(t: Tables) -> DataFrame:
    """Fitted on the train split only, applied to every part."""
    parts = split_by_hash(t("part").select("p_partkey", "p_brand", "p_retailprice"), "p_partkey", {"train": 8, "test": 2})
    model = ops.target_encode("p_brand", "code", "p_retailprice").fit(parts.where("split = 'train'"))
    return model.transform(parts).select("p_partkey", R("code", 6).alias("code"))


@query("bin_fixed", """
select event_id, cast(case when value < 10 then 0 when value < 50 then 1 when value < 100 then 2 else 3 end as double) as bin
from events""")
def bin_fixed(t: Tables) -> DataFrame:
    step = ops.bin_fixed("value", "bin", [float("-inf"), 10.0, 50.0, 100.0, float("inf")])
    return step.transform(t("events").select("event_id", "value")).drop("value")


@query("bin_quantile", """
with q as (select quantile_cont(c_acctbal, 0.25) as a, quantile_cont(c_acctbal, 0.5) as b, quantile_cont(c_acctbal, 0.75) as c from customer)
select c_custkey, cast(case when c_acctbal < a then 0 when c_acctbal < b then 1 when c_acctbal < c then 2 else 3 end as double) as bin
from customer, q""")
def bin_quantile(t: Tables) -> DataFrame:
    rows = t("customer").select("c_custkey", "c_acctbal")
    return ops.bin_quantile("c_acctbal", "bin", 4).fit(rows).transform(rows).drop("c_acctbal")


TOKENS_SQL = r"""(select * from (select {keys}, unnest(regexp_split_to_array(lower("text"), '[^\pL]+')) as token from {table}) where token <> '')"""


@query("bag_of_words", f"select lang, token, count(*) as n from {TOKENS_SQL.format(keys='lang', table='documents')} group by all")
def bag_of_words(t: Tables) -> DataFrame:
    return ops.bag_of_words(t("documents"), "text", "lang")


@query("tfidf", f"""
with w as (select conv_id, turn, token, count(*) as tf from {TOKENS_SQL.format(keys='conv_id, turn', table='conversations')} group by all),
d as (select token, count(*) as df from w group by token),
n as (select count(*) as docs from (select distinct conv_id, turn from conversations))
select conv_id, turn, token, tf, round(tf * ln((docs + 1.0) / (df + 1.0)), 6) + 0.0 as tfidf from w join d using (token), n""")
def tfidf(t: Tables) -> DataFrame:
    return round_all(ops.tfidf(t("conversations"), "text", ["conv_id", "turn"]), 6, "tfidf")


@query("hash_features")
def hash_features(t: Tables) -> DataFrame:
    rows = t("events").select("event_id", "event_type", "value")
    vec = vector_to_array("v")
    total = F.aggregate(vec, F.lit(0.0), lambda s, x: s + x)
    return ops.hash_features(["event_type", "value"], "v", 64).transform(rows).select(
        "event_id", R(total, 6).alias("total"), F.size(F.filter(vec, lambda x: x != 0)).alias("filled")
    )


FOUR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("select_variance", " union all ".join(
    f"select '{c}' as feature, round(sum({c}), 2) as total, count(*) as n from lineitem having var_samp({c}) > 0.01" for c in FOUR))
def select_variance(t: Tables) -> DataFrame:
    """The kept columns with their totals, read from the selected vectors."""
    rows = t("lineitem").select(*FOUR)
    model = ops.select_variance(FOUR, "v", 0.01).fit(rows)
    return summed(model.transform(rows), ops.kept_columns(model, FOUR))


#: Count, mean and squared deviations of each class, and ANOVA's F of each measure.
ANOVA_SQL = "with y as (select *, l_returnflag = 'R' as y from lineitem), c as (" + " union all ".join(
    f"select '{c}' as feature, y, count(*) as c, avg({c}) as m, var_pop({c}) as v from y where {c} is not null group by y" for c in FOUR
) + """), g as (select feature, sum(c * m) / sum(c) as mean from c group by feature),
f as (select feature, sum(c * (m - mean) * (m - mean)) as b, sum(c * v) as w, count(*) - 1 as dof, cast(sum(c) as bigint) as n
  from c join g using (feature) group by feature)"""


@query("select_univariate_scores", ANOVA_SQL + """
select feature, round((b / dof) / (w / (n - dof - 1)), 6) as statistic, dof, n - dof - 1 as rest, n from f""")
def select_univariate_scores(t: Tables) -> DataFrame:
    """ANOVA's F of each measure between returned and other lines."""
    rows = t("lineitem").select(*FOUR, (F.col("l_returnflag") == "R").alias("returned"))
    return ops.univariate_scores(rows, FOUR, "returned").select("feature", R("statistic", 6).alias("statistic"), "dof", "rest", "n")


@query("select_univariate", ANOVA_SQL + ", best as (select feature from f order by (b / dof) / (w / (n - dof - 1)) desc limit 2) " + " union all ".join(
    f"select '{c}' as feature, round(sum({c}), 2) as total, count(*) as n from lineitem having '{c}' in (select feature from best)" for c in FOUR))
def select_univariate(t: Tables) -> DataFrame:
    """Which two measures tell returned lines best."""
    rows = t("lineitem").select(*FOUR, (F.col("l_returnflag") == "R").cast("int").alias("returned"))
    model = ops.select_univariate(FOUR, "v", "returned", 2).fit(rows)
    return summed(model.transform(rows), ops.kept_columns(model, FOUR))


def summed(rows: DataFrame, kept: list[str]) -> DataFrame:
    names = F.array(*[F.lit(c) for c in kept])
    cells = rows.select(F.explode(F.arrays_zip(names.alias("feature"), vector_to_array("v").alias("x"))).alias("c"))
    return cells.groupBy(F.col("c.feature").alias("feature")).agg(
        R(F.sum("c.x"), 2).alias("total"), F.count("*").alias("n")
    )


@query("pca")
def pca(t: Tables) -> DataFrame:
    rows = t("embeddings").select("vec_id", "embedding")
    parts = vector_to_array("v")
    return ops.pca("embedding", "v", 4).fit(rows).transform(rows).select(
        "vec_id", *[R(F.abs(parts[i]), 6).alias(f"pc{i + 1}") for i in range(4)]
    )


THREE = ["o_totalprice", "o_custkey", "o_orderkey"]


def ranked_sql(c: str) -> str:
    return f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0 as {c}"


@query("correlation", f"""
with r as (select {', '.join(ranked_sql(c) for c in THREE)} from orders) """ + " union all ".join(
    f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) + 0.0 as r from r" for a in THREE for b in THREE))
def spearman(t: Tables) -> DataFrame:
    return round_all(ops.correlation(t("orders"), THREE, "spearman"), 6, "r")


@query("correlation_pearson", " union all ".join(
    f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) + 0.0 as r from orders" for a in THREE for b in THREE))
def pearson(t: Tables) -> DataFrame:
    return round_all(ops.correlation(t("orders"), THREE, "pearson"), 6, "r")


@query("chi2_independence", """
with c as (select l_returnflag as a, l_linestatus as b, count(*) as n from lineitem group by all),
e as (select a, b, n, cast(sum(n) over (partition by a) as double) * sum(n) over (partition by b) / sum(n) over () as want from c)
select 'l_returnflag' as "column", round(sum((n - want) * (n - want) / want), 6) as statistic,
       cast((count(distinct a) - 1) * (count(distinct b) - 1) as integer) as dof from e""")
def chi2(t: Tables) -> DataFrame:
    test = ops.chi2_independence(t("lineitem"), ["l_returnflag"], "l_linestatus")
    return test.select("column", R("statistic", 6).alias("statistic"), "dof")
