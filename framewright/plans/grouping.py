"""Grouping, reshaping, splits and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from framewright.operators import grouping as ops
from framewright.plans.common import R, round_all
from framewright.registry import Tables, query


@query("groupby_agg", """
select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as sum_qty, round(avg(l_extendedprice), 4) as mean_price,
       round(stddev_samp(l_extendedprice), 4) as std_price, count(distinct l_partkey) as parts,
       min(l_discount) as min_discount, max(l_tax) as max_tax, round(quantile_cont(l_extendedprice, 0.9), 4) as p90,
       round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, count(*) as n
from lineitem group by l_returnflag, l_linestatus""")
def groupby_agg(t: Tables) -> DataFrame:
    out = ops.groupby_agg(t("lineitem"), ["l_returnflag", "l_linestatus"], {
        "sum_qty": ("sum", "l_quantity"),
        "mean_price": ("mean", "l_extendedprice"),
        "std_price": ("std", "l_extendedprice"),
        "parts": ("nunique", "l_partkey"),
        "min_discount": ("min", "l_discount"),
        "max_tax": ("max", "l_tax"),
        "p90": ("quantile", "l_extendedprice", 0.9),
        "revenue": F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))),
        "n": ("size", "l_orderkey"),
    })
    out = round_all(out, 2, "sum_qty", "revenue")
    return round_all(out, 4, "mean_price", "std_price", "p90")


@query("groupby_argmax", """
select o_custkey, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) as top_order, max(o_totalprice) as top_price
from orders group by o_custkey""")
def groupby_argmax(t: Tables) -> DataFrame:
    return ops.groupby_agg(t("orders"), "o_custkey", {
        "top_order": ("argmax", "o_orderkey", "o_totalprice"), "top_price": ("max", "o_totalprice"),
    })


SUBTOTALS_SQL = """
select l_returnflag, l_linestatus, grouping(l_returnflag, l_linestatus) as level, count(*) as n,
       round(sum(l_quantity), 2) as qty
from lineitem group by {}"""


def subtotalled(t: Tables, how: str, sets=None) -> DataFrame:
    aggs = [F.count("*").alias("n"), R(F.sum("l_quantity"), 2).alias("qty")]
    return ops.subtotals(t("lineitem"), ["l_returnflag", "l_linestatus"], aggs, how, sets)


@query("subtotals", SUBTOTALS_SQL.format("cube (l_returnflag, l_linestatus)"))
def cube(t: Tables) -> DataFrame:
    return subtotalled(t, "cube")


@query("subtotals_rollup", SUBTOTALS_SQL.format("rollup (l_returnflag, l_linestatus)"))
def rollup(t: Tables) -> DataFrame:
    return subtotalled(t, "rollup")


@query("subtotals_sets", SUBTOTALS_SQL.format("grouping sets ((l_returnflag), (l_linestatus), ())"))
def grouping_sets(t: Tables) -> DataFrame:
    return subtotalled(t, "sets", [["l_returnflag"], ["l_linestatus"], []])


TYPES = ["click", "error", "purchase", "signup", "view"]


@query("pivot_table", "select user_id, " + ", ".join(
    f"round(sum(case when event_type = '{v}' then value end), 4) as {v}" for v in TYPES) + " from events group by user_id")
def pivot_table(t: Tables) -> DataFrame:
    wide = ops.pivot_table(t("events"), "user_id", "event_type", TYPES, F.sum("value"))
    return round_all(wide, 4, *TYPES)


@query("melt", """
select p_partkey, 'p_size' as variable, cast(p_size as double) as value from part
union all select p_partkey, 'p_retailprice', p_retailprice from part""")
def melt(t: Tables) -> DataFrame:
    parts = t("part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return ops.melt(parts, ["p_partkey"], ["p_size", "p_retailprice"])


@query("crosstab", """
select l_returnflag, l_linestatus, count(*) as n,
       round(cast(count(*) as double) / sum(count(*)) over (partition by l_returnflag), 8) as share
from lineitem group by l_returnflag, l_linestatus""")
def crosstab(t: Tables) -> DataFrame:
    return round_all(ops.crosstab(t("lineitem"), "l_returnflag", "l_linestatus", normalize=True), 8, "share")


@query("value_counts", "select event_type, count(*) as n from events group by event_type")
def value_counts(t: Tables) -> DataFrame:
    return ops.value_counts(t("events"), "event_type")


@query("nlargest", """
select o_custkey, o_orderkey, o_totalprice from (
  select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn from orders) where rn <= 3""")
def nlargest(t: Tables) -> DataFrame:
    orders = t("orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return ops.nlargest(orders, "o_custkey", [F.col("o_totalprice").desc(), "o_orderkey"], 3)


@query("nlargest_overall", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def nlargest_overall(t: Tables) -> DataFrame:
    orders = t("orders").select("o_orderkey", "o_totalprice")
    return ops.nlargest(orders, None, [F.col("o_totalprice").desc(), "o_orderkey"], 10)


HASH_SQL = "cast('0x' || substr(md5(cast({} as varchar)), 1, 8) as bigint)"


@query("split_by_hash", f"""
select c_custkey, case when h < 8 then 'train' when h < 9 then 'valid' else 'test' end as split
from (select c_custkey, {HASH_SQL.format('c_custkey')} % 10 as h from customer)""")
def split_by_hash(t: Tables) -> DataFrame:
    return ops.split_by_hash(t("customer").select("c_custkey"), "c_custkey", {"train": 8, "valid": 1, "test": 1})


@query("sample_stratified", f"""
select doc_id, quality from (
  select *, row_number() over (partition by quality order by {HASH_SQL.format('doc_id')}, doc_id) as rn,
         count(*) over (partition by quality) as size from labels)
where rn <= ceil(0.2 * size)""")
def sample_stratified(t: Tables) -> DataFrame:
    return ops.sample_stratified(t("labels").select("doc_id", "quality"), "doc_id", "quality", 0.2)
