"""Joining, stacking, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from framewright.operators import joining as ops
from framewright.registry import Tables, query


@query("select_filter", """
select l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) as net from lineitem
where l_quantity < 24 and l_shipdate >= timestamp '1995-01-01'""")
def select_filter(t: Tables) -> DataFrame:
    return ops.select_filter(
        t("lineitem"),
        ["l_orderkey", "l_linenumber", "round(l_extendedprice * (1 - l_discount), 4) as net"],
        "l_quantity < 24 and l_shipdate >= timestamp_ntz'1995-01-01'",
    )


@query("merge", """
select coalesce(c_custkey, s_suppkey) as key, c_name, s_name from customer full join supplier on c_custkey = s_suppkey""")
def merge_outer(t: Tables) -> DataFrame:
    left = t("customer").select(F.col("c_custkey").alias("key"), "c_name")
    right = t("supplier").select(F.col("s_suppkey").alias("key"), "s_name")
    return ops.merge(left, right, "key", "outer")


@query("merge_inner", """
select l_orderkey, l_linenumber, l_partkey, o_custkey, o_orderstatus, n_name
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey""")
def merge_inner(t: Tables) -> DataFrame:
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
    customers = t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nations = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    homes = ops.merge(customers, nations, "c_nationkey")
    out = ops.merge(ops.merge(lines, orders, "l_orderkey"), homes, "o_custkey")
    return out.drop("c_nationkey")


@query("merge_salted", """
select event_type, event_id, segment from events left join (
  select event_type, cast(count(*) as bigint) as segment from events group by event_type) using (event_type)""")
def merge_salted(t: Tables) -> DataFrame:
    sizes = t("events").groupBy("event_type").agg(F.count("*").alias("segment"))
    return ops.merge(t("events").select("event_type", "event_id"), sizes, "event_type", "left", salt=8)


LARGE_SQL = "select o_custkey from orders where o_totalprice > 400000"


def large_buyers(t: Tables) -> DataFrame:
    return t("orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))


@query("merge_semi_anti", f"select c_custkey, c_name from customer where c_custkey in ({LARGE_SQL})")
def merge_semi(t: Tables) -> DataFrame:
    return ops.merge_semi_anti(t("customer").select("c_custkey", "c_name"), large_buyers(t), "c_custkey", "semi")


@query("merge_anti", f"select c_custkey, c_name from customer where c_custkey not in ({LARGE_SQL})")
def merge_anti(t: Tables) -> DataFrame:
    return ops.merge_semi_anti(t("customer").select("c_custkey", "c_name"), large_buyers(t), "c_custkey", "anti")


@query("merge_where", """
select c_custkey, s_suppkey, c_acctbal, s_acctbal from customer join supplier
on c_acctbal >= s_acctbal - 20 and c_acctbal <= s_acctbal + 20""")
def merge_where(t: Tables) -> DataFrame:
    spans = t("supplier").select(
        "s_suppkey", "s_acctbal", (F.col("s_acctbal") - 20).alias("low"), (F.col("s_acctbal") + 20).alias("high")
    )
    found = ops.merge_where(t("customer").select("c_custkey", "c_acctbal"), spans, "c_acctbal", "low", "high")
    return found.select("c_custkey", "s_suppkey", "c_acctbal", "s_acctbal")


@query("merge_where_open", """
select c_custkey, s_suppkey from customer join supplier
on c_acctbal >= s_acctbal - 20 and (s_suppkey % 10 = 0 or c_acctbal <= s_acctbal + 20)""")
def merge_where_open(t: Tables) -> DataFrame:
    """Every tenth interval has no upper end."""
    high = F.when(F.col("s_suppkey") % 10 == 0, F.lit(float("inf"))).otherwise(F.col("s_acctbal") + 20)
    spans = t("supplier").select("s_suppkey", (F.col("s_acctbal") - 20).alias("low"), high.alias("high"))
    found = ops.merge_where(t("customer").select("c_custkey", "c_acctbal"), spans, "c_acctbal", "low", "high")
    return found.select("c_custkey", "s_suppkey")


ASOF_SQL = """
with p as (select * from events where event_type = 'purchase'), c as (select * from events where event_type = 'click')
"""


def purchases_and_clicks(t: Tables) -> tuple[DataFrame, DataFrame]:
    events = t("events").select("event_id", "ts", "user_id", "event_type", "value")
    purchases = events.where("event_type = 'purchase'").select("event_id", "ts", "user_id")
    clicks = events.where("event_type = 'click'").select("ts", "user_id", F.col("event_id").alias("click_id"), "value")
    return purchases, clicks


@query("merge_asof", ASOF_SQL + """
select p.event_id, cast(c.event_id as double) as click_id, c.value from p asof left join c on p.user_id = c.user_id and p.ts >= c.ts""")
def merge_asof(t: Tables) -> DataFrame:
    return ops.merge_asof(*purchases_and_clicks(t), "ts", "user_id").select("event_id", F.col("click_id").cast("double"), "value")


@query("merge_asof_forward", ASOF_SQL + """
select event_id, cast(case when gap <= 21600000000 then click_id end as double) as click_id from (
  select p.event_id, c.event_id as click_id, epoch_us(c.ts) - epoch_us(p.ts) as gap
  from p asof left join c on p.user_id = c.user_id and p.ts <= c.ts)""")
def merge_asof_forward(t: Tables) -> DataFrame:
    found = ops.merge_asof(*purchases_and_clicks(t), "ts", "user_id", "forward", tolerance=6 * 3600)
    return found.select("event_id", F.col("click_id").cast("double"))


@query("merge_asof_nearest", ASOF_SQL + """
, b as (select p.event_id, p.ts, c.event_id as bid, c.ts as bts from p asof left join c on p.user_id = c.user_id and p.ts >= c.ts)
, f as (select p.event_id, c.event_id as fid, c.ts as fts from p asof left join c on p.user_id = c.user_id and p.ts <= c.ts)
select event_id, cast(case when bid is null then fid when fid is null then bid
  when epoch_us(fts) - epoch_us(ts) < epoch_us(ts) - epoch_us(bts) then fid else bid end as double) as click_id
from b join f using (event_id)""")
def merge_asof_nearest(t: Tables) -> DataFrame:
    return ops.merge_asof(*purchases_and_clicks(t), "ts", "user_id", "nearest").select("event_id", F.col("click_id").cast("double"))


@query("concat", """
select c_custkey as id, c_name as name, c_mktsegment as segment, c_acctbal as balance from customer
union all select s_suppkey, s_name, null, s_acctbal from supplier""")
def concat(t: Tables) -> DataFrame:
    customers = t("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    suppliers = t("supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    return ops.concat([customers, suppliers])


def nation_keys(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Nations of all customers and of all suppliers, with repeats."""
    return (
        t("customer").select(F.col("c_nationkey").alias("key")),
        t("supplier").select(F.col("s_nationkey").alias("key")),
    )


def add_set_operation(op: str, sql: str) -> None:
    @query("set_ops" if op == "union" else f"set_ops_{op}", f"""
select c_nationkey as key from customer {sql} select s_nationkey from supplier""")
    def run(t: Tables) -> DataFrame:
        return ops.set_ops(*nation_keys(t), op)


for op in ("union", "union_all", "intersect", "intersect_all", "except", "except_all"):
    add_set_operation(op, op.replace("_", " "))
