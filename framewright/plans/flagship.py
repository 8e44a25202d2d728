"""Customer features: join, aggregate, impute and scale."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from framewright.operators.cleaning import impute
from framewright.operators.features import scale_standard
from framewright.operators.grouping import groupby_agg
from framewright.operators.joining import merge
from framewright.plans.common import R, day
from framewright.registry import Tables, query


@query("customer_features", """
with o as (
  select o_custkey, count(*) as n_orders, sum(o_totalprice) as spent, avg(o_totalprice) as mean_price,
         max(o_orderdate) as last_order
  from orders group by o_custkey),
f as (
  select c_custkey, c_mktsegment, coalesce(n_orders, 0) as n_orders, coalesce(spent, 0) as spent,
         coalesce(mean_price, (select avg(mean_price) from o join customer on c_custkey = o_custkey)) as mean_price, last_order
  from customer left join o on c_custkey = o_custkey)
select c_custkey, c_mktsegment, cast(n_orders as bigint) as n_orders, round(spent, 2) + 0.0 as spent,
       round(mean_price, 6) + 0.0 as mean_price, strftime(last_order, '%Y-%m-%d') as last_order,
       round((n_orders - (select avg(n_orders) from f)) / (select stddev_samp(n_orders) from f), 6) + 0.0 as z_orders,
       round((spent - (select avg(spent) from f)) / (select stddev_samp(spent) from f), 6) + 0.0 as z_spent
from f""")
def customer_features(t: Tables) -> DataFrame:
    """Orders are aggregated before the join, so the join moves one row per customer."""
    per_customer = groupby_agg(t("orders"), "o_custkey", {
        "n_orders": ("size", "o_orderkey"),
        "spent": ("sum", "o_totalprice"),
        "mean_price": ("mean", "o_totalprice"),
        "last_order": ("max", "o_orderdate"),
    }).withColumnRenamed("o_custkey", "c_custkey")
    rows = merge(t("customer").select("c_custkey", "c_mktsegment"), per_customer, "c_custkey", "left")
    rows = impute(rows, "n_orders", "constant", value=0)
    rows = impute(rows, "spent", "constant", value=0.0)
    rows = impute(rows, "mean_price", "mean")
    z = vector_to_array("z")
    return scale_standard(["n_orders", "spent"], "z").fit(rows).transform(rows).select(
        "c_custkey", "c_mktsegment", "n_orders", R("spent", 2).alias("spent"),
        R("mean_price", 6).alias("mean_price"), day("last_order"),
        R(z[0], 6).alias("z_orders"), R(z[1], 6).alias("z_spent"),
    )
