"""Chart-ready summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from framewright.operators import charts as ops
from framewright.plans.common import R, round_all, second
from framewright.registry import Tables, query


@query("histogram_2d", """
with e as (select min(l_quantity) as xl, max(l_quantity) as xh, min(l_extendedprice) as yl, max(l_extendedprice) as yh from lineitem)
select least(cast(floor((l_quantity - xl) * 10 / (xh - xl)) as integer), 9) as bin_x,
       least(cast(floor((l_extendedprice - yl) * 8 / (yh - yl)) as integer), 7) as bin_y, count(*) as n
from lineitem, e group by 1, 2""")
def histogram_2d(t: Tables) -> DataFrame:
    return ops.histogram_2d(t("lineitem"), "l_quantity", "l_extendedprice", 10, 8)


@query("box_stats", """
with q as (select event_type, quantile_cont(value, 0.25) as q25, quantile_cont(value, 0.5) as q50, quantile_cont(value, 0.75) as q75
  from events group by event_type),
r as (select e.event_type, value, q25, q50, q75, value between q25 - 1.5 * (q75 - q25) and q75 + 1.5 * (q75 - q25) as inside
  from events e join q on e.event_type = q.event_type)
select event_type, round(max(q25), 6) as q25, round(max(q50), 6) as q50, round(max(q75), 6) as q75,
       min(case when inside then value end) as whisker_low, max(case when inside then value end) as whisker_high,
       cast(sum(case when inside then 0 else 1 end) as bigint) as outliers, count(*) as n
from r group by event_type""")
def box_stats(t: Tables) -> DataFrame:
    return round_all(ops.box_stats(t("events"), "value", "event_type"), 6, "q25", "q50", "q75")


@query("ecdf", """
select value, round(cast(sum(n) over (order by value) as double) / sum(n) over (), 8) as share
from (select value, count(*) as n from events group by value)""")
def ecdf(t: Tables) -> DataFrame:
    return round_all(ops.ecdf(t("events"), "value"), 8, "share")


POINTS = [0.0, 10.0, 20.0, 40.0, 60.0, 80.0, 120.0, 160.0, 240.0, 320.0]


@query("kde_grid", f"""
select x, round(avg(exp(-0.5 * ((value - x) / 8.0) * ((value - x) / 8.0))) / (8.0 * sqrt(2 * pi())), 10) as density
from events, (select unnest([{', '.join(map(str, POINTS))}]::double[]) as x) group by x""")
def kde_grid(t: Tables) -> DataFrame:
    return round_all(ops.kde_grid(t("events"), "value", POINTS, 8.0), 10, "density")


FOUR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("corr_heatmap", " union all ".join(
    f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) + 0.0 as r from lineitem" for a in FOUR for b in FOUR))
def corr_heatmap(t: Tables) -> DataFrame:
    return round_all(ops.corr_heatmap(t("lineitem"), FOUR), 6, "r")


@query("bar_ci", """
select event_type, count(value) as n, round(avg(value), 6) as mean,
       round(avg(value) - 1.96 * stddev_samp(value) / sqrt(count(value)), 6) as low,
       round(avg(value) + 1.96 * stddev_samp(value) / sqrt(count(value)), 6) as high
from events group by event_type""")
def bar_ci(t: Tables) -> DataFrame:
    return round_all(ops.bar_ci(t("events"), "value", "event_type"), 6, "mean", "low", "high")


@query("reg_line", """
with f as (select l_returnflag, regr_slope(l_extendedprice, l_quantity) as m, regr_intercept(l_extendedprice, l_quantity) as c,
  min(l_quantity) as lo, max(l_quantity) as hi from lineitem group by l_returnflag)
select l_returnflag, round(lo + (hi - lo) * i / 4.0, 6) as x, round(m * (lo + (hi - lo) * i / 4.0) + c, 4) as y
from f, (select unnest(range(5)) as i)""")
def reg_line(t: Tables) -> DataFrame:
    line = ops.reg_line(t("lineitem"), "l_quantity", "l_extendedprice", "l_returnflag", 5)
    return line.select("l_returnflag", R("x", 6).alias("x"), R("y", 4).alias("y"))


@query("line_series", """
with m as (select o_orderstatus, date_trunc('month', o_orderdate) as slot, count(*) as n, sum(o_totalprice) as total from orders group by all),
e as (select o_orderstatus, min(slot) as lo, max(slot) as hi from m group by o_orderstatus),
g as (select o_orderstatus, unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp), interval 1 month)) as slot from e)
select o_orderstatus, strftime(slot, '%Y-%m-%d %H:%M:%S') as slot, coalesce(n, 0) as n, round(total, 2) as total
from g left join m using (o_orderstatus, slot)""")
def line_series(t: Tables) -> DataFrame:
    out = ops.line_series(
        t("orders"), "o_orderdate", "month", [F.count("*").alias("n"), F.sum("o_totalprice").alias("total")], "o_orderstatus"
    )
    return out.select(
        "o_orderstatus", second("slot"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n"), R("total", 2).alias("total")
    )
