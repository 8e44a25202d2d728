"""Time series and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from framewright.operators import timeseries as ops
from framewright.plans.common import GAPS_SQL, R, round_all, second, with_gaps
from framewright.registry import Tables, query

RANKS = {
    "average": "rank() over w + (count(*) over (partition by event_type, value) - 1) / 2.0",
    "min": "rank() over w",
    "max": "rank() over w + count(*) over (partition by event_type, value) - 1",
    "dense": "dense_rank() over w",
    "first": "row_number() over (partition by event_type order by value, event_id)",
}


def add_rank(method: str, sql: str) -> None:
    @query("rank_by" if method == "average" else f"rank_by_{method}", f"""
select event_id, cast({sql} as double) as "rank" from events window w as (partition by event_type order by value)""")
    def run(t: Tables) -> DataFrame:
        events = t("events").select("event_id", "event_type", "value")
        return ops.rank_by(events, "event_type", "value", method, ["event_id"]).select("event_id", "rank")


for method, sql in RANKS.items():
    add_rank(method, sql)


@query("shift_diff", """
select event_id, lag(value) over w as lag, round(value - lag(value) over w, 6) + 0.0 as diff,
       round((value - lag(value) over w) / nullif(lag(value) over w, 0), 6) + 0.0 as pct_change
from events window w as (partition by user_id order by ts)""")
def shift_diff(t: Tables) -> DataFrame:
    out = ops.shift_diff(t("events"), "user_id", "ts", "value")
    return round_all(out.select("event_id", "lag", "diff", "pct_change"), 6, "diff", "pct_change")


@query("cumulative", """
select event_id, round(sum(value) over w, 6) as cumsum, max(value) over w as cummax, min(value) over w as cummin
from events window w as (partition by user_id order by ts rows unbounded preceding)""")
def cumulative(t: Tables) -> DataFrame:
    out = ops.cumulative(t("events"), "user_id", "ts", "value")
    return out.select("event_id", R("cumsum", 6).alias("cumsum"), "cummax", "cummin")


@query("rolling_rows", """
select event_id, round(avg(value) over (partition by user_id order by ts rows between 4 preceding and current row), 6) as rolling
from events""")
def rolling_rows(t: Tables) -> DataFrame:
    out = ops.rolling_rows(t("events"), "user_id", "ts", "value", 5)
    return out.select("event_id", R("rolling", 6).alias("rolling"))


@query("rolling_time", """
select event_id, round(sum(value) over (partition by user_id order by ts
  range between interval 1 day preceding and current row), 6) as rolling from events""")
def rolling_time(t: Tables) -> DataFrame:
    out = ops.rolling_time(t("events"), "user_id", "ts", "value", 86_400, "sum")
    return out.select("event_id", R("rolling", 6).alias("rolling"))


@query("ewm_mean", f"""
select event_id, round(list_reduce(list(value) filter (where value is not null) over (partition by user_id order by ts
  rows between unbounded preceding and current row), lambda a, x: a * 2 / 3 + x / 3), 6) as ewm
from {GAPS_SQL}""")
def ewm_mean(t: Tables) -> DataFrame:
    # a span of 5 rows; thirds of cents never end in a half when rounded
    out = ops.ewm_mean(with_gaps(t), "user_id", "ts", "value", 1 / 3)
    return out.select("event_id", R("ewm", 6).alias("ewm"))


@query("ewm_mean_slow", """
with e as (select event_id, value, row_number() over (order by ts, event_id) - 1 as i from events)
select event_id, round(sum(case when i = 0 then value else value * 1e-6 end * pow(1 - 1e-6, -i)) over (order by i) * pow(1 - 1e-6, i), 6) as ewm from e""")
def ewm_mean_slow(t: Tables) -> DataFrame:
    out = ops.ewm_mean(t("events"), [], ["ts", "event_id"], "value", 1e-6)
    return out.select("event_id", R("ewm", 6).alias("ewm"))


@query("rolling_rows_long", """
select event_id, round(stddev_samp(value) over (partition by event_type order by ts, event_id rows between 1999 preceding and current row), 6) as rolling
from events""")
def rolling_rows_long(t: Tables) -> DataFrame:
    out = ops.rolling_rows(t("events"), "event_type", ["ts", "event_id"], "value", 2000, "std")
    return out.select("event_id", R("rolling", 6).alias("rolling"))


@query("rolling_time_std", """
with e as (select event_id, event_type, value, case when event_id % 11 <> 0 then ts end as ts from events)
select event_id, round(case when ts is null then stddev_samp(value) over (partition by event_type, ts is null)
  else stddev_samp(value) over (partition by event_type order by ts range between interval 10 day preceding and current row) end, 6) as rolling from e""")
def rolling_time_std(t: Tables) -> DataFrame:
    events = t("events").withColumn("ts", F.when(F.col("event_id") % 11 != 0, F.col("ts")))
    out = ops.rolling_time(events, "event_type", "ts", "value", 864_000, "std")
    return out.select("event_id", R("rolling", 6).alias("rolling"))


@query("resample_quarter", """
select strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') as slot, count(*) as n from orders group by 1""")
def resample_quarter(t: Tables) -> DataFrame:
    out = ops.resample(t("orders"), "o_orderdate", "quarter", [F.count("*").alias("n")])
    return out.select(F.date_format("slot", "yyyy-MM-dd").alias("slot"), "n")


@query("resample", """
with h as (select date_trunc('hour', ts) as slot, count(*) as n, round(sum(value), 6) as total from events group by 1),
grid as (select unnest(generate_series(min(slot), max(slot), interval 1 hour)) as slot from h)
select strftime(slot, '%Y-%m-%d %H:%M:%S') as slot, coalesce(n, 0) as n, total from grid left join h using (slot)""")
def resample(t: Tables) -> DataFrame:
    out = ops.resample(t("events"), "ts", "hour", [F.count("*").alias("n"), F.sum("value").alias("total")])
    return out.select(
        second("slot"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n"), R("total", 6).alias("total")
    )


@query("date_parts", """
select o_orderkey, cast(year(o_orderdate) as integer) as year, cast(quarter(o_orderdate) as integer) as quarter,
       cast(month(o_orderdate) as integer) as month, cast(day(o_orderdate) as integer) as day,
       cast(isodow(o_orderdate) - 1 as integer) as weekday, cast(week(o_orderdate) as integer) as week,
       cast(dayofyear(o_orderdate) as integer) as dayofyear from orders""")
def date_parts(t: Tables) -> DataFrame:
    return ops.date_parts(t("orders").select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")
