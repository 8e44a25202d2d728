"""Cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from framewright.operators import cleaning as ops
from framewright.plans.common import GAPS_SQL, R, day, round_all, with_gaps
from framewright.registry import Tables, query

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("profile", " union all ".join(f"""
select '{c}' as "column", count({c}) as "count", cast(count(*) - count({c}) as bigint) as nulls,
       count(distinct {c}) as "distinct", min({c}) as "min", max({c}) as "max", round(avg({c}), 8) as mean,
       round(stddev_samp({c}), 6) as std, round(quantile_cont({c}, 0.25), 6) as q25,
       round(quantile_cont({c}, 0.5), 6) as q50, round(quantile_cont({c}, 0.75), 6) as q75
from lineitem""" for c in MEASURES))
def profile(t: Tables) -> DataFrame:
    out = ops.profile(t("lineitem"), MEASURES)
    # means of cents over 6·10^n rows never end in a half at eight digits
    return round_all(round_all(out, 8, "mean"), 6, "std", "q25", "q50", "q75")


# half of the property texts are cut down to their number, the others stay JSON
RAW_SQL = """(select event_id, case when cast(props->>'$.k' as integer) < 50 then props->>'$.k' else props end as k from events)"""


def raw_numbers(t: Tables) -> DataFrame:
    number = F.get_json_object("props", "$.k")
    return t("events").select(
        "event_id", F.when(number.cast("int") < 50, number).otherwise(F.col("props")).alias("k")
    )


@query("coerce", f"select event_id, try_cast(k as double) as k from {RAW_SQL}")
def coerce(t: Tables) -> DataFrame:
    return ops.coerce(raw_numbers(t), {"k": "double"})[0]


@query("coerce_rejects", f"""
select event_id, 'k' as "column", k as "text", 'int' as wanted from {RAW_SQL} where try_cast(k as integer) is null""")
def coerce_rejects(t: Tables) -> DataFrame:
    return ops.coerce(raw_numbers(t), {"k": "int"})[1]


@query("clean_text", r"""
select page_id, regexp_extract(regexp_replace(trim(lower(url)), '[?#].*$', ''), '^https?://([^/]+)', 1) as host
from pages""")
def clean_text(t: Tables) -> DataFrame:
    rules = [("lower",), ("trim",), ("replace", r"[?#].*$", ""), ("extract", r"^https?://([^/]+)", 1)]
    return ops.clean_text(t("pages").select("page_id", "url"), "url", rules, "host").drop("url")


@query("clean_text_documents", r"""
select doc_id, md5(trim(regexp_replace(lower("text"), '[^\pL]+', ' ', 'g'))) as fingerprint from documents""")
def clean_documents(t: Tables) -> DataFrame:
    rules = [("lower",), ("replace", r"[^\p{L}]+", " "), ("trim",)]
    cleaned = ops.clean_text(t("documents").select("doc_id", "text"), "text", rules)
    return cleaned.select("doc_id", F.md5(F.col("text").cast("binary")).alias("fingerprint"))


ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
         "l_returnflag", "l_linestatus"]


@query("drop_duplicates", f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
       l_linestatus, strftime(l_shipdate, '%Y-%m-%d') as l_shipdate
from (select *, row_number() over (partition by l_orderkey, l_linenumber order by {', '.join(ORDER)}) as rn from lineitem)
where rn = 1""")
def drop_duplicates(t: Tables) -> DataFrame:
    kept = ops.drop_duplicates(t("lineitem"), ["l_orderkey", "l_linenumber"], ORDER)
    return kept.withColumn("l_shipdate", day("l_shipdate"))


def imputed(t: Tables, **how) -> DataFrame:
    return round_all(ops.impute(with_gaps(t), "value", **how), 6, "value").select("event_id", "value")


@query("impute", f"""
select event_id, round(coalesce(value, avg(value) over (partition by event_type)), 6) as value from {GAPS_SQL}""")
def impute_mean(t: Tables) -> DataFrame:
    return imputed(t, how="mean", by="event_type")


@query("impute_median", f"""
with g as {GAPS_SQL}, m as (select user_id, quantile_cont(value, 0.5) as fill from g group by user_id)
select event_id, round(coalesce(value, fill), 6) as value from g join m using (user_id)""")
def impute_median(t: Tables) -> DataFrame:
    return imputed(t, how="median", by="user_id")


@query("impute_mode", f"""
with g as {GAPS_SQL}, c as (select event_type, value, count(*) as n from g where value is not null group by all),
m as (select event_type, value as fill from (
  select *, row_number() over (partition by event_type order by n desc, value) as rn from c) where rn = 1)
select event_id, round(coalesce(value, fill), 6) as value from g join m using (event_type)""")
def impute_mode(t: Tables) -> DataFrame:
    return imputed(t, how="mode", by="event_type")


@query("impute_constant", f"select event_id, round(coalesce(value, -1.0), 6) as value from {GAPS_SQL}")
def impute_constant(t: Tables) -> DataFrame:
    return imputed(t, how="constant", value=-1.0)


@query("ffill", f"""
select event_id, last_value(value ignore nulls) over (partition by user_id order by ts
  rows between unbounded preceding and current row) as value from {GAPS_SQL}""")
def ffill(t: Tables) -> DataFrame:
    return ops.ffill(with_gaps(t), "value", "user_id", "ts").select("event_id", "value")


@query("bfill", f"""
select event_id, first_value(value ignore nulls) over (partition by user_id order by ts
  rows between current row and unbounded following) as value from {GAPS_SQL}""")
def bfill(t: Tables) -> DataFrame:
    return ops.bfill(with_gaps(t), "value", "user_id", "ts").select("event_id", "value")


@query("interpolate", f"""
with g as (select *, epoch_us(ts) as t, case when value is not null then epoch_us(ts) end as kt from {GAPS_SQL}),
n as (select *, last_value(value ignore nulls) over b as pv, last_value(kt ignore nulls) over b as pt,
             first_value(value ignore nulls) over f as nv, first_value(kt ignore nulls) over f as nt from g
  window b as (partition by user_id order by ts rows between unbounded preceding and current row),
         f as (partition by user_id order by ts rows between current row and unbounded following))
select event_id, round(coalesce(value, pv + (nv - pv) * (t - pt) / nullif(nt - pt, 0)), 6) + 0.0 as value from n""")
def interpolate(t: Tables) -> DataFrame:
    filled = ops.interpolate(with_gaps(t), "value", "user_id", "ts")
    return filled.select("event_id", R("value", 6).alias("value"))


@query("outliers_iqr", """
with q as (select event_type, quantile_cont(value, 0.25) as a, quantile_cont(value, 0.75) as b from events group by event_type)
select event_id, event_type, value, round(a - 1.5 * (b - a), 6) as low, round(b + 1.5 * (b - a), 6) as high
from events join q using (event_type) where value < a - 1.5 * (b - a) or value > b + 1.5 * (b - a)""")
def outliers_iqr(t: Tables) -> DataFrame:
    found = ops.outliers_iqr(t("events"), "value", "event_type")
    return round_all(found.select("event_id", "event_type", "value", "low", "high"), 6, "low", "high")


@query("zscore", """
select event_id, round((value - avg(value) over w) / nullif(stddev_samp(value) over w, 0), 6) + 0.0 as z
from events window w as (partition by event_type)""")
def zscore(t: Tables) -> DataFrame:
    return ops.zscore(t("events"), "value", "event_type").select("event_id", R("z", 6).alias("z"))


@query("winsorize", """
select event_id, round(least(greatest(value, (select quantile_cont(value, 0.05) from events)),
                       (select quantile_cont(value, 0.95) from events)), 6) as value from events""")
def winsorize(t: Tables) -> DataFrame:
    clipped = ops.winsorize(t("events").select("event_id", "value"), "value", 0.05, 0.95)
    return round_all(clipped, 6, "value")
