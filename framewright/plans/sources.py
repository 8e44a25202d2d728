"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from framewright.plans.common import day
from framewright.registry import Tables, query
from framewright.session import new_path
from framewright.sources.tables import flatten_json, read_table, write_table

ORDERS_SQL = """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') as o_orderdate,
       o_orderpriority
from orders"""

ORDERS = """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
            o_orderdate timestamp_ntz, o_orderpriority string"""


def round_trip(t: Tables, fmt: str) -> DataFrame:
    path = new_path(t.spark, f"orders-{fmt}")
    write_table(t("orders"), path, fmt)
    back = read_table(t.spark, path, fmt, ORDERS)
    return back.withColumn("o_orderdate", day("o_orderdate"))


@query("read_table", ORDERS_SQL)
def read_csv(t: Tables) -> DataFrame:
    return round_trip(t, "csv")


@query("read_table_json", ORDERS_SQL)
def read_json(t: Tables) -> DataFrame:
    return round_trip(t, "json")


@query("read_table_orc", ORDERS_SQL)
def read_orc(t: Tables) -> DataFrame:
    return round_trip(t, "orc")


@query("read_table_parquet", ORDERS_SQL)
def read_parquet(t: Tables) -> DataFrame:
    return round_trip(t, "parquet")


@query("write_table", ORDERS_SQL)
def write_partitioned(t: Tables) -> DataFrame:
    path = new_path(t.spark, "orders-by-status")
    write_table(t("orders"), path, keys="o_orderstatus")
    back = read_table(t.spark, path, "parquet", ORDERS)
    return back.withColumn("o_orderdate", day("o_orderdate"))


@query("flatten_json", "select event_id, cast(props->>'$.k' as integer) as k from events")
def flatten(t: Tables) -> DataFrame:
    return flatten_json(t("events").select("event_id", "props"), "props", "k int")
