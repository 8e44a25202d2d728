"""Registry that feeds ``queries()`` and ``oracle_sql()``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Tables:
    """The Parquet tables below one folder; ``t("orders")`` reads one of them."""

    spark: SparkSession
    path: str

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path.rstrip('/')}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the same result in DuckDB, where SQL can say it."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name!r} is registered twice")
        REGISTRY[name] = Query(build, sql)
        return build

    return add
