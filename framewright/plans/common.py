"""Derived inputs shared by several queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from framewright.functions.exprs import rounded as R
from framewright.registry import Tables

GAPS_SQL = "(select event_id, ts, user_id, event_type, case when event_id % 7 = 0 then null else value end as value from events)"
SCORED_SQL = "(select doc_id, lang, quality, n_chars, case when n_chars > 1000 then 1 else 0 end as predicted from labels join documents using (doc_id))"

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def with_gaps(t: Tables) -> DataFrame:
    """Events where every seventh value is missing; the given tables have no NULLs."""
    return t("events").withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value"))).drop("props")


def scored(t: Tables) -> DataFrame:
    """Labelled documents: quality as truth, length as score, longer than 1000 as prediction."""
    documents = t("documents").select("doc_id", "lang", "n_chars")
    return t("labels").join(documents, "doc_id").select(
        "doc_id", "lang", "quality", "n_chars", (F.col("n_chars") > 1000).cast("int").alias("predicted")
    )


def day(c: str, name: str | None = None) -> Column:
    return F.date_format(c, "yyyy-MM-dd").alias(name or c)


def second(c: str, name: str | None = None) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(name or c)


def round_all(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: R(c, digits) for c in cols})
