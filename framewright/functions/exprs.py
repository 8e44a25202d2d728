"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def names(cols: str | Iterable[str] | None) -> list[str]:
    """One name, several names or nothing, as a list."""
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def columns(cols: str | Column | Sequence[str | Column]) -> list[Column]:
    """Names and expressions (``F.col("x").desc()``) as a list of columns."""
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def rounded(col: str | Column, digits: int) -> Column:
    """Round, and turn a negative zero into zero."""
    col = F.col(col) if isinstance(col, str) else col
    return F.round(col, digits) + F.lit(0.0)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a ``timestamp_ntz``, whatever the session zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.timestamp_diff("MICROSECOND", epoch, ts)


def join_on(left: DataFrame, right: DataFrame, by: str | Iterable[str], how: str = "left") -> DataFrame:
    """Join a table with one row per key back to its rows; NULL keys match NULL.

    No broadcast hint: a table of group statistics grows with the number of
    groups, so its measured size decides, and AQE splits a hot key on the left.
    """
    by = names(by)
    renamed = right.select(
        *[F.col(c).alias(f"__key_{c}") if c in by else F.col(c) for c in right.columns]
    )
    cond = all_of(F.col(c).eqNullSafe(F.col(f"__key_{c}")) for c in by)
    return left.join(renamed, cond, how).drop(*[f"__key_{c}" for c in by])


def attach(df: DataFrame, stats: DataFrame, by: str | Iterable[str] | None) -> DataFrame:
    """Add group statistics to rows. Without ``by`` the statistics are a single
    row and become scalar subqueries, so no cross join is needed."""
    by = names(by)
    if by:
        return join_on(df, stats, by)
    values = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    return df.withColumns({c: values.getField(c) for c in stats.columns})


def finite(col: str | Column) -> Column:
    """NaN counts as missing: NULL instead."""
    col = F.col(col) if isinstance(col, str) else col
    return F.nanvl(col, F.lit(None).cast("double"))
