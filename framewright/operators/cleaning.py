"""Cleaning: profiles, typing, text, duplicates, missing values, outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from framewright.functions.exprs import attach, columns, finite, join_on, micros, names
from framewright.operators.ordered import SPLIT_ROWS, attach_split, hot_keys, quantile_table, scan


def profile(
    df: DataFrame, cols: Sequence[str], exact: bool = True, split_rows: int | None = SPLIT_ROWS
) -> DataFrame:
    """One row per numeric column: count, nulls, distinct, min, max, mean, std, quartiles
    (no rows for an empty table).

    Plain statistics take one pass without a shuffle. For the exact form the columns
    are unpivoted and one count per (column, value) feeds both the distinct count and the
    quartiles; ``exact=False`` uses sketches and stays with the single pass.
    """
    simple = {
        "count": F.count,
        "nulls": lambda c: F.count("*") - F.count(c),
        "min": F.min,
        "max": F.max,
        "mean": F.avg,
        "std": F.stddev_samp,
    }
    if not exact:
        simple["distinct"] = lambda c: F.approx_count_distinct(c, 0.02)
        for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
            simple[name] = lambda c, p=p: F.percentile_approx(c, p, 10_000)
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    wide = typed.agg(*[F.struct(*[f(c).alias(n) for n, f in simple.items()]).alias(c) for c in cols])
    basics = wide.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}.*")) for c in cols])).alias("s")
    ).select("s.*").where(F.col("count") + F.col("nulls") > 0)
    if not exact:
        return basics
    quartiles = quantile_table(
        typed.unpivot([], list(cols), "column", "value"), "value", [0.25, 0.5, 0.75], "column", split_rows
    ).select("column", "distinct", F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75"))
    return join_on(basics, quartiles, "column").withColumn(
        "distinct", F.coalesce("distinct", F.lit(0).cast("bigint"))
    )


def coerce(df: DataFrame, types: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejects). Text that does not parse becomes NULL in the typed
    rows and one row (other columns, column, text, wanted type) among the rejects."""
    typed = df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})
    checks = F.array(
        *[
            F.when(
                F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(),
                F.struct(
                    F.lit(c).alias("column"),
                    F.col(c).cast("string").alias("text"),
                    F.lit(t).alias("wanted"),
                ),
            )
            for c, t in types.items()
        ]
    )
    others = [c for c in df.columns if c not in types]
    rejects = df.select(*others, F.explode(F.array_compact(checks)).alias("r")).select(*others, "r.*")
    return typed, rejects


def clean_text(df: DataFrame, col: str, rules: Sequence[tuple], out: str | None = None) -> DataFrame:
    """Apply rules in order: ("lower",), ("upper",), ("trim",),
    ("replace", pattern, text), ("extract", pattern, group)."""
    value = F.col(col)
    for name, *args in rules:
        if name == "lower":
            value = F.lower(value)
        elif name == "upper":
            value = F.upper(value)
        elif name == "trim":
            value = F.trim(value)
        elif name == "replace":
            value = F.regexp_replace(value, args[0], args[1])
        elif name == "extract":
            value = F.regexp_extract(value, args[0], args[1])
        else:
            raise ValueError(f"unknown text rule {name!r}")
    return df.withColumn(out or col, value)


def drop_duplicates(
    df: DataFrame, keys: str | Sequence[str], order: str | Column | Sequence[str | Column]
) -> DataFrame:
    """Keep the first row per key in ``order``.

    The rank filter is applied before the shuffle as well, so each task
    sends one row per key, however many copies it holds.
    """
    w = W.partitionBy(*names(keys)).orderBy(*columns(order))
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def most_frequent(df: DataFrame, col: str, by: str | Sequence[str] | None = None, name: str = "mode") -> DataFrame:
    """Most frequent value per group, the smallest one on ties."""
    by = names(by)
    counts = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count("*").alias("__c"))
    best = F.min(F.struct((-F.col("__c")).alias("c"), F.col(col).alias("v")))
    return counts.groupBy(*by).agg(best.alias("__b")).select(*by, F.col("__b.v").alias(name))


def impute(
    df: DataFrame,
    col: str,
    how: str = "mean",
    by: str | Sequence[str] | None = None,
    value=None,
    train: DataFrame | None = None,
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Fill missing values with the mean, median, mode or a constant, per group
    when ``by`` is given. Statistics come from ``train`` when it is given."""
    if how == "constant":
        return df.withColumn(col, F.coalesce(F.col(col), F.lit(value)))
    by, train, hot = names(by), df if train is None else train, None
    if how == "mean":
        fill = train.groupBy(*by).agg(F.avg(col).alias("__fill"))
    elif how == "median":
        hot = hot_keys(train, by, split_rows)
        fill = quantile_table(train, col, [0.5], by, hot=hot).select(*by, F.col("q0").alias("__fill"))
    elif how == "mode":
        fill = most_frequent(train, col, by, "__fill")
    else:
        raise ValueError(f"unknown way to impute {how!r}")
    filled = attach_split(df, fill, by, hot) if hot else attach(df, fill, by)
    return (
        filled
        .withColumn(col, F.coalesce(F.col(col), F.col("__fill")))
        .drop("__fill")
    )


def ffill(df, col, by, order, out: str | None = None, split_rows: int | None = SPLIT_ROWS) -> DataFrame:
    """Carry the last known value forward inside each group."""
    filled = scan(df, by, order, {"__filled": ("last", col)}, split_rows=split_rows)
    return filled.withColumn(out or col, F.col("__filled")).drop("__filled")


def bfill(df, col, by, order, out: str | None = None, split_rows: int | None = SPLIT_ROWS) -> DataFrame:
    """Carry the next known value backward inside each group."""
    filled = scan(df, by, order, {"__filled": ("next", col)}, split_rows=split_rows)
    return filled.withColumn(out or col, F.col("__filled")).drop("__filled")


def interpolate(
    df: DataFrame, col: str, by, t: str, out: str | None = None, split_rows: int | None = SPLIT_ROWS
) -> DataFrame:
    """Fill missing values on the straight line between the known neighbours in
    time. Before the first and after the last known value they stay missing."""
    is_time = dict(df.dtypes)[t].startswith("timestamp")
    when = (micros(t) if is_time else F.col(t)).cast("double")
    known = F.when(F.col(col).isNotNull(), F.struct(when.alias("t"), F.col(col).alias("v")))
    both = scan(
        df.withColumn("__known", known), by, t,
        {"__prev": ("last", "__known"), "__next": ("next", "__known")}, split_rows=split_rows,
    )
    prev, nxt = F.col("__prev"), F.col("__next")
    line = prev["v"] + (nxt["v"] - prev["v"]) * F.try_divide(when - prev["t"], nxt["t"] - prev["t"])
    return both.withColumn(out or col, F.coalesce(F.col(col), line)).drop("__known", "__prev", "__next")


def outliers_iqr(
    df: DataFrame, col: str, by=None, k: float = 1.5, split_rows: int | None = SPLIT_ROWS
) -> DataFrame:
    """Rows outside [q25 - k·IQR, q75 + k·IQR] of their group."""
    by = names(by)
    hot = hot_keys(df, by, split_rows)
    q = quantile_table(df, col, [0.25, 0.75], by, hot=hot)
    spread = F.lit(float(k)) * (F.col("q1") - F.col("q0"))
    fences = q.select(*by, (F.col("q0") - spread).alias("low"), (F.col("q1") + spread).alias("high"))
    return attach_split(df, fences, by, hot).where((F.col(col) < F.col("low")) | (F.col(col) > F.col("high")))


def zscore(df: DataFrame, col: str, by=None, out: str = "z") -> DataFrame:
    """Standard score per group (sample deviation); NULL where it is zero or undefined.

    Group statistics are aggregated before the shuffle and joined back, so a hot
    group is never gathered in one task as a window would do.
    """
    by = names(by)
    stats = df.groupBy(*by).agg(F.avg(col).alias("__m"), F.stddev_samp(col).alias("__s"))
    score = F.try_divide(F.col(col) - F.col("__m"), F.col("__s"))
    return attach(df, stats, by).withColumn(out, score).drop("__m", "__s")


def winsorize(
    df: DataFrame, col: str, lo: float, hi: float, by=None, out: str | None = None,
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Clip at the ``lo`` and ``hi`` quantiles (of the group). Missing values stay missing."""
    by = names(by)
    hot = hot_keys(df, by, split_rows)
    edges = quantile_table(df, col, [lo, hi], by, hot=hot).select(
        *by, F.col("q0").alias("__lo"), F.col("q1").alias("__hi")
    )
    clipped = F.when(
        F.col(col).isNotNull(),
        F.least(F.greatest(F.col(col).cast("double"), F.col("__lo")), F.col("__hi")),
    )
    return attach_split(df, edges, by, hot).withColumn(out or col, clipped).drop("__lo", "__hi")


def nan_to_null(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """NaN is a value in Spark; on read it should become missing."""
    return df.withColumns({c: finite(c) for c in names(cols)})
