"""Grouping, subtotals, reshaping, splits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from framewright.functions.exprs import attach, columns, join_on, micros, names
from framewright.operators.ordered import SPLIT_ROWS, positions, quantile_table

# Spark prunes ranks before the shuffle up to this limit
RANK_LIMIT = 1_000


def groupby_agg(
    df: DataFrame,
    keys: str | Sequence[str] | None,
    aggs: dict[str, tuple | Column],
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """``aggs`` maps a result column to (function, column[, argument]) or to an
    aggregate expression. Functions: count, size, sum, mean, std, var, min, max,
    nunique, quantile (argument p) and argmax / argmin (argument: the column
    whose extreme decides; the smallest value on ties).

    Distinct counts and quantiles are aggregated per value first, each as a table
    of its own that is joined by key, so that neither multiplies the input rows.
    """
    keys = names(keys)
    simple, extra = [], []
    for out, spec in aggs.items():
        if isinstance(spec, Column):
            simple.append(spec.alias(out))
            continue
        fn, col, *arg = spec
        if fn == "nunique":
            once = df.where(F.col(col).isNotNull()).groupBy(*keys, F.col(col).alias("__v")).agg(F.lit(1).alias("__one"))
            extra.append((once.groupBy(*keys).agg(F.count("__one").alias(out)), out, 0))
        elif fn == "quantile":
            q = quantile_table(df, col, [arg[0]], keys, split_rows)
            extra.append((q.select(*keys, F.col("q0").alias(out)), out, None))
        else:
            simple.append(_aggregate(df, fn, col, *arg).alias(out))
    base = df.groupBy(*keys).agg(*(simple or [F.lit(None).alias("__none")]))
    for table, out, missing in extra:
        base = attach(base, table, keys)
        if missing is not None:
            base = base.withColumn(out, F.coalesce(out, F.lit(missing)))
    return base.select(*keys, *aggs)


def _aggregate(df: DataFrame, fn: str, col: str, arg: str | None = None) -> Column:
    plain = {
        "count": F.count, "sum": F.sum, "mean": F.avg, "std": F.stddev_samp,
        "var": F.var_samp, "min": F.min, "max": F.max,
    }
    if fn in plain:
        return plain[fn](col)
    if fn == "size":
        return F.count("*")
    if fn in ("argmax", "argmin"):
        kind, by = dict(df.dtypes)[arg], F.col(arg)
        if kind.startswith("timestamp"):
            by = micros(F.col(arg).cast("timestamp_ntz"))
        elif kind == "date":
            by = F.unix_date(arg)
        decided = F.when(F.col(arg).isNotNull(), F.struct((-by if fn == "argmax" else by).alias("by"), F.col(col).alias("v")))
        return F.min(decided).getField("v")
    raise ValueError(f"unknown aggregate {fn!r}")


def subtotals(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Sequence[Column],
    how: str = "cube",
    sets: Sequence[Sequence[str]] | None = None,
) -> DataFrame:
    """Rollup, cube or explicit grouping sets. ``level`` tells a subtotal's NULL
    from a NULL in the data: bit i, from the left, is 1 when key i is summed over.
    """
    rows = {
        "cube": lambda: df.cube(*keys),
        "rollup": lambda: df.rollup(*keys),
        "sets": lambda: df.groupingSets([[F.col(c) for c in s] for s in sets], *keys),
    }[how]()
    return rows.agg(F.grouping_id().cast("bigint").alias("level"), *aggs)


def pivot_table(
    df: DataFrame, index: str | Sequence[str], col: str, values: Sequence, aggs: Sequence[Column] | Column
) -> DataFrame:
    """Long to wide: one column per listed value. The values are always given, so
    no extra job has to find them and the result's schema is known."""
    aggs = [aggs] if isinstance(aggs, Column) else list(aggs)
    return df.groupBy(*names(index)).pivot(col, list(values)).agg(*aggs)


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], variable: str = "variable", value: str = "value") -> DataFrame:
    """Wide to long; the melted columns need one type."""
    return df.unpivot(list(ids), list(cols), variable, value)


def crosstab(df: DataFrame, a: str, b: str, normalize: bool = False) -> DataFrame:
    """Counts per pair of values, in long form; ``share`` is of the row ``a``."""
    counts = df.groupBy(a, b).agg(F.count("*").alias("n"))
    if not normalize:
        return counts
    totals = df.groupBy(a).agg(F.count("*").alias("__total"))
    share = F.col("n").cast("double") / F.col("__total").cast("double")
    return join_on(counts, totals, a).withColumn("share", share).drop("__total")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, NULL included."""
    return df.groupBy(col).agg(F.count("*").alias("n"))


def nlargest(
    df: DataFrame,
    by: str | Sequence[str] | None,
    order: str | Column | Sequence[str | Column],
    n: int,
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """First ``n`` rows per group in ``order``, or of the whole table without ``by``.

    Up to ``RANK_LIMIT`` Spark keeps only ``n`` rows per key and task before the
    shuffle, which also tames hot keys; beyond it positions are counted.
    """
    by, order = names(by), columns(order)
    if not by:
        return df.orderBy(*order).limit(n)
    if n <= RANK_LIMIT:
        w = W.partitionBy(*by).orderBy(*order)
        return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")
    return positions(df, by, order, "__rn", split_rows=split_rows).where(F.col("__rn") <= n).drop("__rn")


def hash_number(key: str | Column, seed: str = "") -> Column:
    """A number in [0, 2^32) from the MD5 of the key's text; the same on every run."""
    key = F.col(key) if isinstance(key, str) else key
    text = F.concat(key.cast("string"), F.lit(seed)) if seed else key.cast("string")
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def split_by_hash(
    df: DataFrame, key: str, weights: dict[str, int], seed: str = "", out: str = "split"
) -> DataFrame:
    """Label rows as, say, train / valid / test from a hash of the key. Rows with
    one key stay together, and no run or partitioning changes the outcome."""
    slot = F.pmod(hash_number(key, seed), F.lit(sum(weights.values())))
    label, upto = None, 0
    for name, weight in weights.items():
        upto += weight
        label = F.when(slot < upto, name) if label is None else label.when(slot < upto, name)
    return df.withColumn(out, label)


def sample_stratified(
    df: DataFrame, key: str, by: str, frac: float, seed: str = "", split_rows: int | None = SPLIT_ROWS
) -> DataFrame:
    """Of every class the ``ceil(frac · size)`` rows of smallest key hash, so the
    share is exact and the choice repeatable."""
    hashed = df.withColumn("__h", hash_number(key, seed))
    ranked = positions(hashed, by, [F.col("__h"), F.col(key)], "__rn", "__size", split_rows)
    return ranked.where(F.col("__rn") <= F.ceil(F.col("__size") * F.lit(float(frac)))).drop("__h", "__rn", "__size")
