"""Chart-ready summaries: small tables of numbers; drawing is the caller's."""

from __future__ import annotations

from collections.abc import Sequence

import math

from pyspark.sql import Column, DataFrame, functions as F

from framewright.functions.exprs import attach, names
from framewright.operators.arrays import equal_width_bin
from framewright.operators.ordered import SPLIT_ROWS, attach_split, hot_keys, quantile_table, scan
from framewright.operators.timeseries import resample


def histogram_2d(df: DataFrame, x: str, y: str, bins_x: int, bins_y: int) -> DataFrame:
    """Counts on an equal-width grid, occupied cells only."""
    rows = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    ends = rows.agg(*[f(c).alias(f"{c}{e}") for c in "xy" for e, f in (("lo", F.min), ("hi", F.max))])
    cells = attach(rows, ends, None)
    return cells.groupBy(
        equal_width_bin("x", F.col("xlo"), F.col("xhi"), bins_x).alias("bin_x"),
        equal_width_bin("y", F.col("ylo"), F.col("yhi"), bins_y).alias("bin_y"),
    ).agg(F.count("*").alias("n"))


def box_stats(
    df: DataFrame, col: str, by=None, k: float = 1.5, split_rows: int | None = SPLIT_ROWS
) -> DataFrame:
    """Quartiles, whiskers at the extreme values inside the fences, and outliers beyond them."""
    by = names(by)
    rows = df.where(F.col(col).isNotNull()).select(*by, F.col(col).cast("double").alias("v"))
    hot = hot_keys(rows, by, split_rows)
    q = quantile_table(rows, "v", [0.25, 0.5, 0.75], by, hot=hot).select(
        *by, F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75")
    )
    reach = F.lit(float(k)) * (F.col("q75") - F.col("q25"))
    inside = F.col("v").between(F.col("q25") - reach, F.col("q75") + reach)
    return attach_split(rows, q, by, hot).groupBy(*by).agg(
        *[F.max(c).alias(c) for c in ("q25", "q50", "q75")],
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("outliers"),
        F.count("*").alias("n"),
    )


def ecdf(df: DataFrame, col: str, by=None, split_rows: int | None = SPLIT_ROWS) -> DataFrame:
    """Cumulative share at every distinct value."""
    by = names(by)
    rows = df.where(F.col(col).isNotNull())
    counts = rows.groupBy(*by, F.col(col).alias("value")).agg(F.count("*").alias("__c"))
    shares = scan(
        counts, by, "value", {"__upto": ("sum", "__c")}, {"__n": "__c"}, hot=hot_keys(rows, by, split_rows)
    )
    share = F.col("__upto").cast("double") / F.col("__n").cast("double")
    return shares.select(*by, "value", share.alias("share"))


def kde_grid(df: DataFrame, col: str, points: Sequence[float], bandwidth: float, by=None) -> DataFrame:
    """Gaussian kernel density at the given points. One average per point, all of
    them in a single pass; rows are not multiplied."""
    by, x = names(by), F.col(col).cast("double")
    scale = 1.0 / (bandwidth * math.sqrt(2 * math.pi))

    def kernel(p: float) -> Column:
        u = (x - F.lit(float(p))) / F.lit(float(bandwidth))
        return F.avg(F.exp(u * u * F.lit(-0.5))) * F.lit(scale)

    wide = df.groupBy(*by).agg(*[kernel(p).alias(f"__p{i}") for i, p in enumerate(points)])
    pairs = [F.struct(F.lit(float(p)).alias("x"), F.col(f"__p{i}").alias("density")) for i, p in enumerate(points)]
    return wide.select(*by, F.explode(F.array(*pairs)).alias("s")).select(*by, "s.*")


def corr_heatmap(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair of columns, long form, in one pass;
    NULL where a column is constant."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]

    def pearson(a: str, b: str) -> Column:
        # F.corr divides by zero on a constant column, which ANSI mode refuses
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        spread = F.stddev_pop(F.when(both, F.col(a))) * F.stddev_pop(F.when(both, F.col(b)))
        return F.try_divide(F.covar_pop(a, b), spread)

    one = df.agg(*[pearson(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{i}").alias("r"))
        for i, pair in enumerate(pairs)
        for a, b in dict.fromkeys([pair, pair[::-1]])
    ]
    return one.select(F.explode(F.array(*cells)).alias("s")).select("s.*")


def bar_ci(df: DataFrame, col: str, by, z: float = 1.96) -> DataFrame:
    """Group means with a normal confidence interval, mean ± z·s/√n."""
    half = F.lit(float(z)) * F.stddev_samp(col) / F.sqrt(F.count(col))
    stats = df.groupBy(*names(by)).agg(F.count(col).alias("n"), F.avg(col).alias("mean"), half.alias("half"))
    return stats.withColumns({"low": F.col("mean") - F.col("half"), "high": F.col("mean") + F.col("half")}).drop("half")


def reg_line(df: DataFrame, x: str, y: str, by=None, points: int = 2) -> DataFrame:
    """Least-squares line of each group at ``points`` even steps between the group's extreme x."""
    by = names(by)
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    fits = df.where(both).groupBy(*by).agg(
        F.regr_slope(y, x).alias("m"), F.regr_intercept(y, x).alias("c"),
        F.min(x).cast("double").alias("lo"), F.max(x).cast("double").alias("hi"),
    )
    at = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("i") / F.lit(max(points - 1, 1))
    grid = fits.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    return grid.withColumn("x", at).select(*by, "x", (F.col("m") * F.col("x") + F.col("c")).alias("y"))


def line_series(df: DataFrame, ts: str, every: str, aggs: Sequence[Column], by=None) -> DataFrame:
    """One point per period and series, gaps shown as NULLs."""
    return resample(df, ts, every, aggs, by)
