"""Arrays, matrices, histograms and quantiles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from framewright.functions.exprs import attach, names
from framewright.operators.ordered import SPLIT_ROWS, quantile_table


def as_doubles(vec: str | Column) -> Column:
    vec = F.col(vec) if isinstance(vec, str) else vec
    return vec.cast("array<double>")


def dot(a: str | Column, b: str | Column) -> Column:
    """Inner product, NULL when the lengths differ."""
    a, b = as_doubles(a), as_doubles(b)
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.when(F.size(a) == F.size(b), F.aggregate(products, F.lit(0.0), lambda s, x: s + x))


def norm(a: str | Column) -> Column:
    return F.sqrt(F.aggregate(as_doubles(a), F.lit(0.0), lambda s, x: s + x * x))


def vec_ops(df: DataFrame, op: str, a: str, b: str | float | None = None, out: str | None = None) -> DataFrame:
    """Element-wise add, sub, mul of two array columns, scale by a number, dot, norm, cosine."""
    if op in ("add", "sub", "mul"):
        step = {"add": lambda x, y: x + y, "sub": lambda x, y: x - y, "mul": lambda x, y: x * y}[op]
        value = F.zip_with(as_doubles(a), as_doubles(b), step)
    elif op == "scale":
        value = F.transform(as_doubles(a), lambda x: x * F.lit(float(b)))
    elif op == "dot":
        value = dot(a, b)
    elif op == "norm":
        value = norm(a)
    elif op == "cosine":
        value = F.try_divide(dot(a, b), norm(a) * norm(b))
    else:
        raise ValueError(f"unknown vector operation {op!r}")
    return df.withColumn(out or op, value)


def gram(df: DataFrame, vec: str, centered: bool = False) -> DataFrame:
    """XᵀX (or the sample covariance) in coordinate form (i, j, v), i <= j.

    Each task adds its rows up in one d × d array and sends that many numbers, so
    the shuffle is independent of the number of rows. The vector length is the
    only bound on memory. For covariances a first pass takes the means, one number for each
    coordinate, and the second adds up products of what is left, so large means do not cancel.
    """
    known = df.where(F.col(vec).isNotNull()).select(as_doubles(vec).alias("v"))
    means = None
    if centered:
        each = known.select(F.posexplode_outer("v").alias("i", "x")).where("i is not null").groupBy("i").agg(F.avg("x").alias("m"))
        means = np.array([r["m"] for r in each.orderBy("i").collect()])  # as many as a vector has coordinates

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells, sums, n = None, None, 0
        for pdf in batches:
            if len(pdf):
                x = np.asarray(pdf["v"].tolist(), dtype=float)
                x = x if means is None else x - means
                cells = x.T @ x if cells is None else cells + x.T @ x
                sums = x.sum(axis=0) if sums is None else sums + x.sum(axis=0)
                n += len(x)
        if cells is not None:
            i, j = np.triu_indices(len(sums))
            yield pd.DataFrame({"i": i, "j": j, "v": cells[i, j], "si": sums[i], "sj": sums[j], "n": n})

    parts = known.mapInPandas(
        partial, "i int, j int, v double, si double, sj double, n bigint"
    )
    total = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("v", "si", "sj", "n")])
    if centered:
        cov = F.try_divide(F.col("v") - F.col("si") * F.col("sj") / F.col("n"), F.col("n") - F.lit(1.0))
        return total.select("i", "j", cov.alias("v"))
    return total.select("i", "j", "v")


def matmul_coo(a: DataFrame, b: DataFrame, block: int = 256) -> DataFrame:
    """Product of two sparse matrices given as (i, j, v); missing cells are zero.

    Both are cut into square blocks, and only blocks that share an inner block with one of the other
    side are paired: cells go to the pairs of their block, however large the indices are. A pair is multiplied in
    one task, which holds two blocks and their product and emits product cells, not the single
    products behind them; partial sums over the inner blocks are then added.
    """

    def cells(m: DataFrame, i: str, j: str) -> DataFrame:
        kept = m.select(F.col("i").cast("bigint").alias(i), F.col("j").cast("bigint").alias(j), F.col("v").cast("double"))
        kept = kept.dropna(subset=[i, j]).groupBy(i, j).agg(F.sum("v").alias("v"))
        return kept.withColumns({f"b{c}": F.floor(F.col(c) / block).cast("bigint") for c in (i, j)})

    left, right = cells(a, "i", "k"), cells(b, "k", "j")
    keys = ["bi", "bk", "bj"]
    pairs = left.select("bi", "bk").distinct().join(right.select("bk", "bj").distinct(), "bk")
    at_l = pairs.select(*[F.col(c).alias(f"l{c}") for c in keys])
    at_r = pairs.select(*[F.col(c).alias(f"r{c}") for c in keys])
    left = left.join(at_l, (F.col("bi") == F.col("lbi")) & (F.col("bk") == F.col("lbk"))).select(
        F.col("lbi").alias("bi"), F.col("lbk").alias("bk"), F.col("lbj").alias("bj"), "i", "k", "v"
    )
    right = right.join(at_r, (F.col("bk") == F.col("rbk")) & (F.col("bj") == F.col("rbj"))).select(
        F.col("rbi").alias("bi"), F.col("rbk").alias("bk"), F.col("rbj").alias("bj"), "k", "j", "v"
    )

    def multiply(l: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if l.empty or r.empty:
            return pd.DataFrame({"i": [], "j": [], "v": []}).astype({"i": "int64", "j": "int64"})
        x, y, hit_x, hit_y = (np.zeros((block, block)) for _ in range(4))
        at_x, at_y = (l["i"] % block, l["k"] % block), (r["k"] % block, r["j"] % block)
        x[at_x], y[at_y] = l["v"], r["v"]
        hit_x[at_x], hit_y[at_y] = 1, 1
        # infinities and missing numbers only meet cells that are there
        odd_x, odd_y = ~np.isfinite(x), ~np.isfinite(y)
        product = np.where(odd_x, 0, x) @ np.where(odd_y, 0, y)
        for i, k in zip(*np.nonzero(odd_x)):
            there = hit_y[k] > 0
            product[i, there] += x[i, k] * y[k, there]
        for k, j in zip(*np.nonzero(odd_y)):
            there = (hit_x[:, k] > 0) & ~odd_x[:, k]
            product[there, j] += x[there, k] * y[k, j]
        i, j = np.nonzero(hit_x @ hit_y)
        return pd.DataFrame({"i": i + l["bi"].iloc[0] * block, "j": j + r["bj"].iloc[0] * block, "v": product[i, j]})

    products = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        multiply, "i bigint, j bigint, v double"
    )
    return products.groupBy("i", "j").agg(F.sum("v").alias("v"))


def equal_width_bin(col: str, low: Column, high: Column, bins: int) -> Column:
    """Bin number from 0; the last bin includes its upper edge. Values outside
    [low, high] go to the nearest bin, a constant column to bin 0."""
    x = F.col(col).cast("double")
    place = F.floor(F.try_divide((x - low) * bins, high - low)).cast("int")
    inside = F.greatest(F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)), F.lit(0))
    return F.when(x.isNotNull(), inside)


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width counts between minimum and maximum, empty bins included."""
    known = df.where(F.col(col).isNotNull()).select(col)
    ends = known.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))
    counts = (
        attach(known, ends, None)
        .groupBy(equal_width_bin(col, F.col("lo"), F.col("hi"), bins).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    grid = attach(df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")), ends, None)
    step = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counts, "bin", "left").select(
        "bin", (F.col("lo") + step * F.col("bin")).alias("low"),
        (F.col("lo") + step * (F.col("bin") + 1)).alias("high"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def quantiles(
    df: DataFrame, col: str, ps: Sequence[float], by=None, exact: bool = True,
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Quantiles in long form (by…, p, value): linear-interpolated, or from a
    mergeable sketch with ``exact=False``."""
    by = names(by)
    if exact:
        table = quantile_table(df, col, ps, by, split_rows)
        values = [F.col(f"q{i}") for i in range(len(ps))]
    else:
        table = df.groupBy(*by).agg(F.percentile_approx(col, list(ps), 10_000).alias("__q"))
        values = [F.col("__q")[i].cast("double") for i in range(len(ps))]
    pairs = [F.struct(F.lit(float(p)).alias("p"), v.alias("value")) for p, v in zip(ps, values)]
    return table.select(*by, F.explode(F.array(*pairs)).alias("s")).select(*by, "s.*")
