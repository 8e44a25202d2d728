"""Running values over ordered groups that stay balanced when one key is hot.

A window partitioned by a key sends all rows of the key to one task. That is
right for ordinary keys and wrong for one that holds a third of the table. So:

1. count the rows per key (partial aggregation, key columns only);
2. keys with at most ``split_rows`` rows take the plain window;
3. rows of hotter keys are range-partitioned by (key, order). A partition is a
   *chunk*: a run of consecutive rows. Windows run inside (key, chunk), one small
   row per chunk is carried over to the later chunks, and the two are combined.

At most ``rows / split_rows`` keys can be hot, which bounds both the list of hot
keys and the number of chunks. The chunked rows are checkpointed, because range
bounds are sampled and must be the same for the rows and for the carried values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window as W, WindowSpec, functions as F

from framewright.functions.exprs import attach, columns, join_on, names
from framewright.session import checkpointed

SPLIT_ROWS = 4_000_000
CHUNK = "__chunk"

# what a running value may be: sum, min, max, the last value at or before the
# row, or the next value at or after it (missing values are skipped)
KINDS = ("sum", "min", "max", "last", "next")


@dataclass(frozen=True)
class Hot:
    """Keys with more than ``split_rows`` rows; ``rows`` is their total."""

    keys: list[Row]
    rows: int
    split_rows: int | None


def hot_keys(df: DataFrame, by: str | Sequence[str] | None, split_rows: int | None = SPLIT_ROWS) -> Hot:
    """Find the hot keys (one pass over the key columns).

    ``split_rows=None`` says that the caller knows that there are none.
    """
    by = names(by)
    if split_rows is None:
        return Hot([], 0, None)
    if not by:
        total = df.count()
        return Hot([Row()] if total > split_rows else [], total, split_rows)
    found = df.groupBy(*by).agg(F.count("*").alias("__n")).where(F.col("__n") > split_rows).collect()
    return Hot(found, sum(r["__n"] for r in found), split_rows)


def listed_keys(df: DataFrame, by: list[str], hot: Hot) -> DataFrame:
    """The hot keys as a table. Its size decides how it is joined."""
    rows = [tuple(r[c] for c in by) for r in hot.keys]
    return df.sparkSession.createDataFrame(rows, df.select(*by).schema)


def attach_split(df: DataFrame, stats: DataFrame, by: str | Sequence[str] | None, hot: Hot) -> DataFrame:
    """Like ``attach``, but rows of hot keys are not shuffled by key: the few
    statistics rows of these keys are joined to them apart, a join that AQE broadcasts or splits."""
    by = names(by)
    if not by or not hot.keys:
        return attach(df, stats, by)
    listed = listed_keys(df, by, hot)
    few = join_on(stats, listed, by, "left_semi")
    heavy = join_on(join_on(df, listed, by, "left_semi"), few, by)
    return join_on(join_on(df, listed, by, "left_anti"), stats, by).unionByName(heavy)


def _split(df: DataFrame, by: list[str], order: list[Column], hot: Hot) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows of ordinary keys, chunked rows of hot keys); None where there are none."""
    if not hot.keys:
        return df, None
    cold, heavy = None, df
    if by:
        listed = listed_keys(df, by, hot)
        cold = join_on(df, listed, by, "left_anti")
        heavy = join_on(df, listed, by, "left_semi")
    chunks = max(2, -(-hot.rows // hot.split_rows))
    heavy = heavy.repartitionByRange(chunks, *[F.col(c) for c in by], *order)
    return cold, checkpointed(heavy.withColumn(CHUNK, F.spark_partition_id()))


def _over(kind: str, value: Column, w: W) -> Column:
    call = {
        "sum": F.sum,
        "min": F.min,
        "max": F.max,
        "last": lambda c: F.last(c, ignorenulls=True),
        "next": lambda c: F.first(c, ignorenulls=True),
    }[kind]
    return call(value).over(w)


def _combine(kind: str, here: Column, carried: Column) -> Column:
    if kind == "sum":
        return F.when(here.isNull(), carried).otherwise(here + F.coalesce(carried, F.lit(0)))
    if kind == "min":
        return F.least(here, carried)
    if kind == "max":
        return F.greatest(here, carried)
    return F.coalesce(here, carried)


def scan(
    df: DataFrame,
    by: str | Sequence[str] | None,
    order: str | Column | Sequence[str | Column],
    running: dict[str, tuple[str, str]],
    totals: dict[str, str] | None = None,
    split_rows: int | None = SPLIT_ROWS,
    hot: Hot | None = None,
) -> DataFrame:
    """Add running values per group.

    ``running`` maps a new column to (kind, input column), see ``KINDS``;
    ``totals`` maps a new column to an input column that is summed over the
    whole group. ``order`` has to be total for a repeatable result.
    """
    by, order, totals = names(by), columns(order), totals or {}
    hot = hot_keys(df, by, split_rows) if hot is None else hot
    cold, heavy = _split(df, by, order, hot)

    parts = []
    if cold is not None:
        whole = W.partitionBy(*by)
        parts.append(
            _windowed(cold, by, order, running).withColumns(
                {o: F.sum(c).over(whole) for o, c in totals.items()}
            )
        )
    if heavy is not None:
        parts.append(_chunked(heavy, by, order, running, totals))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _windowed(df: DataFrame, keys: list[str], order: list[Column], running: dict) -> DataFrame:
    """Spark sums up a frame that ends with the group anew for each row, which grows with the square of the group. So the
    next value is the last one in the opposite order, by row numbers, as the order need not be total."""
    w = W.partitionBy(*keys).orderBy(*order)
    ahead = any(k == "next" for k, _ in running.values())
    if ahead:
        df = df.withColumn("__nth", F.row_number().over(w))
    turned = W.partitionBy(*keys).orderBy(F.col("__nth").desc())

    def value(kind: str, c: str) -> Column:
        kind, frame = ("last", turned) if kind == "next" else (kind, w)
        return _over(kind, F.col(c), frame.rowsBetween(W.unboundedPreceding, 0))

    out = df.withColumns({o: value(k, c) for o, (k, c) in running.items()})
    return out.drop("__nth") if ahead else out


def _chunked(heavy: DataFrame, by: list[str], order: list[Column], running: dict, totals: dict) -> DataFrame:
    keys = [*by, CHUNK]
    numbered = heavy
    if any(k in ("last", "next") for k, _ in running.values()):
        numbered = heavy.withColumn("__rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))

    def of_chunk(kind: str, c: str) -> Column:
        seen = F.when(F.col(c).isNotNull(), F.col("__rn"))
        return {
            "sum": lambda: F.sum(c),
            "min": lambda: F.min(c),
            "max": lambda: F.max(c),
            "last": lambda: F.max_by(c, seen),
            "next": lambda: F.min_by(c, seen),
        }[kind]()

    per_chunk = numbered.groupBy(*keys).agg(
        *[of_chunk(k, c).alias(f"__in_{o}") for o, (k, c) in running.items()],
        *[F.sum(c).alias(f"__in_{o}") for o, c in totals.items()],
    )
    # one row per (hot key, chunk): at most MAX_CHUNKS rows per key
    w = W.partitionBy(*by).orderBy(CHUNK)
    before = w.rowsBetween(W.unboundedPreceding, -1)
    after = w.rowsBetween(1, W.unboundedFollowing)
    carry = per_chunk.select(
        *keys,
        *[
            _over(k, F.col(f"__in_{o}"), after if k == "next" else before).alias(f"__carry_{o}")
            for o, (k, _) in running.items()
        ],
        *[F.sum(f"__in_{o}").over(W.partitionBy(*by)).alias(o) for o in totals],
    )
    out = join_on(_windowed(heavy, keys, order, running), carry, keys)
    out = out.withColumns(
        {o: _combine(k, F.col(o), F.col(f"__carry_{o}")) for o, (k, _) in running.items()}
    )
    return out.drop(CHUNK, *[f"__carry_{o}" for o in running])


def positions(
    df: DataFrame,
    by: str | Sequence[str] | None,
    order: str | Column | Sequence[str | Column],
    name: str = "position",
    size: str | None = None,
    split_rows: int | None = SPLIT_ROWS,
    hot: Hot | None = None,
) -> DataFrame:
    """Number the rows of each group from 1; ``size`` adds the number of rows."""
    out = scan(
        df.withColumn("__one", F.lit(1).cast("bigint")),
        by, order, {name: ("sum", "__one")}, {size: "__one"} if size else None, split_rows, hot,
    )
    return out.drop("__one")


def near_rows(
    df: DataFrame,
    by: str | Sequence[str],
    order: str | Column | Sequence[str | Column],
    make: dict[str, Callable[[WindowSpec], Column]],
    back: int = 0,
    ahead: int = 0,
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Window expressions that look at most ``back`` rows behind and ``ahead`` rows on.

    ``make`` maps a new column to a function of the ordered window. Rows of hot
    keys get their position, are cut into blocks of consecutive positions, and
    each block also receives the few neighbouring rows its frames reach.
    """
    by, order = names(by), columns(order)
    hot = hot_keys(df, by, split_rows)
    plain = W.partitionBy(*by).orderBy(*order)
    if not hot.keys:
        return df.withColumns({o: f(plain) for o, f in make.items()})

    block = max(hot.split_rows, back, ahead, 1)
    cold, heavy = _split(df, by, order, hot)
    at = F.col("__at")
    one = heavy.withColumn("__one", F.lit(1).cast("bigint"))
    placed = (
        _chunked(one, by, order, {"__at": ("sum", "__one")}, {})
        .drop("__one")
        .withColumn("__at", at - 1)
        .withColumn("__home", F.floor(at / block))
        .withColumn(
            "__block",
            F.explode(
                F.sequence(
                    F.floor(F.greatest(at - ahead, F.lit(0)) / block), F.floor((at + back) / block)
                )
            ),
        )
    )
    w = W.partitionBy(*by, "__block").orderBy("__at")
    done = (
        placed.withColumns({o: f(w) for o, f in make.items()})
        .where(F.col("__block") == F.col("__home"))
        .drop("__at", "__home", "__block")
    )
    if cold is None:
        return done
    return cold.withColumns({o: f(plain) for o, f in make.items()}).unionByName(done)


def quantile_table(
    df: DataFrame,
    col: str,
    ps: Sequence[float],
    by: str | Sequence[str] | None = None,
    split_rows: int | None = SPLIT_ROWS,
    hot: Hot | None = None,
) -> DataFrame:
    """Exact linear-interpolated quantiles, one row per group: by…, n, distinct, q0, q1, …

    Equal values are counted before anything is ordered, so repeated values cost
    one row; ranks come from a running count that splits hot groups. Unlike the
    built-in exact percentile, no task holds all distinct values of a group.
    """
    by = names(by)
    known = df.where(F.col(col).isNotNull()).select(*by, F.col(col).cast("double").alias("__v"))
    hot = hot_keys(known, by, split_rows) if hot is None else hot
    counted = known.groupBy(*by, "__v").agg(F.count("*").alias("__c"))
    ranked = scan(counted, by, "__v", {"__cum": ("sum", "__c")}, {"__n": "__c"}, hot=hot)
    n, cum, first = F.col("__n"), F.col("__cum"), F.col("__cum") - F.col("__c")

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank < cum), F.col("__v")))

    picks, out = [], []
    for i, p in enumerate(ps):
        where = F.lit(float(p)) * (n - 1)
        picks += [at(F.floor(where)).alias(f"__lo{i}"), at(F.ceil(where)).alias(f"__hi{i}")]
        lo, hi, k = F.col(f"__lo{i}"), F.col(f"__hi{i}"), F.lit(float(p)) * (n - 1)
        # equal ends may be infinite, and their difference is then no number
        out.append(F.when(lo == hi, lo).otherwise(lo + (k - F.floor(k)) * (hi - lo)).alias(f"q{i}"))
    return (
        ranked.groupBy(*by)
        .agg(F.max("__n").alias("__n"), F.count("*").alias("distinct"), *picks)
        .select(*by, n.alias("n"), "distinct", *out)
    )

