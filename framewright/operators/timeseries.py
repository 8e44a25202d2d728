"""Ranks, shifts, running and rolling values, resampling."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from framewright.functions.exprs import attach, join_on, micros, names
from framewright.operators.ordered import SPLIT_ROWS, Hot, hot_keys, near_rows, positions, scan

STATS = {
    "sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "std": F.stddev_samp, "count": F.count,
}

# frames with more rows than this are added up in blocks and not one by one
FRAME_ROWS = 500
# rows of a block of faded sums; longer memories chain their blocks
BLOCK_ROWS = 1_000_000


def rank_by(
    df: DataFrame,
    by,
    col: str,
    method: str = "average",
    ties: Sequence[str] = (),
    out: str = "rank",
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Rank of ``col`` inside its group, ascending, NULL for missing values.

    Methods: average, min, max, dense, and first, which numbers equal values in
    the order of ``ties``. All but first rank the distinct values and join the ranks
    back, so a value shared by very many rows is one row in the ordered part.
    """
    by = names(by)
    if method == "first":
        known = positions(
            df.withColumn("__gone", F.col(col).isNull().cast("int")),
            by, ["__gone", col, *ties], out, split_rows=split_rows,
        )
        return known.withColumn(out, F.when(F.col("__gone") == 0, F.col(out)).cast("double")).drop("__gone")
    return join_on(df, rank_table(df, by, col, method, out, split_rows), [*by, col])


def rank_table(
    df: DataFrame, by, col: str, method: str = "average", out: str = "rank",
    split_rows: int | None = SPLIT_ROWS, hot: Hot | None = None,
) -> DataFrame:
    """The rank of every distinct value of ``col`` in its group: by…, col, rank."""
    by = names(by)
    known = df.where(F.col(col).isNotNull())
    counts = (
        known.groupBy(*by, col).agg(F.count("*").alias("__c")).withColumn("__one", F.lit(1).cast("bigint"))
    )
    ranked = scan(
        counts, by, col, {"__upto": ("sum", "__c"), "__dense": ("sum", "__one")},
        hot=hot_keys(known, by, split_rows) if hot is None else hot,
    )
    rank = {
        "min": F.col("__upto") - F.col("__c") + 1,
        "max": F.col("__upto"),
        "average": F.col("__upto") - (F.col("__c") - 1) / F.lit(2.0),
        "dense": F.col("__dense"),
    }[method]
    return ranked.select(*by, col, rank.cast("double").alias(out))


def shift_diff(
    df: DataFrame, by, order, col: str, n: int = 1, split_rows: int | None = SPLIT_ROWS
) -> DataFrame:
    """Add ``lag``, ``diff`` and ``pct_change`` against the row ``n`` before
    (or, for negative ``n``, after)."""
    make = {"lag": lambda w: F.lag(col, n).over(w)}
    out = near_rows(df, by, order, make, back=max(n, 0), ahead=max(-n, 0), split_rows=split_rows)
    diff = F.col(col) - F.col("lag")
    return out.withColumns({"diff": diff, "pct_change": F.try_divide(diff, F.col("lag"))})


def cumulative(
    df: DataFrame, by, order, col: str, kinds: Sequence[str] = ("sum", "max", "min"),
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Add ``cumsum`` / ``cummax`` / ``cummin`` up to and including each row."""
    return scan(df, by, order, {f"cum{k}": (k, col) for k in kinds}, split_rows=split_rows)


def rolling_rows(
    df: DataFrame, by, order, col: str, n: int, stat: str = "mean", out: str = "rolling",
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Statistic over the last ``n`` rows, fewer at the start of a group. Long frames are
    added up in blocks of positions, see ``rolling_time``."""
    if n > FRAME_ROWS and split_rows is not None:
        placed = positions(df, by, order, "__at", split_rows=split_rows)
        return _rolling_in_blocks(placed, names(by), col, n - 1, stat, out, n - 1, split_rows).drop("__at")
    make = {out: lambda w: STATS[stat](col).over(w.rowsBetween(-(n - 1), 0))}
    return near_rows(df, by, order, make, back=n - 1, split_rows=split_rows)


def rolling_time(
    df: DataFrame, by, ts: str, col: str, seconds: int, stat: str = "mean", out: str = "rolling",
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Statistic over the rows at most ``seconds`` older than the row, itself included.

    A sliding window adds up every frame anew and needs all rows of a key in one task. So it is
    used only where a count of rows per key and width finds both small.
    """
    by = names(by)
    width = int(seconds) * 1_000_000
    timed = df.withColumn("__at", micros(ts))
    longest, busiest = 0, 0
    if split_rows is not None:
        per_slot = timed.groupBy(*by, F.floor(F.col("__at") / width).alias("__slot")).agg(F.count("*").alias("__n"))
        per_key = per_slot.groupBy(*by).agg(F.sum("__n").alias("__n"), F.max("__n").alias("__most"))
        longest, busiest = per_key.agg(F.coalesce(F.max("__n"), F.lit(0)), F.coalesce(F.max("__most"), F.lit(0))).first()
    if split_rows is None or (longest <= split_rows and busiest <= min(FRAME_ROWS, split_rows)):
        w = W.partitionBy(*by).orderBy("__at").rangeBetween(-width, 0)
        return timed.withColumn(out, STATS[stat](col).over(w)).drop("__at")
    return _rolling_in_blocks(timed, by, col, width, stat, out, busiest, split_rows).drop("__at")


def _rolling_in_blocks(
    df: DataFrame, by: list[str], col: str, width: int, stat: str, out: str, busiest: int, rows: int
) -> DataFrame:
    """Statistic over [``__at`` - width, ``__at``] from three pieces that no task has to hold together.

    The axis is cut into ``per_width`` blocks per frame width, so many that a block has about
    ``rows`` rows (``busiest``: the most rows in one width). The frame of a row in block b is
    the part of b up to the row, the whole blocks b-per_width+1 … b-1, and the end of
    block b-per_width. The first is a running window inside the block; the second runs over one row
    per block; for the third the row is sent to the older block, shifted by the width, and stands
    there among the block's own rows. The work is linear, however long the frames are.
    """
    timeless = df.where(F.col("__at").isNull())
    alone = attach(timeless, timeless.groupBy(*by).agg(STATS[stat](col).alias(out)), by)
    df = df.where(F.col("__at").isNotNull())
    at = F.col("__at")
    per_width = next(m for m in range(max(1, -(-busiest // rows)), width + 1) if width % m == 0)
    block = F.floor(at / (width // per_width)).cast("bigint")

    if stat == "std":
        return _rolling_std(df.withColumn("__block", block), by, col, per_width, width, out).unionByName(alone)
    x = F.col(col).cast("double") if stat == "mean" else F.col(col)
    # running pieces: name -> (how to add up, input)
    pieces = {
        "sum": {"s": ("sum", x)},
        "min": {"lo": ("min", x)},
        "max": {"hi": ("max", x)},
        "count": {"n": ("sum", x.isNotNull().cast("bigint"))},
        "mean": {"s": ("sum", x), "n": ("sum", x.isNotNull().cast("bigint"))},
    }[stat]
    call = {"sum": F.sum, "min": F.min, "max": F.max}
    keys = [*by, "__block"]
    rows_ = df.withColumns({"__block": block, **{f"__x_{p}": v for p, (_, v) in pieces.items()}})

    upto = W.partitionBy(*keys).orderBy("__at").rangeBetween(W.unboundedPreceding, 0)
    headed = rows_.withColumns({f"__head_{p}": call[k](f"__x_{p}").over(upto) for p, (k, _) in pieces.items()})

    per_block = rows_.groupBy(*keys).agg(*[call[k](f"__x_{p}").alias(f"__x_{p}") for p, (k, _) in pieces.items()])
    older = W.partitionBy(*by).orderBy("__block").rangeBetween(-(per_width - 1), -1)
    middle = per_block.select(
        *keys,
        *[(call[k](f"__x_{p}").over(older) if per_width > 1 else F.lit(None)).alias(f"__mid_{p}") for p, (k, _) in pieces.items()],
    )

    payload = [c for c in headed.columns if not c.startswith("__x_") and c not in by]
    asking = headed.select(
        *by, (F.col("__block") - per_width).alias("__block"), (at - width).alias("__at"),
        F.struct(*payload).alias("__row"),
    )
    own = rows_.select(*keys, "__at", *[f"__x_{p}" for p in pieces])
    after = W.partitionBy(*keys).orderBy(at.desc()).rangeBetween(W.unboundedPreceding, 0)
    tailed = asking.unionByName(own, allowMissingColumns=True).withColumns(
        {f"__tail_{p}": call[k](f"__x_{p}").over(after) for p, (k, _) in pieces.items()}
    )
    answered = tailed.where(F.col("__row").isNotNull()).select(*by, "__row.*", *[f"__tail_{p}" for p in pieces])

    def together(p: str) -> Column:
        parts = [F.col(f"__{part}_{p}") for part in ("tail", "mid", "head")]
        kind = pieces[p][0]
        if kind == "sum":
            known = F.coalesce(*parts).isNotNull()
            return F.when(known, sum((F.coalesce(c, F.lit(0)) for c in parts[1:]), F.coalesce(parts[0], F.lit(0))))
        return (F.least if kind == "min" else F.greatest)(*parts)

    n = together("n") if "n" in pieces else None
    value = {
        "sum": lambda: together("s"),
        "min": lambda: together("lo"),
        "max": lambda: together("hi"),
        "count": lambda: n,
        "mean": lambda: F.try_divide(together("s"), n),
    }[stat]()
    done = join_on(answered, middle, keys).withColumn(out, value)
    done = done.drop("__block", *[f"__{part}_{p}" for part in ("head", "mid", "tail") for p in pieces])
    return done.unionByName(alone)


def _rolling_std(df: DataFrame, by: list[str], col: str, per_width: int, width: int, out: str) -> DataFrame:
    """Standard deviation over the frames of ``_rolling_in_blocks``, for rows with their ``__block``.

    Every part of a frame is a count, a mean and a sum of squares around it, added up around the mean of
    its own block (whole blocks: of the key), and parts are put together by the distances of their means. So values
    far from 0, or from other keys, lose no digits."""
    keys, at, x = [*by, "__block"], F.col("__at"), F.col(col).cast("double")
    stats = df.groupBy(*keys).agg(F.count(x).alias("__bn"), F.avg(x).alias("__c"), (F.var_pop(x) * F.count(x)).alias("__bq"))
    rows = join_on(df, stats.select(*keys, "__c"), keys).withColumn("__d", x - F.col("__c"))

    def running(w, part: str) -> dict[str, Column]:
        return {f"__{part}n": F.count("__d").over(w), f"__{part}s": F.sum("__d").over(w), f"__{part}q": F.sum(F.col("__d") * F.col("__d")).over(w)}

    headed = rows.withColumns(running(W.partitionBy(*keys).orderBy("__at").rangeBetween(W.unboundedPreceding, 0), "h"))
    whole = attach(stats, stats.groupBy(*by).agg(F.try_divide(F.sum(F.col("__c") * F.col("__bn")), F.sum("__bn")).alias("__k")), by)
    older, off = W.partitionBy(*by).orderBy("__block").rangeBetween(-(per_width - 1), -1), F.col("__c") - F.col("__k")
    middle = whole.select(*keys, "__k", *[
        (F.sum(v).over(older) if per_width > 1 else F.lit(None).cast("double")).alias(name)
        for name, v in (("__mn", F.col("__bn").cast("double")), ("__ms", F.col("__bn") * off), ("__mq", F.col("__bq") + F.col("__bn") * off * off))
    ])
    payload = [c for c in headed.columns if c not in by and c != "__d"]
    asking = headed.select(*by, (F.col("__block") - per_width).alias("__block"), (at - width).alias("__at"), F.struct(*payload).alias("__row"))
    asking = join_on(asking, stats.select(*keys, F.col("__c").alias("__tc")), keys)
    own = rows.select(*keys, "__at", "__d")
    after = W.partitionBy(*keys).orderBy(at.desc()).rangeBetween(W.unboundedPreceding, 0)
    tailed = asking.unionByName(own, allowMissingColumns=True).withColumns(running(after, "t"))
    done = join_on(tailed.where(F.col("__row").isNotNull()).select(*by, "__row.*", "__tc", "__tn", "__ts", "__tq"), middle, keys)

    zero = F.lit(0.0)
    parts = []  # (count, distance of the mean from the row's block mean, squares around the mean)
    for part, centre in (("h", "__c"), ("m", "__k"), ("t", "__tc")):
        n, s, q = (F.coalesce(F.col(f"__{part}{c}").cast("double"), zero) for c in "nsq")
        mean = F.try_divide(s, n)
        parts.append((n, F.coalesce(F.col(centre) - F.col("__c") + mean, zero), q - F.coalesce(mean * s, zero)))
    n = sum((p[0] for p in parts), zero)
    mean = F.try_divide(sum((p[0] * p[1] for p in parts), zero), n)
    squares = sum((p[2] + p[0] * (p[1] - mean) * (p[1] - mean) for p in parts), zero)
    value = F.when(n > 1, F.sqrt(F.greatest(squares, zero) / (n - 1)))
    return done.withColumn(out, value).select(*[c for c in df.columns if c != "__block"], out)


def ewm_mean(
    df: DataFrame, by, order, col: str, alpha: float, out: str = "ewm", split_rows: int | None = SPLIT_ROWS
) -> DataFrame:
    """Exponentially weighted mean y = (1-a)·y_before + a·x, starting at the first
    value; missing values are passed over and show the mean so far.

    No task has to walk a whole key: see ``_faded_sums``.
    """
    if not 0 < alpha <= 1:
        raise ValueError("alpha must be in (0, 1]")
    by = names(by)
    known = df.withColumn("__seen", F.col(col).isNotNull().cast("bigint"))
    # the number of known values up to the row; 0 before the first one
    placed = scan(known, by, order, {"__at": ("sum", "__seen")}, split_rows=split_rows)
    weight = F.when(F.col("__at") == 1, F.lit(1.0)).otherwise(F.lit(float(alpha)))
    rows = placed.where("__seen = 1").withColumn("__x", weight * F.col(col).cast("double"))
    if alpha < 1:
        rows = _faded_sums(rows.withColumn("__at", F.col("__at") - 1), by, "__at", "__x", math.log1p(-alpha), out)
        rows = rows.withColumn("__at", F.col("__at") + 1)
    else:
        rows = rows.withColumn(out, F.col("__x"))
    done = rows.drop("__seen", "__x")
    shown = done.select(*by, "__at", out)
    missing = join_on(placed.where("__seen = 0").drop("__seen"), shown, [*by, "__at"])
    return done.unionByName(missing).drop("__at")


def _faded_sums(df: DataFrame, by: list[str], at: str, x: str, fade: float, out: str, level: int = 0) -> DataFrame:
    """Add ``out``: the sum of ``x`` over the rows up to this one, each times exp(fade · its distance). ``at`` numbers
    the rows of a key from 0 without gaps.

    Inside blocks of rows that is a running sum of x·exp(-fade·i), times exp(fade·i); blocks are short enough for
    these to stay finite doubles. A block takes over the sum at the end of the block before. Where a million rows fade
    to less than 1e-250, that is the end value alone, as older blocks are lost to double precision anyway. Otherwise
    the end values, one row for a million, are faded sums in their own right, and the same is done with them.
    """
    limit = max(1, int(250 * math.log(10) / -fade))
    size = min(BLOCK_ROWS, limit)
    block, i, local, carry = (f"__{name}{level}" for name in ("block", "i", "local", "carry"))
    rows = df.withColumns({block: F.floor(F.col(at) / size).cast("bigint"), i: F.col(at) % size})
    w = W.partitionBy(*by, block).orderBy(i).rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn(local, F.sum(F.col(x) * F.exp(F.col(i) * -fade)).over(w) * F.exp(F.col(i) * fade))
    ends = rows.where(F.col(i) == size - 1).select(*by, block, F.col(local).alias(carry))
    if size < limit:
        total = f"__total{level}"
        ends = _faded_sums(ends, by, block, carry, fade * size, total, level + 1).drop(carry).withColumnRenamed(total, carry)
    ends = ends.withColumn(block, F.col(block) + 1)
    carried = F.coalesce(carry, F.lit(0.0)) * F.exp((F.col(i) + 1) * fade)
    return join_on(rows, ends, [*by, block]).withColumn(out, F.col(local) + carried).drop(block, i, local, carry)


def slot(ts: str, every: str) -> Column:
    """Start of the hour, day, … as ``timestamp_ntz`` (``date_trunc`` adds a zone)."""
    return F.date_trunc(every, ts).cast("timestamp_ntz")


def resample(df: DataFrame, ts: str, every: str, aggs: Sequence[Column], by=None) -> DataFrame:
    """Aggregate on a regular grid (``every``: hour, day, week, month, …); empty
    slots between the first and the last one appear with NULLs.

    With ``by`` every group gets a grid from its own first to its own last slot.
    """
    by = names(by)
    filled = df.withColumn("slot", slot(ts, every)).groupBy(*by, "slot").agg(*aggs)
    ends = filled.groupBy(*by).agg(F.min("slot").alias("lo"), F.max("slot").alias("hi"))
    grid = ends.select(
        *by, F.explode(F.sequence("lo", "hi", F.expr("interval 3 month" if every == "quarter" else f"interval 1 {every}"))).alias("slot")
    )
    return join_on(grid, filled, [*by, "slot"])


def date_parts(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    """Year, quarter, month, day, weekday (Monday is 0), ISO week and day of year."""
    parts = {
        "year": F.year(ts), "quarter": F.quarter(ts), "month": F.month(ts), "day": F.dayofmonth(ts),
        "weekday": F.weekday(ts), "week": F.weekofyear(ts), "dayofyear": F.dayofyear(ts),
    }
    return df.withColumns({prefix + k: v.cast("int") for k, v in parts.items()})
