"""Joins, stacking and set operations."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from framewright.functions.exprs import all_of, micros, names
from framewright.operators.hotjoin import hot_join
from framewright.operators.ordered import SPLIT_ROWS, scan
from framewright.session import checkpointed, stored


#: Doublings of the smallest cell of an interval join, and cells of the largest size that an interval is listed under.
MOST_SIZES, MOST_CELLS = 40, 1 << 14
#: Points and intervals in a block of an interval join, pairs for a task, tasks at most, and blocks that share all pairs at least.
POINT_ROWS, SPAN_ROWS, TASK_PAIRS, MOST_TASKS, SHARES = 1 << 16, 1 << 17, 1 << 25, 1 << 14, 100


def select_filter(df: DataFrame, exprs: Sequence[str | Column], where: str | Column | None = None) -> DataFrame:
    """Project or derive columns from the rows that satisfy ``where``."""
    rows = df if where is None else df.where(where)
    return rows.select(*[F.expr(e) if isinstance(e, str) else e for e in exprs])


def merge(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    salt: int | None = None,
    split: bool | None = None,
    cell_rows: int | None = None,
) -> DataFrame:
    """Equi-join on columns both sides have; the keys appear once.

    AQE picks broadcast or sort-merge from measured sizes and splits skewed partitions of inner, left and right joins.
    It cannot split a full outer join, so that one takes ``hot_join``, which finds hot keys by a sketch;
    ``split`` asks for it, or for Spark's join, in any form. ``salt`` spreads a hot key by hand for inner and left joins:
    left rows are dealt over ``salt`` copies of the right side.
    """
    on = names(on)
    if salt is None:
        if how in ("outer", "full", "full_outer") if split is None else split:
            return hot_join(left, right, on, how, cell_rows)
        return left.join(right, on, how)
    if how not in ("inner", "left", "left_outer"):
        raise ValueError("a salted merge is an inner or a left join")
    dealt = left.withColumn("__salt", F.pmod(F.xxhash64(*left.columns), F.lit(salt)).cast("int"))
    copies = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return dealt.join(copies, [*on, "__salt"], how).drop("__salt")


def merge_semi_anti(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "semi", cell_rows: int | None = None
) -> DataFrame:
    """Left rows that have (semi) or lack (anti) a partner on the right.

    Only the distinct keys of the right side matter, and they are made distinct before the shuffle. AQE does not split a
    join above such an aggregate, so hot keys of the left side are found and split by ``hot_join``.
    """
    if how not in ("semi", "anti"):
        raise ValueError("how is 'semi' or 'anti'")
    return hot_join(left, right, on, how, cell_rows)


def _units(value: str | Column, base: float, unit: float, top: int) -> Column:
    """How many units a value lies above ``base``, from 0 to ``top``; it never falls where the value rises."""
    at = F.floor((F.least(F.greatest(F.col(value).cast("double"), F.lit(base)), F.lit(base + unit * top)) - F.lit(base)) / F.lit(unit))
    return F.when(F.isnan(F.col(value).cast("double")), F.lit(top).cast("bigint")).otherwise(F.least(at, F.lit(top).cast("bigint")))


def merge_where(
    left: DataFrame,
    right: DataFrame,
    value: str,
    low: str,
    high: str,
    by: str | Sequence[str] | None = None,
    width: float | None = None,
    cell_rows: int | None = None,
) -> DataFrame:
    """Interval join: pairs with ``low <= value <= high`` (and equal ``by``).

    The value range is cut into units of ``width`` (default: the mean length of the intervals, halved until a unit holds few
    points) and units into cells of 1, 2, 4, ... of them, up to a largest size. An interval is listed under the fewest cells that make
    it up, at most two of each smaller size, a value under its one cell of each size that an interval is listed under, so each pair
    meets in one cell of an equi-join and there is no nested loop. The largest size is the one that lists the fewest rows: with large
    cells long intervals are listed seldom, but a value once for each size, and an interval that meets many values has to be
    copied to many blocks of them anyway. Infinite ends reach the end of the range. Cells are counted on both sides first; one
    with too many rows of a side (``cell_rows``), or too many pairs, is cut into a grid of blocks, and the number of tasks follows the pairs.
    A NULL value or end matches nothing; NaN counts as larger than any number, as in Spark's comparisons.
    Column names must differ between sides, except ``by``. Ends and cells are read when this is called.
    """
    by = names(by)
    points, spans = left.where(F.col(value).isNotNull()), right.where(F.col(low) <= F.col(high))
    ends = [F.col(c).cast("double") for c in (low, high)]
    known = [F.when(~F.isnan(e) & (F.abs(e) < float("inf")), e) for e in ends]
    span = F.when(known[0].isNotNull() & known[1].isNotNull(), ends[1] - ends[0])
    mean, first, last = spans.agg(
        F.avg(F.when(span < float("inf"), span)), F.min(F.least(*known)), F.max(F.greatest(*known))
    ).first()
    base, length = first if first is not None else 0.0, (last - first) if first is not None else 0.0
    if length == float("inf"):  # ends so far apart that their distance is no double
        base, length = 0.0, last
    n = F.col("__n").cast("double")
    total, squares = points.groupBy(*by).agg(F.count("*").alias("__n")).agg(F.sum(n), F.sum(n * n)).first()
    near = squares / total if total else 0.0  # points with the same ``by`` as a point
    rows = cell_rows or POINT_ROWS, cell_rows or SPAN_ROWS
    unit, wanted = max(float(width or mean or 1.0), length / 2**MOST_SIZES), rows[0] / 4
    while not width and near * unit > wanted * length and unit / 2 >= length / 2**MOST_SIZES > 0:
        unit /= 2
    sizes = 1
    while 2**sizes < length / unit + 2:
        sizes += 1
    top = 2**sizes - 1
    end = min(top, int(length / unit) + 1)  # no value has a higher unit, and what reaches it has no end of its own
    a, b = _units(low, base, unit, end), _units(high, base, unit, end)
    units = {"__a": a, "__b": F.when(b >= end, F.lit(top).cast("bigint")).otherwise(b)}

    starts = [F.shiftright(F.col("__a") + (2**k - 1), k) for k in range(sizes + 1)]  # the cells of 2^k units inside an interval
    stops = [F.shiftright(F.col("__b") + 1, k) - 1 for k in range(sizes + 1)]
    lasts = [F.least(stop, F.lit(end >> k).cast("bigint")) for k, stop in enumerate(stops)]
    inside = [start <= last for start, last in zip(starts, lasts)]
    alone = [  # those that have no parent inside
        [(cell, found & (F.pmod(cell, F.lit(2)) == odd)) for cell, odd in ((start, 1), (stop, 0))]
        for start, stop, found in zip(starts, stops, inside)
    ]
    whole = [F.when(found, last - start + 1).otherwise(0).cast("double") for start, last, found in zip(starts, lasts, inside)]
    seen = spans.withColumns(units).agg(
        *[F.sum(sum((F.when(odd, 1).otherwise(0) for _, odd in pair), F.lit(0)).cast("double")) for pair in alone],
        *[F.sum(w) for w in whole], *[F.max(w) for w in whole],
    ).first()
    few, many, longest = ([x or 0.0 for x in seen[i * (sizes + 1) : (i + 1) * (sizes + 1)]] for i in range(3))
    blocks = [max(1.0, near / wanted * (min(1.0, 2**k * unit / length) if length else 1.0)) for k in range(sizes + 1)]

    def listings(largest: int) -> float:
        """Rows of both sides, if cells have at most 2^largest units."""
        found = [*few[:largest], many[largest]]
        return (total or 0.0) * sum(x > 0 for x in found) + sum(x * y for x, y in zip(found, blocks))

    largest = min((k for k in range(sizes + 1) if longest[k] <= MOST_CELLS or k == sizes), key=listings)
    used = [k for k, x in enumerate([*few[:largest], many[largest]]) if x > 0]  # at most MOST_SIZES + 2 numbers
    as_cell = lambda k, cell: F.struct(F.lit(k).alias("k"), cell.alias("cell"))
    small = F.array(*[F.when(odd, as_cell(k, cell)) for k in range(largest) for cell, odd in alone[k]])
    large = F.transform(F.sequence(starts[largest], lasts[largest]), lambda cell: as_cell(largest, cell))
    listing = F.when(inside[largest], large).otherwise(F.array().cast("array<struct<k:int,cell:bigint>>"))
    if largest:
        listing = F.concat(F.filter(small, lambda c: c.isNotNull()), listing)
    probes = F.array(*[as_cell(k, F.shiftright(F.col("__at"), k)) for k in used or [0]])

    def listed(side: DataFrame, cells: Column, *cols: str) -> DataFrame:
        return side.select(*cols, F.explode(cells).alias("__c")).select(*cols, F.col("__c.k").alias("__size"), F.col("__c.cell").alias("__cell"))

    def points_listed(side: DataFrame, *more: str) -> DataFrame:
        return listed(side.withColumn("__at", _units(value, base, unit, end)), probes, *left.columns, *more)

    def spans_listed(side: DataFrame, *more: str) -> DataFrame:
        return listed(side.withColumns(units), listing, *right.columns, *more)

    found = _blocks_join(points, points_listed, spans, spans_listed, [*by, "__size", "__cell"], *rows)
    return found.where((F.col(value) >= F.col(low)) & (F.col(value) <= F.col(high))).drop("__size", "__cell")


def _blocks_join(
    points: DataFrame, points_listed: Callable[..., DataFrame], spans: DataFrame, spans_listed: Callable[..., DataFrame],
    on: list[str], point_rows: int, span_rows: int,
) -> DataFrame:
    """Inner join of ``points_listed(points)`` and ``spans_listed(spans)`` by blocks of at most about ``point_rows`` and ``span_rows`` rows.

    Both sides are counted by key. Points are streamed past the intervals of their block, which are held in memory. A block has at most
    ``TASK_PAIRS`` pairs, or a hundredth of all: blocks of a fixed size would be copied more often the more pairs there are. The
    rows of a key are dealt over its blocks by a random number, which a lost executor must not draw anew: where a key is split, both
    sides are checkpointed with it before they are listed. Each task meets about as many pairs, however many there are in
    all, so neither a hash of few keys nor the number of files decides how long it runs.
    """
    spark = points.sparkSession
    n_l = points_listed(points).groupBy(*on).agg(F.count("*").alias("__l"))
    n_r = spans_listed(spans).groupBy(*on).agg(F.count("*").alias("__r"))
    counts = stored(n_l.join(n_r, on), "merge-where-cells")
    met = F.col("__l").cast("double") * F.col("__r")
    pairs = counts.agg(F.sum(met)).first()[0] or 0.0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_TASKS, int(pairs / TASK_PAIRS)))
    most = max(float(TASK_PAIRS), pairs / SHARES)

    def blocks(own: str, other: str, rows: int) -> Column:
        by_pairs = F.ceil(F.col(own) * F.least(F.col(other), F.lit(most**0.5)) / most)
        return F.when(met > most, F.greatest(by_pairs, F.ceil(F.col(own) / rows))).otherwise(F.ceil(F.col(own) / rows)).cast("int")

    grid = counts.select(*on, blocks("__l", "__r", point_rows).alias("__a"), blocks("__r", "__l", span_rows).alias("__b"))
    grid = grid.where((F.col("__a") > 1) | (F.col("__b") > 1))
    if grid.limit(1).count():
        points = checkpointed(points.withColumn("__deal", F.rand(29)))
        spans = checkpointed(spans.withColumn("__deal", F.rand(31)))

        def dealt(side: DataFrame, own: str, cells: str, theirs: str, copies: str) -> DataFrame:
            side, n, times = side.join(grid, on, "left"), F.coalesce(cells, F.lit(1)), F.coalesce(copies, F.lit(1))
            side = side.withColumn(own, F.least(F.floor(F.col("__deal") * n).cast("int"), n - 1))
            return side.withColumn(theirs, F.explode(F.sequence(F.lit(0), times - 1))).drop("__deal", "__a", "__b")

        l = dealt(points_listed(points, "__deal"), "__i", "__a", "__j", "__b")
        r = dealt(spans_listed(spans, "__deal"), "__j", "__b", "__i", "__a")
        on = [*on, "__i", "__j"]
    else:
        l, r = points_listed(points), spans_listed(spans)
    met = l.repartition(tasks, *on).join(r.repartition(tasks, *on).hint("shuffle_hash"), on)
    return met.drop("__i", "__j")


def merge_asof(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: str | Sequence[str],
    direction: str = "backward",
    tolerance: float | None = None,
    ties: Sequence[str] = (),
    suffix: str = "_right",
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Each left row with the last right row at or before it (``backward``), the
    first one at or after it (``forward``) or the closer of both (``nearest``,
    the earlier one when both are as far).

    Both sides are stacked and the right row is carried along by a running value,
    so there is no non-equi join, and a hot key is split. Among right rows of
    equal time the last (backward) or first (forward) in ``ties`` order counts.
    ``tolerance`` is the largest distance: seconds for timestamps, days for dates, else units of
    ``on``. Left rows without a match, or with a NULL time or key, keep NULLs.
    """
    by = names(by)
    kind = dict(left.dtypes)[on]
    payload = [c for c in right.columns if c not in by]
    names_out = {c: c + suffix if c in left.columns else c for c in payload}
    l_side = left.select(
        *by, F.col(on).alias("__t"), F.struct(*left.columns).alias("__l"),
    )
    usable = all_of(F.col(c).isNotNull() for c in [on, *by])
    r_side = right.where(usable).select(
        *by, F.col(on).alias("__t"), F.struct(*payload).alias("__r")
    ).withColumn("__ties", F.struct(*[F.col("__r").getField(c) for c in ties], F.xxhash64("__r")))
    both = l_side.unionByName(r_side, allowMissingColumns=True)
    both = both.withColumn("__is_left", F.col("__l").isNotNull().cast("int"))

    def gap(c: str) -> Column:
        other = F.col(c).getField(on)
        if kind.startswith("timestamp"):
            return F.abs(micros("__t") - micros(other)) / F.lit(1e6)
        if kind == "date":
            return F.abs(F.datediff("__t", other))
        return F.abs(F.col("__t") - other)

    # At equal times right rows stand first, so that looking back finds them; looking
    # forward only, they stand last. Looking both ways, back already found them.
    kinds = {"backward": ["last"], "forward": ["next"], "nearest": ["last", "next"]}[direction]
    side = F.col("__is_left").desc() if direction == "forward" else F.col("__is_left").asc()
    found = scan(
        both, by, [F.col("__t"), side, F.col("__ties")], {f"__{k}": (k, "__r") for k in kinds}, split_rows=split_rows
    ).where("__is_left = 1")
    match = F.col(f"__{kinds[0]}")
    if direction == "nearest":
        closer = F.col("__last").isNull() | (gap("__next") < gap("__last"))
        match = F.when(closer, F.col("__next")).otherwise(F.col("__last"))
    found = found.withColumn("__m", F.when(F.col("__t").isNotNull(), match))
    if tolerance is not None:
        found = found.withColumn("__m", F.when(gap("__m") <= F.lit(tolerance), F.col("__m")))
    return found.select("__l.*", *[F.col("__m").getField(c).alias(names_out[c]) for c in payload])


def concat(dfs: Sequence[DataFrame]) -> DataFrame:
    """Stack tables by column name; a missing column is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def set_ops(left: DataFrame, right: DataFrame, op: str) -> DataFrame:
    """union, union_all, intersect, intersect_all, except or except_all of whole rows.

    The forms without repeats count both sides in one aggregation, so that copies of
    a row are merged before the shuffle; a join would send every copy to one task.
    """
    cols = left.columns

    def present(where: str) -> DataFrame:
        sides = left.select(*cols, F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionByName(
            right.select(*cols, F.lit(0).alias("__l"), F.lit(1).alias("__r"))
        )
        seen = sides.groupBy(*cols).agg(F.max("__l").alias("__l"), F.max("__r").alias("__r"))
        return seen.where(where).select(*cols)

    ops = {
        "union": lambda: left.unionByName(right).distinct(),
        "union_all": lambda: left.unionByName(right),
        "intersect": lambda: present("__l = 1 and __r = 1"),
        "intersect_all": lambda: left.intersectAll(right.select(*cols)),
        "except": lambda: present("__l = 1 and __r = 0"),
        "except_all": lambda: left.exceptAll(right.select(*cols)),
    }
    if op not in ops:
        raise ValueError(f"unknown set operation {op!r}, one of {sorted(ops)}")
    return ops[op]()


