"""Equi-joins that split hot keys. A sketch finds them, their rows are dealt over cells, and partner rows are copied."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from framewright.functions.exprs import all_of, names
from framewright.session import checkpointed

#: Cells of a hot key for each partition it would fill: enough to spread evenly by hash.
CELLS = 8
#: Rows of a cell at least, unless the caller says otherwise.
LEAST_CELL = 10_000
#: Most keys that a sketch tracks, so the table of hot keys is small whatever the data.
MOST_TRACKED = 1 << 17
KINDS = {"inner": "inner", "left": "left", "left_outer": "left", "right": "right", "right_outer": "right", "outer": "outer",
         "full": "outer", "full_outer": "outer", "semi": "semi", "left_semi": "semi", "anti": "anti", "left_anti": "anti"}


def hot_cells(df: DataFrame, on: Sequence[str], cell_rows: int | None = None) -> dict[int, int]:
    """Hashes of the keys of ``df`` that hold much of it, and the number of cells for each.

    One pass over the key columns with Spark's frequent-items sketch, which is merged from partial ones, so a hot key costs
    no more than another. A key is hot if it has more rows than two cells. A cell is an eighth of an even
    partition and ``LEAST_CELL`` rows at least, or ``cell_rows``. NULL keys have no partners and are left out.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = 1 << 12
    while tracked < min(MOST_TRACKED, 4 * CELLS * parts):
        tracked *= 2
    keys = df.where(all_of(F.col(c).isNotNull() for c in on)).select(F.xxhash64(*on).alias("h"))
    found = keys.agg(F.expr(f"approx_top_k(h, {tracked // 4}, {tracked})").alias("top"), F.count("*").alias("n")).first()
    cell = cell_rows or max(LEAST_CELL, found["n"] // (CELLS * parts))
    return {r["item"]: -(-r["count"] // cell) for r in found["top"] or [] if r["count"] > 2 * cell}


def _dealt(df: DataFrame, cells: Column, out: str, copies: Column, theirs: str) -> DataFrame:
    """Rows with their own cell ``out``, once for each cell ``theirs`` of the other side.

    The rows of hot keys are dealt by chance, which a lost executor must not repeat in another way: they are checkpointed
    in the shared folder. Others have one cell and stay as they are."""
    rows = df.withColumn("__cells", cells)
    calm = rows.where("__cells = 1").withColumn(out, F.lit(0))
    hot = checkpointed(rows.where("__cells > 1").withColumn(out, F.floor(F.rand(29) * F.col("__cells")).cast("int")))
    both = calm.unionByName(hot).drop("__cells")
    return both.withColumn(theirs, F.explode(F.sequence(F.lit(0), copies - 1)))


def hot_join(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner", cell_rows: int | None = None
) -> DataFrame:
    """``left.join(right, on, how)`` in which no task gets a whole hot key; inner, left, right, outer, semi or anti.

    Rows of a hot key are dealt over cells on the side where it is hot, and the rows of that key on the other side are copied to
    every cell, so each pair meets once. If it is hot on both sides the cells form a grid. What has no partner is emitted
    once: rows with a NULL key never have one and do not enter the join; a left row whose key is hot on the right comes from
    an inner join and, where a hash misled, from an anti join; in a full outer join the right rows without a partner come
    from an anti join with the left keys. For semi and anti joins only the distinct keys of the right side count.

    The sketch is a pass over the key columns of each side when this is called. Columns are those of Spark's join: keys, then the
    rest of both sides. Names starting with ``__`` are reserved.
    """
    on, kind = names(on), KINDS.get(how)
    if kind is None:
        raise ValueError(f"unknown join {how!r}, one of {sorted(KINDS)}")
    if kind == "right":
        back = hot_join(right, left, on, "left", cell_rows)
        rest_r, rest_l = [c for c in right.columns if c not in on], [c for c in left.columns if c not in on]
        at = [*range(len(on)), *range(len(on) + len(rest_r), len(back.columns)), *range(len(on), len(on) + len(rest_r))]
        plain = back.toDF(*[f"__{i}" for i in range(len(back.columns))])
        return plain.select(*[f"__{i}" for i in at]).toDF(*on, *rest_l, *rest_r)

    rest_l, rest_r = [c for c in left.columns if c not in on], [c for c in right.columns if c not in on]
    keyed = all_of(F.col(c).isNotNull() for c in on)
    lefts = left.select(*on, *[F.col(c).alias(f"__l{i}") for i, c in enumerate(rest_l)], F.xxhash64(*on).alias("__h"))
    rights = right.select(*on, *[F.col(c).alias(f"__r{i}") for i, c in enumerate(rest_r)], F.xxhash64(*on).alias("__h"))
    l_cols, r_cols = [f"__l{i}" for i in range(len(rest_l))], [f"__r{i}" for i in range(len(rest_r))]
    kinds = rights.schema

    def no_partner(rows: DataFrame) -> DataFrame:
        return rows.select(*on, *l_cols, *[F.lit(None).cast(kinds[c].dataType).alias(c) for c in r_cols])

    if kind in ("semi", "anti"):
        rights = rights.select(*on, "__h").distinct()
    hot_l = hot_cells(left, on, cell_rows)
    hot_r = {} if kind in ("semi", "anti") else hot_cells(right, on, cell_rows)
    if not hot_l and not hot_r:
        return left.join(right.select(*on).distinct() if kind in ("semi", "anti") else right, on, f"left_{kind}" if kind in ("semi", "anti") else kind)

    table = [(h, hot_l.get(h, 1), hot_r.get(h, 1)) for h in hot_l.keys() | hot_r.keys()]
    hot = F.broadcast(left.sparkSession.createDataFrame(table, "__hot bigint, __a int, __b int"))  # at most MOST_TRACKED / 2 rows

    def marked(rows: DataFrame) -> DataFrame:
        out = rows.where(keyed).join(hot, F.col("__h") == F.col("__hot"), "left")
        return out.withColumns({"__a": F.coalesce("__a", F.lit(1)), "__b": F.coalesce("__b", F.lit(1))}).drop("__hot")

    def met(l: DataFrame, r: DataFrame, join: str) -> DataFrame:
        l = _dealt(l, F.col("__a"), "__i", F.col("__b"), "__j").drop("__a", "__b", "__h")
        r = _dealt(r, F.col("__b"), "__j", F.col("__a"), "__i").drop("__a", "__b", "__h")
        return l.join(r, [*on, "__i", "__j"], join)

    l, r = marked(lefts), marked(rights)
    if kind in ("semi", "anti"):
        out = met(l, r, f"left_{kind}").select(*on, *l_cols)
        if kind == "anti":
            out = out.union(lefts.where(~keyed).select(*on, *l_cols))
        return out.toDF(*on, *rest_l).select(*left.columns)

    cols = [*on, *l_cols, *r_cols]
    if kind == "inner":
        return met(l, r, "inner").select(*cols).toDF(*on, *rest_l, *rest_r)
    out = met(l.where("__b = 1"), r.where("__b = 1"), "left").select(*cols)
    if hot_r:
        both, keys = met(l.where("__b > 1"), r.where("__b > 1"), "inner").select(*cols), r.where("__b > 1").select(*on).distinct()
        out = out.union(both).union(no_partner(l.where("__b > 1").join(keys, on, "left_anti")))
    out = out.union(no_partner(lefts.where(~keyed)))
    if kind == "outer":
        alone = hot_join(rights.drop("__h"), left.select(*on), on, "anti", cell_rows)
        out = out.union(alone.select(*on, *[F.lit(None).cast(lefts.schema[c].dataType).alias(c) for c in l_cols], *r_cols))
    return out.toDF(*on, *rest_l, *rest_r)
