"""Line deduplication over a whole corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from framewright.llm.common import LOWER, SPACE, UPPER, text_key, written


def line_keys(text: Column) -> Column:
    """Array of the keys of a text's lines: outer white space cut, A-Z in lower case."""

    def key(line: Column) -> Column:
        cut = F.btrim(line, F.lit(SPACE))
        only_ascii = F.octet_length(cut) == F.length(cut)
        return F.when(only_ascii, F.lower(cut)).otherwise(F.translate(cut, UPPER, LOWER))

    return F.transform(F.split(text, "\n"), key)


def drop_repeated_lines(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3, prefix: str = ""
) -> DataFrame:
    """Rows of ``df`` without the lines that many documents share, and what was dropped.

    A line counts by its key (outer white space cut, A-Z lower-cased). Keys of at least
    ``min_chars`` code points found in at least ``min_docs`` distinct documents lose all their
    lines except in the document with the largest id. Adds ``n_lines`` (before), ``n_dropped`` and ``kept`` (the other
    lines, joined by a line feed).

    Lines are exploded as 128-bit hashes with their positions, never as texts. Documents per hash
    are counted in two steps, first by (hash, document), so a line that most documents hold is
    added up before it is shuffled. The dropped positions go back to their row, which takes its
    lines apart again.

    NULL or empty text: one empty line, kept. A NULL id never counts as a document and never keeps
    a shared line. Rows with the same id are one document, each row is cut by itself. An empty
    table gives no rows. Other columns pass through; those that have a new name already are replaced, which
    ``prefix`` avoids. Names starting with ``__fw_`` are reserved.
    """
    one = F.coalesce(F.col(text), F.lit(""))
    row = text_key(F.coalesce(F.col(doc_id).cast("string"), F.lit("\0")), one)
    rows = df.select("*", row[0].alias("__fw_r1"), row[1].alias("__fw_r2"))

    keyed = rows.select("__fw_r1", "__fw_r2", F.col(doc_id).alias("__fw_id"), line_keys(one).alias("__fw_keys"))
    # the outer form: a text has one line at least, and Spark would compute the keys once more to filter empty arrays
    lines = keyed.select("__fw_r1", "__fw_r2", "__fw_id", F.posexplode_outer("__fw_keys").alias("__fw_pos", "__fw_key"))
    lines = lines.where(F.length("__fw_key") >= min_chars)
    h = text_key("__fw_key")
    lines = lines.select("__fw_r1", "__fw_r2", "__fw_id", "__fw_pos", h[0].alias("__fw_h1"), h[1].alias("__fw_h2"))

    held = lines.where(F.col("__fw_id").isNotNull()).select("__fw_h1", "__fw_h2", "__fw_id").distinct()
    shared = (
        held.groupBy("__fw_h1", "__fw_h2")
        .agg(F.count("*").alias("__fw_docs"), F.max("__fw_id").alias("__fw_keeper"))
        .where(F.col("__fw_docs") >= min_docs)
        .drop("__fw_docs")
    )
    shared = written(shared, "shared-lines")  # AQE splits a hot line only if both sides of the join are shuffled for it
    dropped = (
        lines.join(shared, ["__fw_h1", "__fw_h2"])
        .where(~F.col("__fw_id").eqNullSafe(F.col("__fw_keeper")))
        .groupBy("__fw_r1", "__fw_r2")
        .agg(F.collect_set("__fw_pos").alias("__fw_drop"))
        .select(F.col("__fw_r1").alias("__fw_d1"), F.col("__fw_r2").alias("__fw_d2"), F.array_sort("__fw_drop").alias("__fw_drop"))
    )
    out = rows.join(dropped, (F.col("__fw_r1") == F.col("__fw_d1")) & (F.col("__fw_r2") == F.col("__fw_d2")), "left")
    parts = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    positions = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__fw_drop"))
    kept = F.when(F.col("__fw_drop").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(
        F.array_join(F.transform(positions, lambda i: F.get(parts, i)), "\n")
    )
    made = {
        f"{prefix}n_lines": F.size(parts).cast("long"),
        f"{prefix}n_dropped": F.coalesce(F.size("__fw_drop"), F.lit(0)).cast("long"),
        f"{prefix}kept": kept,
    }
    return out.select(*[F.col(c) for c in df.columns if c not in made], *[v.alias(k) for k, v in made.items()])
