"""Quality rules: counts per document and a log-likelihood ratio of hashed n-grams, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from framewright.llm.common import SPACE

SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Letters of a word's end that the model sees; whole words are added where they are asked for.
ENDING = 3


def with_words(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``__fw_text`` and ``__fw_words``, its runs without ASCII white space."""
    out = df.withColumn("__fw_text", F.coalesce(F.col(text), F.lit("")))
    return out.withColumn("__fw_words", F.array_remove(F.split("__fw_text", SPLIT), ""))


def base_rules(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long) and base_failed.

    Words are runs without ASCII white space. A line counts as repeated if it has a word and equals an earlier line.
    n_repeat_words counts the words inside 3-word windows found twice or more in the text, the first
    included. Windows are compared by 64-bit hashes: sorted with their positions, so the work is n log n for any text.
    base_failed: fewer than 50 words, or more than half of them repeated. NULL counts as an empty text.
    Names starting with ``__fw_`` are reserved; columns that have a new name already are replaced.
    """
    zero = F.lit(0)
    out = df if "__fw_words" in df.columns else with_words(df, text)
    lines = F.filter(F.split("__fw_text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    windows = F.transform(
        "__fw_words", lambda w, i: F.xxhash64(w, F.get("__fw_words", i + 1), F.get("__fw_words", i + 2))
    )
    out = out.withColumns({
        "__fw_n": F.size("__fw_words"),
        "__fw_chars": F.aggregate("__fw_words", zero, lambda total, w: total + F.length(w)),
        "__fw_symbols": F.regexp_count("__fw_text", F.lit(SYMBOLS)),
        "__fw_lines": lines,
        "__fw_all": windows,
    })
    whole = F.slice("__fw_all", F.lit(1), F.greatest(F.col("__fw_n") - 2, zero))
    out = out.withColumns({"__fw_dup": F.size("__fw_lines") - F.size(F.array_distinct("__fw_lines")), "__fw_hash": whole})
    again = F.size(F.array_distinct("__fw_hash")) < F.size("__fw_hash")
    nothing = F.array().cast("array<struct<h: bigint, i: int>>")
    out = out.withColumn("__fw_sorted", F.when(again, F.sort_array(F.transform("__fw_hash", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(nothing))
    out = out.drop("__fw_hash").withColumns({"__fw_h": F.col("__fw_sorted.h"), "__fw_i": F.col("__fw_sorted.i")})
    m = F.size("__fw_h")
    near = F.arrays_zip(
        F.col("__fw_h").alias("h"), F.col("__fw_i").alias("i"),
        F.slice("__fw_h", F.lit(2), F.greatest(m - 1, zero)).alias("next"),
        F.concat(F.array(F.lit(None).cast("bigint")), F.slice("__fw_h", F.lit(1), F.greatest(m - 1, zero))).alias("last"),
    )
    twice = F.filter(near, lambda z: (z["h"] == z["next"]) | (z["h"] == z["last"]))
    out = out.withColumn("__fw_at", F.when(m > 0, F.sort_array(F.transform(twice, lambda z: z["i"]))).otherwise(F.array().cast("array<int>")))
    size = F.size("__fw_at")
    steps = F.zip_with("__fw_at", F.slice("__fw_at", F.lit(2), F.greatest(size - 1, zero)), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    repeated = F.aggregate(steps, F.lit(0), lambda total, step: total + step).cast("long")
    words = F.col("__fw_n").cast("long")
    made = {
        "n_words": words, "word_chars": F.col("__fw_chars").cast("long"), "n_symbols": F.col("__fw_symbols").cast("long"),
        "n_dup_lines": F.col("__fw_dup").cast("long"), "n_repeat_words": F.col("__fw_rep"),
        "base_failed": (words < 50) | (100 * F.col("__fw_rep") > 50 * words),
    }
    out = out.withColumn("__fw_rep", repeated)
    return finished(out, df.columns, {prefix + k: v for k, v in made.items()})


def finished(df: DataFrame, rest: list[str], made: dict[str, Column]) -> DataFrame:
    """``rest`` and the columns of ``made``, which come out of a generator of one row: Spark would otherwise push a later
    filter on them down into the expressions, and compute these many times over."""
    row = F.inline(F.array(F.struct(*[v.alias(k) for k, v in made.items()])))
    return df.select(*[F.col(c) for c in rest if c not in made], row)


def with_grams(df: DataFrame, buckets: int, whole: bool = False) -> DataFrame:
    """``df`` with ``__fw_grams``: buckets of the hashed 1-grams and 2-grams of the endings of ``__fw_words``, and
    with ``whole`` of the words themselves as well."""
    in_bucket = lambda h: F.pmod(h, F.lit(buckets))
    forms = {"ends": lambda w: F.xxhash64(F.right(w, F.lit(ENDING)))} | ({"all": F.xxhash64} if whole else {})
    out, grams = df, []
    for name, form in forms.items():
        col = f"__fw_{name}"
        out = out.withColumn(col, F.transform("__fw_words", lambda w: form(w)))
        pairs = F.transform(col, lambda h, i: in_bucket(F.xxhash64(h, F.get(col, i + 1))))
        out = out.withColumn(f"{col}_pairs", pairs)
        n = F.greatest(F.size(col) - 1, F.lit(0))
        grams += [F.transform(col, in_bucket), F.slice(f"{col}_pairs", F.lit(1), n)]
    return out.withColumn("__fw_grams", F.concat(*grams)).drop(*[f"__fw_{k}{x}" for k in forms for x in ("", "_pairs")])


def log_ratios(df: DataFrame, trusted_ids: DataFrame, doc_id: str, text: str, buckets: int, whole: bool = False) -> DataFrame:
    """(bucket, weight): log of the bucket's share in trusted documents over its share in all documents.

    Both multinomials are counted over every document, whole, in one pass and smoothed by one
    count a bucket. The result has at most ``buckets`` rows. Without trusted documents every weight is 0.
    """
    ids = trusted_ids.select(F.col(doc_id).alias("__fw_id")).where(F.col("__fw_id").isNotNull()).distinct()
    ids = ids.hint("merge")  # the same plan at every size
    marked = df.select(F.col(doc_id).alias("__fw_d"), F.col(text).alias("__fw_t")).join(ids, F.col("__fw_d") == F.col("__fw_id"), "left")
    marked = marked.select("__fw_t", F.col("__fw_id").isNotNull().cast("int").alias("__fw_good"))
    marked = with_grams(with_words(marked, "__fw_t"), buckets, whole)
    counts = (
        # the outer form: Spark would compute the grams several times more to filter empty arrays
        marked.select("__fw_good", F.explode_outer("__fw_grams").alias("bucket")).where("bucket is not null")
        .groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("__fw_good").alias("good"))
    )
    total = counts.agg(F.sum("raw").alias("raws"), F.sum("good").alias("goods"))
    share = lambda c, t: (F.col(c) + 1.0) / (F.col(t) + float(buckets))
    weight = F.when(F.col("goods") > 0, F.log(share("good", "goods")) - F.log(share("raw", "raws"))).otherwise(0.0)
    both = total.select(F.struct("raws", "goods").alias("s")).scalar()
    sums = counts.withColumns({"raws": both.getField("raws"), "goods": both.getField("goods")})
    return sums.select("bucket", weight.alias("weight"))


def quality(
    df: DataFrame, trusted_ids: DataFrame, doc_id: str = "doc_id", text: str = "text",
    buckets: int = 1 << 14, least: float = -0.5, prefix: str = "", whole: bool = False,
) -> DataFrame:
    """``df`` with the columns of ``base_rules``, ``llr`` and ``kept``.

    The model sees the last ``ENDING`` characters of each word, with ``whole`` (as in the queries) each whole word too, case and marks
    included, as hashed 1-grams and 2-grams. Whole words alone are too rare to tell by them junk made of new words.
    ``llr`` is the mean over a document's grams of log(share of the gram's bucket in trusted
    documents / share in all documents). A document is kept if no base rule fails and ``llr`` is ``least`` or more,
    a fixed threshold: the same document with the same counts always gets the same verdict. The weights, at most
    ``buckets`` numbers, are one array that every task gets.

    NULL and empty texts fail the base rules; their ``llr`` is 0. Rows with a NULL id are never trusted. Repeated rows count
    once each. Without trusted ids only the base rules decide. An empty table gives no rows.
    """
    weights = dict(map(tuple, log_ratios(df, trusted_ids, doc_id, text, buckets, whole).collect()))  # at most ``buckets`` rows
    lookup = F.split(F.lit(",".join(repr(weights.get(b, 0.0)) for b in range(buckets))), ",").cast("array<double>")

    words = with_grams(with_words(df, text), buckets, whole)
    out = base_rules(words, text, prefix)
    total = F.aggregate("__fw_grams", F.lit(0.0), lambda s, g: s + F.get(lookup, g))
    out = out.withColumn("__fw_size", F.size("__fw_grams")).withColumn("__fw_sum", total)
    llr = F.when(F.col("__fw_size") > 0, F.col("__fw_sum") / F.col("__fw_size")).otherwise(0.0)
    out = out.withColumn("__fw_llr", llr)
    kept = ~F.col(f"{prefix}base_failed") & (F.col("__fw_llr") >= least)
    rest = [c for c in out.columns if not c.startswith("__fw_")]
    return finished(out, rest, {f"{prefix}llr": F.col("__fw_llr"), f"{prefix}kept": kept})
