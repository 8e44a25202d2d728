"""From text to fixed-length token sequences: vocabulary, encoding, windows, shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from framewright.functions.exprs import names
from framewright.operators.ordered import SPLIT_ROWS, positions

#: The id of tokens that a vocabulary lacks.
UNKNOWN = 0


def tokens_of(text: str) -> Column:
    """Tokens of a text: what spaces separate, in lower case; NULL has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), " "), "")


def build_vocab(
    df: DataFrame, text: str, min_count: int = 1, size: int | None = None, split_rows: int | None = SPLIT_ROWS
) -> DataFrame:
    """(token, n, id): ids from 1 by falling frequency, ties by token; ``UNKNOWN`` is left free.

    Tokens are counted before they are numbered, and a long list of tokens is numbered in chunks, not in one
    task. ``size`` keeps the first ids, as the largest vocabulary that is wanted."""
    counts = df.select(F.explode_outer(tokens_of(text)).alias("token")).where("token is not null").groupBy("token").agg(F.count("*").alias("n"))
    kept = counts.where(F.col("n") >= min_count).withColumn("__less", -F.col("n"))
    out = positions(kept, [], ["__less", "token"], "id", split_rows=split_rows).drop("__less")
    out = out.select("token", "n", F.col("id").cast("bigint").alias("id"))
    return out if size is None else out.where(F.col("id") <= size)


def encode_tokens(df: DataFrame, vocab: DataFrame, text: str, keys: str | Sequence[str], out: str = "ids") -> DataFrame:
    """``keys`` and ``out``: the token ids of each row's text, in order; ``keys`` tell rows apart.

    Tokens are joined to the vocabulary as rows, so the vocabulary may be of any size; a frequent token is a
    hot key that AQE splits. A text without tokens gives an empty array."""
    keys = names(keys)
    rows = df.select(*keys, F.posexplode_outer(tokens_of(text)).alias("__at", "__token"))
    known = vocab.select(F.col("token").alias("__known"), F.col("id").alias("__id"))
    found = rows.join(known, F.col("__token") == F.col("__known"), "left")
    cell = F.when(F.col("__at").isNotNull(), F.struct("__at", F.coalesce("__id", F.lit(UNKNOWN).cast("bigint")).alias("id")))
    return found.groupBy(*keys).agg(F.sort_array(F.collect_list(cell)).alias("__cells")).select(*keys, F.col("__cells.id").alias(out))


def sequence_windows(df: DataFrame, ids: str, length: int, stride: int | None = None, out: str = "window") -> DataFrame:
    """One row for each window of ``length`` ids, every ``stride`` (default: ``length``) ids, with its ``start``;
    the last may be shorter. Windows that only repeat the end of the one before are left out. No shuffle."""
    stride = stride or length
    last = F.greatest(F.ceil((F.size(ids) - length) / F.lit(stride)), F.lit(0)).cast("int")
    starts = F.when(F.size(ids) > 0, F.transform(F.sequence(F.lit(0), last), lambda k: k * stride))
    rows = df.withColumn("start", F.explode_outer(starts)).where("start is not null")
    return rows.withColumn(out, F.slice(F.col(ids), F.col("start") + 1, F.lit(length))).drop(ids)


def write_shards(df: DataFrame, path: str, shards: int, seed: int = 0, split_rows: int | None = SPLIT_ROWS) -> DataFrame:
    """Write ``df`` as ``shards`` Parquet files whose numbers of rows differ by one at most, in random order, and read
    it back with the file's number as ``shard``.

    The order is that of a hash of the row and ``seed``; rows that are equal stand side by side, told apart by where
    they were read. Rows are numbered in that order, in chunks of about ``split_rows``, so equal rows spread over chunks as
    well, and dealt to the shards in turn. The same rows give the same shards, however they were partitioned."""
    place = F.xxhash64(F.lit(seed), *[F.to_json(F.struct(c)) for c in df.columns])
    mixed = df.withColumns({"__place": place, "__row": F.monotonically_increasing_id()})
    mixed = positions(mixed, [], ["__place", "__row"], "__rank", split_rows=split_rows)
    mixed = mixed.withColumn("shard", F.pmod(F.col("__rank") - 1, F.lit(shards)).cast("int"))
    mixed = mixed.repartition(shards, "shard").sortWithinPartitions("shard", "__rank").drop("__place", "__row", "__rank")
    mixed.write.partitionBy("shard").parquet(path)
    return df.sparkSession.read.schema(mixed.schema).parquet(path)
