"""From raw documents to packed training sequences: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from framewright.llm.common import text_key, written
from framewright.llm.decontaminate import contaminated, find_benchmark
from framewright.llm.lines import drop_repeated_lines
from framewright.llm.neardup import near_duplicates
from framewright.llm.packing import pack
from framewright.llm.quality import quality
from framewright.registry import Tables, query


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; documents labelled as good are the trusted target.

    NULL and short texts are rejected (fewer than 50 words). Repeated rows get the same verdict. Empty tables stay empty."""
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    return quality(docs, trusted, prefix="__stage_", whole=True).where("__stage_kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least three of them share; ``n_chars`` is counted anew. No document goes,
    even if all of its lines do. NULL texts become empty."""
    out = drop_repeated_lines(docs, prefix="__stage_")
    new = {"text": F.col("__stage_kept"), "n_chars": F.length("__stage_kept").cast("bigint")}
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id. Of rows that repeat id and
    text one stays. Documents with a NULL id stay only if no other id is in their class."""
    classes = near_duplicates(docs.select("doc_id", "text")).where("kept")
    kept = written(
        classes.groupBy(F.col("doc_id").alias("__stage_id"), F.col("k1").alias("__stage_1"), F.col("k2").alias("__stage_2"))
        .agg(F.count("*").alias("__stage_n")), "kept",
    )
    key = text_key(F.coalesce("text", F.lit("")))
    rows = docs.select("*", key[0].alias("__stage_k1"), key[1].alias("__stage_k2"))
    same = (
        (F.col("__stage_k1") == F.col("__stage_1")) & (F.col("__stage_k2") == F.col("__stage_2"))
        & F.col("doc_id").eqNullSafe(F.col("__stage_id"))
    )
    out = rows.join(kept, same)
    if kept.where("__stage_n > 1").limit(1).count():  # rows that repeat id and text
        out = out.dropDuplicates(["doc_id", "__stage_k1", "__stage_k2"])
    return out.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less than a twentieth of whose words stand in passages of the benchmark. NULL and empty texts stay."""
    found = find_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out="__stage_found")
    return found.where(~contaminated("__stage_found")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2,048 tokens. A NULL text is the end token alone."""
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, with_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-duplicate removal", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("packing", packing),
]

#: SQL cannot tokenize texts or place pieces in sequences; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return docs


@query("pipeline", ORACLE_SQL)
def pipeline(t: Tables) -> DataFrame:
    return run(t.spark, t.path)
