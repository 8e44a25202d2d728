"""Sources and sinks: CSV, JSON, Parquet and ORC with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from framewright.functions.exprs import names

FORMATS = ("csv", "json", "parquet", "orc")


def _checked(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} is not one of {FORMATS}")
    return fmt


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Read files. Text formats need a schema: inferring one costs a second
    pass over the data and can change from file to file."""
    if _checked(fmt) in ("csv", "json") and schema is None:
        raise ValueError(f"reading {fmt} needs a schema")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        options = {"header": "true", "mode": "FAILFAST", "escape": '"', "multiLine": "false"} | options
    elif fmt == "json":
        options = {"mode": "FAILFAST"} | options
    return reader.options(**options).load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    keys: str | Sequence[str] | None = None,
    files: int | None = None,
    mode: str = "error",
    **options: str,
) -> None:
    """Write files, one folder per value of ``keys``.

    Without ``files`` every task writes its own rows and nothing is shuffled.
    ``files`` gathers the rows first, for many small inputs; a hash of the whole
    row is part of the shuffle key, so one hot key value is still spread out.
    """
    keys = names(keys)
    if files:
        spread = F.pmod(F.xxhash64(*df.columns), F.lit(files))
        df = df.repartition(files, spread, *keys) if not keys else df.repartition(files, *keys, spread)
    if fmt == "csv":
        options = {"header": "true", "escape": '"'} | options
    df.write.format(_checked(fmt)).partitionBy(*keys).mode(mode).options(**options).save(path)


def flatten_json(
    df: DataFrame, col: str, schema: StructType | str, prefix: str = "", keep: bool = False
) -> DataFrame:
    """Replace a JSON text column by one typed column per top-level field.

    Text that is not JSON gives NULL in every field.
    """
    parsed = df.withColumn("__json", F.from_json(F.col(col), schema))
    fields = parsed.schema["__json"].dataType.names
    kept = [c for c in df.columns if keep or c != col]
    return parsed.select(*kept, *[F.col("__json").getField(f).alias(prefix + f) for f in fields])
