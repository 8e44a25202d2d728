"""Class weights and batch inference."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType

from framewright.functions.exprs import attach, join_on, names


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Rows with n / (classes · rows of the class), so that classes weigh the same."""
    sizes = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("__c"))
    whole = sizes.agg(F.sum("__c").alias("__n"), F.count("*").alias("__k"))
    weight = F.col("__n") / (F.col("__k") * F.col("__c"))
    weights = attach(sizes, whole, None).select(label, weight.alias(out))
    return join_on(df, weights, label)


def batch_predict(
    df: DataFrame,
    make_fn: Callable,
    cols: str | Sequence[str],
    out: str = "prediction",
    return_type: DataType = DoubleType(),
    batch_size: int = 1024,
) -> DataFrame:
    """Vectorised inference: ``make_fn()`` loads the model once per Python worker and
    returns a function from NumPy batches to predictions. Array columns must share one length.
    Rows with a NULL in any input get a NULL prediction."""
    cols = names(cols)
    udf_args = {"return_type": return_type, "batch_size": batch_size}
    arrays = [isinstance(df.schema[c].dataType, ArrayType) for c in cols]
    if any(arrays):
        first = df.select(*cols).dropna().first()
        shapes = [[len(first[c])] if a and first else None for c, a in zip(cols, arrays)]
        udf_args["input_tensor_shapes"] = [s or ([1] if a else None) for s, a in zip(shapes, arrays)]
    known = F.lit(True)
    for c in cols:
        known = known & F.col(c).isNotNull()
    predict = predict_batch_udf(make_fn, **udf_args)
    whole = df.where(known).withColumn(out, predict(*cols))
    return whole.unionByName(df.where(~known).withColumn(out, F.lit(None).cast(return_type)))
