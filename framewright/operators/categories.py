"""Category encoders whose dictionaries are tables: no list of categories is on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from framewright.functions.exprs import join_on, names
from framewright.functions.special import chi2_p
from framewright.operators.ordered import positions
from framewright.session import new_path, stored

DICTIONARY = "column int, category string, n bigint, code bigint, value double"


def sparse_vector(indices: Column, values: Column, size: int) -> Column:
    """An ML vector of ``size`` from arrays, put together in the JVM: a vector's own fields, read as JSON."""
    fields = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values"))
    return F.from_json(F.to_json(F.struct(fields.alias("v"))), StructType([StructField("v", VectorUDT())]))["v"]


class _Kind(HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    kind = Param(Params._dummy(), "kind", "onehot, ordinal or target", TypeConverters.toString)
    unseen = Param(Params._dummy(), "unseen", "zero, keep, skip or error", TypeConverters.toString)


class CategoryModel(Model, _Kind):
    """A fitted encoder. Its dictionary (column, category, n, code, value) is a Parquet table that ``transform`` joins
    by category; a frequent category is a hot key of rows against a table, which AQE splits. Saving keeps the parameters and the
    table's path, so give ``path`` to the encoder where the shared folder is cleared."""

    path = Param(Params._dummy(), "path", "folder of the dictionary", TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "number of categories of each input", TypeConverters.toListInt)
    default = Param(Params._dummy(), "default", "value of an unseen category", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCol: str | None = None, kind: str = "onehot",
                 unseen: str = "zero", path: str | None = None, sizes: list[int] | None = None, default: float = 0.0):
        super().__init__()
        self._setDefault(kind="onehot", unseen="zero", default=0.0)
        self._set(**self._input_kwargs)

    def dictionary(self, df: DataFrame) -> DataFrame:
        return df.sparkSession.read.schema(DICTIONARY).parquet(self.getOrDefault("path"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        kind, unseen, out = (self.getOrDefault(p) for p in ("kind", "unseen", "outputCol"))
        sizes, found, rows = self.getOrDefault("sizes"), [], dataset
        wanted = "value" if kind == "target" else "code"
        for i, c in enumerate(self.getInputCols()):
            key, at = f"__{out}_{i}", f"__{out}_{i}_at"
            entries = self.dictionary(dataset).where(F.col("column") == i).select(F.col("category").alias(f"{key}_known"), F.col(wanted).alias(at), F.lit(True).alias(f"{at}_is"))
            rows = rows.withColumn(key, F.col(c).cast("string"))
            known = F.col(key) == F.col(f"{key}_known")
            # only the target encoder has an entry for NULL
            rows = rows.join(entries, F.col(key).eqNullSafe(F.col(f"{key}_known")) if kind == "target" else known, "left")
            value = F.col(at)
            if unseen == "error":
                message = F.concat(F.lit(f"column {c} has a category that was not there at fit time: "), F.coalesce(key, F.lit("NULL")))
                value = F.when(F.col(f"{at}_is"), value).otherwise(F.raise_error(message).cast("bigint"))
            found.append(value)
        helpers = [c for c in rows.columns if c not in dataset.columns]
        if kind == "onehot":
            starts = [sum(sizes[:i]) for i in range(len(sizes))]
            indices = F.filter(F.array(*[(v + s).cast("int") for v, s in zip(found, starts)]), lambda v: v.isNotNull())
            result = sparse_vector(indices, F.transform(indices, lambda _: F.lit(1.0)), sum(sizes))
        elif kind == "ordinal":
            if unseen == "skip":
                rows = rows.where(found[0].isNotNull())
            result = (F.coalesce(found[0], F.lit(sizes[0])) if unseen == "keep" else found[0]).cast("double")
        else:
            result = F.coalesce(found[0], F.lit(self.getOrDefault("default")))
        return rows.withColumn(out, result).drop(*[c for c in helpers if c != out])


class CategoryEncoder(Estimator, _Kind, HasLabelCol):
    """Learns a dictionary of categories: counted with partial sums, numbered in chunks, written as a table.

    Categories are compared as strings. Only the number of categories of each input, and the mean of a label, reach
    the driver."""

    smoothing = Param(Params._dummy(), "smoothing", "rows of the overall mean added to each category", TypeConverters.toFloat)
    path = Param(Params._dummy(), "path", "folder for the dictionary", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCol: str | None = None, kind: str = "onehot",
                 unseen: str = "zero", labelCol: str | None = None, smoothing: float = 0.0, path: str | None = None):
        super().__init__()
        self._setDefault(kind="onehot", unseen="zero", smoothing=0.0)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> CategoryModel:
        cols, kind = self.getInputCols(), self.getOrDefault("kind")
        target = kind == "target"
        label = F.col(self.getLabelCol()).cast("double") if target else F.lit(None).cast("double")
        cells = F.explode(F.array(*[F.struct(F.lit(i).alias("column"), F.col(c).cast("string").alias("category")) for i, c in enumerate(cols)]))
        rows = dataset.select(cells.alias("c"), label.alias("y")).select("c.*", "y")
        rows = rows.where(F.col("y").isNotNull() if target else F.col("category").isNotNull())
        counts = rows.groupBy("column", "category").agg(F.count("*").alias("n"), F.avg("y").alias("mean"))
        overall = 0.0
        if target:
            overall = dataset.select(label.alias("y")).agg(F.avg("y")).first()[0] or 0.0
            weight = F.col("n") / (F.col("n") + F.lit(self.getOrDefault("smoothing")))
            table = counts.select("column", "category", "n", F.lit(None).cast("bigint").alias("code"), (weight * F.col("mean") + (1 - weight) * overall).alias("value"))
        else:
            order = ["__less", "category"] if kind == "ordinal" else ["category"]
            numbered = positions(counts.withColumn("__less", -F.col("n")), ["column"], order, "at")
            table = numbered.select("column", "category", "n", (F.col("at") - 1).cast("bigint").alias("code"), F.lit(None).cast("double").alias("value"))
        path = self.getOrDefault("path") if self.isSet("path") else new_path(dataset.sparkSession, "categories")
        sizes = dict(map(tuple, stored(table, "categories", path).groupBy("column").count().collect()))
        return CategoryModel(
            inputCols=cols, outputCol=self.getOutputCol(), kind=kind, unseen=self.getOrDefault("unseen"), path=path,
            sizes=[sizes.get(i, 0) for i in range(len(cols))], default=float(overall),
        )


def one_hot(inputs, output: str, unseen: str = "zero", path: str | None = None) -> CategoryEncoder:
    """Indicators in alphabetical order of the categories, as one sparse vector. A category absent at fit time, and NULL,
    give all zeros (``zero``) or an ``error``."""
    if unseen not in ("zero", "error"):
        raise ValueError("unseen is 'zero' or 'error'")
    return CategoryEncoder(inputCols=names(inputs), outputCol=output, kind="onehot", unseen=unseen, path=path)


def ordinal_encode(input: str, output: str, unseen: str = "error", path: str | None = None) -> CategoryEncoder:
    """Category to index, most frequent first, ties by name. An unseen category or NULL is an ``error``, is left
    out (``skip``) or gets the index after the last (``keep``)."""
    if unseen not in ("error", "skip", "keep"):
        raise ValueError("unseen is 'error', 'skip' or 'keep'")
    return CategoryEncoder(inputCols=[input], outputCol=output, kind="ordinal", unseen=unseen, path=path)


def target_encode(input: str, output: str, label: str, smoothing: float = 0.0, path: str | None = None) -> CategoryEncoder:
    """Category to the mean of ``label`` in the fitted data, ``smoothing`` rows of the overall mean added. NULL is a category
    of its own; an unseen one gets the overall mean. Rows without a label are not learnt from."""
    return CategoryEncoder(inputCols=[input], outputCol=output, kind="target", unseen="zero", labelCol=label, smoothing=smoothing, path=path)


def contingency(rows: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """(column, statistic, dof, n): Pearson's chi² of each column against ``label``, over rows where both are there.

    Cells are counted once; each is joined with the totals of its row and column of the table of counts. Empty cells need no
    rows of their own, as chi² = n · (sum of cell² / (row · column) - 1). Nothing but the results leaves the tables."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("a")) for c in cols]))
    long = rows.select(pairs.alias("p"), F.col(label).cast("string").alias("b")).select("p.*", "b").dropna()
    cells = long.groupBy("column", "a", "b").agg(F.count("*").alias("n"))
    by_a = cells.groupBy("column", "a").agg(F.sum("n").alias("n_a"))
    by_b = cells.groupBy("column", "b").agg(F.sum("n").alias("n_b"))
    share = F.col("n") / F.col("n_a") * (F.col("n") / F.col("n_b"))
    sums = join_on(join_on(cells, by_a, ["column", "a"]), by_b, ["column", "b"]).groupBy("column").agg(
        F.sum(share).alias("s"), F.sum("n").alias("n")
    )
    sizes = by_a.groupBy("column").agg(F.count("*").alias("r")).join(
        by_b.groupBy("column").agg(F.count("*").alias("c")), "column"
    )
    statistic = F.col("n") * F.greatest(F.col("s") - 1, F.lit(0.0))
    return sums.join(sizes, "column").select(
        "column", statistic.alias("statistic"), ((F.col("r") - 1) * (F.col("c") - 1)).cast("int").alias("dof"), "n"
    )


def chi2_independence(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Pearson chi² test of each categorical column against ``label``: column, statistic, dof, p_value.

    Rows with any of the columns missing are left out. The p-value is NaN without degrees of freedom."""
    cols = names(cols)
    rows = df.select(*cols, label).dropna()
    out = contingency(rows, cols, label)
    return out.select("column", "statistic", "dof", chi2_p(F.col("statistic"), F.col("dof")).alias("p_value"))
