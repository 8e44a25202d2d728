"""Feature preparation. Fitted steps are ``pyspark.ml`` estimators:
``step(...).fit(train)`` learns from the train split only, ``.transform(df)`` is lazy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import (
    Bucketizer, FeatureHasher, MaxAbsScaler, MinMaxScaler, Normalizer, PolynomialExpansion, SQLTransformer,
    StandardScaler, VectorAssembler,
)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.stat import Correlation
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from framewright.functions.exprs import attach, finite, join_on, names
from framewright.operators.categories import chi2_independence, one_hot, ordinal_encode, target_encode  # noqa: F401
from framewright.operators.components import PrincipalComponents
from framewright.operators.ordered import hot_keys, quantile_table
from framewright.operators.selection import kept_columns, select_univariate, select_variance, univariate_scores  # noqa: F401
from framewright.operators.timeseries import rank_table

# a token is a run of letters of any script
TOKEN_BREAK = r"[^\p{L}]+"


class ArrayToVector(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """An array column as an ML vector, usable inside a pipeline; NULL stays NULL."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        vec = F.col(self.getInputCol()).cast("array<double>")
        return dataset.withColumn(self.getOutputCol(), F.when(vec.isNotNull(), array_to_vector(vec)))


def _drop(*cols: str) -> SQLTransformer:
    listed = ", ".join(f"`{c}`" for c in cols)
    return SQLTransformer(statement=f"SELECT * EXCEPT ({listed}) FROM __THIS__")


def _on_vector(inputs: str | Sequence[str], output: str, step: Estimator | Transformer) -> Pipeline:
    """Assemble the inputs, run ``step`` on the vector, drop the assembled column."""
    raw = f"{output}__raw"
    step = step.copy({step.getParam("outputCol"): output})
    step.set(step.getParam("featuresCol" if step.hasParam("featuresCol") else "inputCol"), raw)
    return Pipeline(stages=[VectorAssembler(inputCols=names(inputs), outputCol=raw), step, _drop(raw)])


class ColumnScaler(Estimator, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Scales each input (x - offset) · factor. Statistics skip missing values, which stay missing: NaN in the
    output vector, as a vector holds no NULL. Vector inputs are left to Spark's own scaler of the same kind."""

    kind = Param(Params._dummy(), "kind", "standard, minmax or maxabs", TypeConverters.toString)
    first = Param(Params._dummy(), "first", "standard: 1 to centre; minmax: low end", TypeConverters.toFloat)
    second = Param(Params._dummy(), "second", "standard: 1 to divide; minmax: high end", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCol: str | None = None, kind: str = "standard",
                 first: float = 1.0, second: float = 1.0):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        cols, kind = self.getInputCols(), self.getOrDefault("kind")
        a, b = self.getOrDefault("first"), self.getOrDefault("second")
        if any(not isinstance(dataset.schema[c].dataType, NumericType) for c in cols):
            step = {
                "standard": lambda: StandardScaler(withMean=bool(a), withStd=bool(b)),
                "minmax": lambda: MinMaxScaler(min=a, max=b), "maxabs": MaxAbsScaler,
            }[kind]()
            return _on_vector(cols, self.getOutputCol(), step).fit(dataset)
        x = {c: finite(F.col(c).cast("double")) for c in cols}
        found = dataset.agg(*[
            F.struct(F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("low"), F.max(v).alias("high")).alias(f"s{i}")
            for i, v in enumerate(x.values())
        ]).first()
        exprs, scaled = [], []
        for i, c in enumerate(cols):
            s = found[f"s{i}"]
            if s["mean"] is None:
                offset, factor, add = 0.0, 1.0, 0.0  # nothing but missing values
            elif kind == "standard":
                offset, factor, add = (s["mean"] if a else 0.0), ((1 / s["std"] if s["std"] else 0.0) if b else 1.0), 0.0
            elif kind == "minmax":
                width = s["high"] - s["low"]
                offset, factor, add = s["low"], ((b - a) / width if width else 0.0), (a if width else (a + b) / 2)
            else:
                offset, factor, add = 0.0, 1 / (max(abs(s["low"]), abs(s["high"])) or 1.0), 0.0
            scaled.append(f"{self.getOutputCol()}__{i}")
            exprs.append(f"(CAST(`{c}` AS DOUBLE) - ({offset!r}D)) * ({factor!r}D) + ({add!r}D) AS `{scaled[-1]}`")
        return PipelineModel(stages=[
            SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__"),
            VectorAssembler(inputCols=scaled, outputCol=self.getOutputCol(), handleInvalid="keep"),
            _drop(*scaled),
        ])


def scale_standard(inputs, output: str, with_mean: bool = True, with_std: bool = True) -> ColumnScaler:
    """Mean 0 and sample standard deviation 1."""
    return ColumnScaler(inputCols=names(inputs), outputCol=output, kind="standard", first=float(with_mean), second=float(with_std))


def scale_minmax(inputs, output: str, low: float = 0.0, high: float = 1.0) -> ColumnScaler:
    return ColumnScaler(inputCols=names(inputs), outputCol=output, kind="minmax", first=float(low), second=float(high))


def scale_maxabs(inputs, output: str) -> ColumnScaler:
    return ColumnScaler(inputCols=names(inputs), outputCol=output, kind="maxabs", first=0.0, second=0.0)


def normalize_rows(inputs, output: str, p: float = 2.0) -> Pipeline:
    return _on_vector(inputs, output, Normalizer(p=p))


def polynomial(inputs, output: str, degree: int = 2) -> Pipeline:
    """For (x, y) and degree 2: x, x², y, xy, y²."""
    return _on_vector(inputs, output, PolynomialExpansion(degree=degree))


class RobustScaler(Estimator, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """(x - median) / IQR with exact quartiles; the built-in scaler approximates them."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        scaled, exprs, cols = [], [], self.getInputCols()
        long = dataset.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "value")
        # one row per input column
        quartiles = {r["column"]: r for r in quantile_table(long, "value", [0.25, 0.5, 0.75], "column").collect()}
        for i, c in enumerate(cols):
            # a column of missing values only is not scaled, and stays missing
            q25, q50, q75 = (quartiles[c][q] for q in ("q0", "q1", "q2")) if c in quartiles else (0.0, 0.0, 0.0)
            width = (q75 - q25) or 1.0
            scaled.append(f"{self.getOutputCol()}__{i}")
            exprs.append(f"(CAST(`{c}` AS DOUBLE) - ({q50!r}D)) / ({width!r}D) AS `{scaled[-1]}`")
        return PipelineModel(stages=[
            SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__"),
            VectorAssembler(inputCols=scaled, outputCol=self.getOutputCol(), handleInvalid="keep"),
            _drop(*scaled),
        ])


def scale_robust(inputs, output: str) -> RobustScaler:
    return RobustScaler(inputCols=names(inputs), outputCol=output)


def bin_fixed(input: str, output: str, edges: Sequence[float]) -> Bucketizer:
    """Bin number from given edges; bins are [a, b), the last one is closed."""
    return Bucketizer(inputCol=input, outputCol=output, splits=list(edges), handleInvalid="keep")


class QuantileBinner(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Bins cut at exact quantiles; the built-in discretizer approximates them."""

    bins = Param(Params._dummy(), "bins", "number of bins", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None, bins: int | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> Bucketizer:
        n = self.getOrDefault(self.bins)
        edges = quantile_table(dataset, self.getInputCol(), [i / n for i in range(1, n)]).drop("n", "distinct").first()
        inner = sorted(set(edges)) if edges else []
        splits = [float("-inf"), *inner, float("inf")]
        if len(splits) < 3:  # one bin: the bucketizer wants an inner edge nothing reaches
            splits = [float("-inf"), 1.7976931348623157e308, float("inf")]
        return Bucketizer(
            inputCol=self.getInputCol(), outputCol=self.getOutputCol(), splits=splits, handleInvalid="keep"
        )


def bin_quantile(input: str, output: str, bins: int) -> QuantileBinner:
    return QuantileBinner(inputCol=input, outputCol=output, bins=bins)


def tokens(text: str):
    """Lower-case letter runs of a text column."""
    return F.array_remove(F.split(F.lower(F.col(text)), TOKEN_BREAK), "")


def bag_of_words(df: DataFrame, text: str, by: str | Sequence[str]) -> DataFrame:
    """Token counts per ``by`` (a document id, or any group of documents)."""
    by = names(by)
    return df.select(*by, F.explode(tokens(text)).alias("token")).groupBy(*by, "token").agg(F.count("*").alias("n"))


def tfidf(df: DataFrame, text: str, by: str | Sequence[str]) -> DataFrame:
    """Term count times ln((N + 1) / (df + 1)) per document and token, N counting
    every document. The vocabulary stays a table and is not cut off."""
    by = names(by)
    counts = bag_of_words(df, text, by)
    seen = counts.groupBy("token").agg(F.count("*").alias("__df"))
    size = df.select(*by).distinct().agg(F.count("*").alias("__docs"))
    rated = attach(join_on(counts, seen, "token"), size, None)
    idf = F.log((F.col("__docs") + F.lit(1.0)) / (F.col("__df") + F.lit(1.0)))
    return rated.select(*by, "token", F.col("n").alias("tf"), (F.col("n") * idf).alias("tfidf"))


def hash_features(inputs, output: str, size: int = 1 << 18) -> FeatureHasher:
    """Numbers and categories hashed into a vector of fixed length."""
    return FeatureHasher(inputCols=names(inputs), outputCol=output, numFeatures=size)


def pca(input: str, output: str, k: int) -> Pipeline:
    """First ``k`` principal components of an array column (not centred on output)."""
    raw = f"{output}__raw"
    step = PrincipalComponents(inputCol=raw, outputCol=output, k=k)
    return Pipeline(stages=[ArrayToVector(inputCol=input, outputCol=raw), step, _drop(raw)])


def correlation(df: DataFrame, cols: Sequence[str], method: str = "pearson") -> DataFrame:
    """Correlation matrix in long form (a, b, r), over rows without missing values.

    Spearman is Pearson on average ranks; each column is ranked by its distinct values.
    """
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    if method == "spearman":
        hot = hot_keys(rows, None)
        ranks = {c: rank_table(rows, None, c, out="__rank", hot=hot) for c in cols}
        for c, table in ranks.items():
            rows = join_on(rows, table, c).withColumn(c, F.col("__rank")).drop("__rank")
    elif method != "pearson":
        raise ValueError(f"unknown correlation {method!r}")
    vectors = VectorAssembler(inputCols=list(cols), outputCol="__v").transform(rows).select("__v")
    matrix = Correlation.corr(vectors, "__v").first()[0].toArray()
    cells = [(a, b, float(matrix[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(cells, "a string, b string, r double")
