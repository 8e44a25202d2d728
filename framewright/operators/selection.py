"""Choosing features by variance or by a test against a label. Missing values are left out feature by feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import UnivariateFeatureSelector, VarianceThresholdSelector, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from framewright.functions.exprs import finite, join_on, names
from framewright.functions.special import chi2_p, f_p
from framewright.operators.categories import contingency


def variances(df: DataFrame, inputs: Sequence[str]) -> dict[str, float | None]:
    """Sample variance of each column over its values that are there; None with fewer than two."""
    found = df.agg(*[F.var_samp(finite(F.col(c).cast("double"))).alias(f"v{i}") for i, c in enumerate(inputs)]).first()
    return {c: found[f"v{i}"] for i, c in enumerate(inputs)}


def _long(df: DataFrame, inputs: Sequence[str], label: str, kind: str) -> DataFrame:
    """(feature, x, y) of every pair that is there."""
    y = finite(F.col(label).cast("double")) if kind == "number" else F.col(label).cast("string")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), finite(F.col(c).cast("double")).alias("x")) for c in inputs]))
    return df.select(cells.alias("c"), y.alias("y")).select("c.*", "y").dropna()


def univariate_scores(
    df: DataFrame, inputs: Sequence[str], label: str, feature_type: str = "continuous", label_type: str = "categorical"
) -> DataFrame:
    """(feature, statistic, dof, rest, n, p_value): each feature's test against the label, over the rows where both are there.

    Continuous features and a categorical label: ANOVA's F, from the count, mean and squared deviations of each class, which
    are merged from partial ones; a continuous label: F of the correlation; categorical features and label: chi² (``rest``
    is NULL). A feature that is the same in all of its rows has the statistic 0 if continuous. A test without degrees of freedom has a NULL statistic, a
    p-value NaN, and so has a feature without rows no row at all.
    """
    inputs = names(inputs)
    if (feature_type, label_type) == ("categorical", "categorical"):
        out = None
        for c in inputs:  # rows are left out feature by feature
            one = contingency(df.select(c, label), [c], label)
            out = one if out is None else out.unionByName(one)
        p = chi2_p(F.col("statistic"), F.col("dof"))
        return out.select(F.col("column").alias("feature"), "statistic", F.col("dof").cast("bigint").alias("dof"), F.lit(None).cast("bigint").alias("rest"), "n", p.alias("p_value"))
    if (feature_type, label_type) == ("continuous", "categorical"):
        long = _long(df, inputs, label, "class")
        classes = long.groupBy("feature", "y").agg(F.count("*").alias("c"), F.avg("x").alias("m"), F.var_pop("x").alias("v"))
        whole = classes.groupBy("feature").agg((F.sum(F.col("c") * F.col("m")) / F.sum("c")).alias("mean"))
        away = F.col("m") - F.col("mean")
        sums = join_on(classes, whole, "feature").groupBy("feature").agg(
            F.sum(F.col("c") * away * away).alias("between"), F.sum(F.col("c") * F.col("v")).alias("within"),
            (F.count("*") - 1).alias("dof"), F.sum("c").alias("n"),
        ).withColumn("rest", F.col("n") - F.col("dof") - 1)
        ratio = (F.col("between") / F.col("dof")) / (F.col("within") / F.col("rest"))
    elif (feature_type, label_type) == ("continuous", "continuous"):
        long = _long(df, inputs, label, "number")
        sums = long.groupBy("feature").agg(
            F.corr("x", "y").alias("r"), F.lit(1).cast("bigint").alias("dof"), F.count("*").alias("n"),
            F.var_pop("x").alias("between"), F.var_pop("y").alias("within"),
        ).withColumn("rest", F.col("n") - 2)
        square = F.col("r") * F.col("r")
        ratio = F.when(square < 1, square / (1 - square) * F.col("rest")).otherwise(F.lit(float("inf")))
    else:
        raise ValueError("features are continuous, or both sides are categorical")
    enough = (F.col("dof") > 0) & (F.col("rest") > 0)
    flat = (F.col("between") == 0) | ((F.col("within") == 0) if label_type == "continuous" else F.lit(False))
    statistic = F.when(enough & flat, F.lit(0.0)).when(enough & (F.col("within") == 0), F.lit(float("inf"))).when(enough, ratio)
    out = sums.withColumn("statistic", statistic)
    p = f_p(F.coalesce("statistic", F.lit(float("nan"))), F.col("dof"), F.col("rest"))
    return out.select("feature", "statistic", "dof", "rest", "n", p.alias("p_value"))


class SelectedColumns(Model, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """The chosen columns as one vector; missing values are NaN in it, as a vector holds no NULL."""

    kept = Param(Params._dummy(), "kept", "positions of the chosen columns", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCol: str | None = None, kept: list[int] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def selectedFeatures(self) -> list[int]:
        return sorted(self.getOrDefault("kept"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = [self.getInputCols()[i] for i in self.selectedFeatures]
        raw = [f"__{self.getOutputCol()}_{i}" for i in range(len(cols))]
        rows = dataset.withColumns({r: F.col(c).cast("double") for r, c in zip(raw, cols)})
        return VectorAssembler(inputCols=raw, outputCol=self.getOutputCol(), handleInvalid="keep").transform(rows).drop(*raw)


class ColumnSelector(Estimator, HasInputCols, HasOutputCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Chooses columns in one pass over them. Vector inputs are left to Spark's own selectors, which need every value."""

    kind = Param(Params._dummy(), "kind", "variance or univariate", TypeConverters.toString)
    threshold = Param(Params._dummy(), "threshold", "variance that a column must exceed", TypeConverters.toFloat)
    k = Param(Params._dummy(), "k", "number of columns to keep", TypeConverters.toInt)
    featureType = Param(Params._dummy(), "featureType", "continuous or categorical", TypeConverters.toString)
    labelType = Param(Params._dummy(), "labelType", "continuous or categorical", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCol: str | None = None, kind: str = "variance", threshold: float = 0.0,
                 k: int = 1, labelCol: str | None = None, featureType: str = "continuous", labelType: str = "categorical"):
        super().__init__()
        self._setDefault(kind="variance", threshold=0.0, k=1, featureType="continuous", labelType="categorical")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame):
        cols, kind = self.getInputCols(), self.getOrDefault("kind")
        types = (self.getOrDefault("featureType"), self.getOrDefault("labelType"))
        if types[0] == "continuous" and any(not isinstance(dataset.schema[c].dataType, NumericType) for c in cols):
            return self._on_vector(cols, kind, types).fit(dataset)
        if kind == "variance":
            found = variances(dataset, cols)
            kept = [i for i, c in enumerate(cols) if (found[c] or 0.0) > self.getOrDefault("threshold")]
        else:
            scores = univariate_scores(dataset, cols, self.getLabelCol(), *types).collect()  # one row for each column
            known = {r["feature"]: (r["p_value"], -r["statistic"]) for r in scores if r["statistic"] is not None}
            best = sorted((i for i, c in enumerate(cols) if c in known), key=lambda i: (*known[cols[i]], i))
            kept = sorted(best[:self.getOrDefault("k")])
        return SelectedColumns(inputCols=cols, outputCol=self.getOutputCol(), kept=kept)

    def _on_vector(self, cols: list[str], kind: str, types: tuple[str, str]):
        from framewright.operators.features import _on_vector

        if kind == "variance":
            return _on_vector(cols, self.getOutputCol(), VarianceThresholdSelector(varianceThreshold=self.getOrDefault("threshold")))
        selector = UnivariateFeatureSelector(labelCol=self.getLabelCol())
        selector.setFeatureType(types[0]).setLabelType(types[1]).setSelectionMode("numTopFeatures").setSelectionThreshold(self.getOrDefault("k"))
        return _on_vector(cols, self.getOutputCol(), selector)


def select_variance(inputs, output: str, threshold: float = 0.0) -> ColumnSelector:
    """Keep the columns whose sample variance exceeds ``threshold``; missing values do not count."""
    return ColumnSelector(inputCols=names(inputs), outputCol=output, kind="variance", threshold=float(threshold))


def select_univariate(
    inputs, output: str, label: str, k: int, feature_type: str = "continuous", label_type: str = "categorical"
) -> ColumnSelector:
    """Keep the ``k`` columns with the smallest p-value against the label (see ``univariate_scores``), ties by statistic."""
    return ColumnSelector(
        inputCols=names(inputs), outputCol=output, kind="univariate", k=k, labelCol=label, featureType=feature_type, labelType=label_type
    )


def kept_columns(model: PipelineModel | SelectedColumns, inputs: Sequence[str]) -> list[str]:
    """Names behind a fitted ``select_variance`` / ``select_univariate`` step."""
    step = model.stages[1] if isinstance(model, PipelineModel) else model
    return [names(inputs)[i] for i in sorted(step.selectedFeatures)]
