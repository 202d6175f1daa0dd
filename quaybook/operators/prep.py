"""Model preprocessing P1-P6 and balanced class weights M6, as Spark ML
pipeline stages, so everything is fitted on the rows being fitted (inside
each fold) and nothing leaks from held-out rows.

Spark's tree learners reject NaN/NULL features, while the original models
accept missing values natively; numeric features are therefore imputed with
the training median and carry a 0/1 missing indicator (P1b). This is a
documented difference, not an emulation.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import (Imputer, OneHotEncoder, SQLTransformer, StringIndexerModel,
                                VectorAssembler)
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaybook.config import CATEGORICAL_FEATURES, MISSING_CATEGORY, NUMERIC_FEATURES

ALL_FEATURES = tuple(NUMERIC_FEATURES) + tuple(CATEGORICAL_FEATURES)
FEATURES_COL = "features"


def prepared_sql(numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES, source: str = "__THIS__") -> str:
    """P1 / P1b / P2 as one projection: ``<c>__cat`` is the category as text
    with NULL as 'missing', ``<c>__num`` the number as double (NULL stays
    NULL), ``<c>__missing`` 1.0 where it is NULL."""
    select = ["*"]
    select += [f"coalesce(CAST(`{c}` AS STRING), '{MISSING_CATEGORY}') AS `{c}__cat`" for c in categorical]
    select += [f"CAST(`{c}` AS DOUBLE) AS `{c}__num`" for c in numeric]
    select += [f"CASE WHEN `{c}` IS NULL THEN 1.0D ELSE 0.0D END AS `{c}__missing`" for c in numeric]
    return f"SELECT {', '.join(select)} FROM {source}"


def prepared_columns(df: DataFrame, numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES) -> DataFrame:
    """The first step of ``preprocessor_v1`` on its own."""
    return SQLTransformer(statement=prepared_sql(numeric, categorical)).transform(df)


# --- P3 -----------------------------------------------------------------------
def category_dictionary(df: DataFrame, cols=CATEGORICAL_FEATURES) -> DataFrame:
    """(feature, category, category_index): the alphabetical index of each
    category of each feature; NULL counts as 'missing'. One unpivot of all
    columns and one distinct (a hot category collapses before the shuffle);
    the ranking windows hold one feature's categories each."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"),
                               F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CATEGORY)).alias("category")) for c in cols])
    known = df.select(F.explode(pairs).alias("p")).select("p.feature", "p.category").distinct()
    place = F.row_number().over(Window.partitionBy("feature").orderBy("category"))
    return known.withColumn("category_index", (place - 1).cast("int"))


def category_indexes(df: DataFrame, dictionary: DataFrame, cols=CATEGORICAL_FEATURES, suffix: str = "__idx") -> DataFrame:
    """Adds each category's index by the dictionary; one that it lacks gets
    the number after the last, as in the model's indexer. Each feature's part
    of the dictionary is joined, broadcast if Spark finds it small enough."""
    out = df
    for c in cols:
        part = dictionary.where(F.col("feature") == c).select(F.struct(F.col("category")).alias("__key"), F.col("category_index").alias("__i"))
        key = F.struct(F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CATEGORY)).alias("category"))
        size = part.agg(F.count(F.lit(1)).cast("int")).scalar()
        out = (out.withColumn("__key", key).join(part, "__key", "left")
               .withColumn(c + suffix, F.coalesce("__i", size)).drop("__key", "__i"))
    return out


class DictionaryIndexer(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """P3 as a pipeline stage: the categories of ``category_dictionary`` in an
    indexer model for each column, which numbers unseen ones after the last."""

    inputCols = Param(Params._dummy(), "inputCols", "category columns", typeConverter=TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "index columns", typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        names = self.getOrDefault(self.inputCols)
        # A model is held by the driver and every task, so its labels are too;
        # they come sorted, one row per feature.
        labels = {r.feature: r.labels for r in category_dictionary(dataset, names).groupBy("feature").agg(
            F.array_sort(F.collect_list("category")).alias("labels")).collect()}
        return PipelineModel([StringIndexerModel.from_labels(labels.get(c, []), inputCol=c, outputCol=out, handleInvalid="keep")
                              for c, out in zip(names, self.getOrDefault(self.outputCols))])


# --- M6 -----------------------------------------------------------------------
class _WeightParams(HasLabelCol, HasWeightCol):
    classes = Param(Params._dummy(), "classes", "class values",
                    typeConverter=TypeConverters.toListFloat)
    weights = Param(Params._dummy(), "weights", "weight per class",
                    typeConverter=TypeConverters.toListFloat)


class BalancedClassWeights(Estimator, _WeightParams, DefaultParamsReadable,
                           DefaultParamsWritable):
    """M6: ``w_c = n / (k * n_c)`` from the rows being fitted. The class
    counts are one grouped count (a result bounded by the number of classes)."""

    @keyword_only
    def __init__(self, *, labelCol: str = "label", weightCol: str = "weight"):
        super().__init__()
        self._set(labelCol=labelCol, weightCol=weightCol)

    def _fit(self, dataset: DataFrame) -> "BalancedClassWeightsModel":
        label = self.getLabelCol()
        counts = dataset.groupBy(label).count().where(F.col(label).isNotNull()).collect()
        n = sum(r["count"] for r in counts)
        k = len(counts)
        classes = [float(r[label]) for r in counts]
        weights = [n / (k * r["count"]) for r in counts]
        model = BalancedClassWeightsModel(labelCol=label, weightCol=self.getWeightCol())
        return model._set(classes=classes, weights=weights)


class BalancedClassWeightsModel(Model, _WeightParams, DefaultParamsReadable,
                                DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, labelCol: str = "label", weightCol: str = "weight"):
        super().__init__()
        self._set(labelCol=labelCol, weightCol=weightCol)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        label = self.getLabelCol()
        if label not in dataset.columns:
            return dataset.withColumn(self.getWeightCol(), F.lit(1.0))
        y = F.col(label).cast("double")
        w = F.lit(1.0)
        for c, v in zip(self.getOrDefault(self.classes), self.getOrDefault(self.weights)):
            w = F.when(y == F.lit(c), F.lit(v)).otherwise(w)
        return dataset.withColumn(self.getWeightCol(), w)


def class_weight_table(df: DataFrame, label: str = "label") -> DataFrame:
    """M6 as a table: class, rows, weight (for reports and the SQL oracle)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    n = F.sum("rows").over(_all_rows())
    k = F.count(F.lit(1)).over(_all_rows())
    return counts.select(F.col(label).alias("class"), "rows",
                         (n / (k * F.col("rows"))).alias("weight"))


def _all_rows():
    return Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


# --- P4 / P6 ------------------------------------------------------------------
def preprocessor_v1(numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES,
                    label: str = "label", weighted: bool = True,
                    features_col: str = FEATURES_COL) -> list:
    """Fill categories (P2), cast numerics (P1), impute + indicators
    (P1b), index categories alphabetically and one-hot encode them (P3:
    unseen categories give an all-zero block of the same length), assemble
    one-hot block then numerics; optional balanced weights (M6)."""
    numeric = list(numeric)
    categorical = list(categorical)
    stages = [
        SQLTransformer(statement=prepared_sql(numeric, categorical)),
        Imputer(strategy="median", inputCols=[f"{c}__num" for c in numeric],
                outputCols=[f"{c}__imp" for c in numeric]),
        DictionaryIndexer(inputCols=[f"{c}__cat" for c in categorical],
                          outputCols=[f"{c}__idx" for c in categorical]),
        OneHotEncoder(inputCols=[f"{c}__idx" for c in categorical],
                      outputCols=[f"{c}__ohe" for c in categorical], dropLast=True),
        VectorAssembler(inputCols=[f"{c}__ohe" for c in categorical]
                        + [f"{c}__imp" for c in numeric]
                        + [f"{c}__missing" for c in numeric],
                        outputCol=features_col),
    ]
    if weighted:
        stages.append(BalancedClassWeights(labelCol=label, weightCol="weight"))
    return stages


PREPROCESSORS = {"preprocessor_v1": preprocessor_v1}


def build_preprocessor(config: dict, **kwargs) -> list:
    """Preprocessor stages by name; unknown name -> ValueError."""
    make = PREPROCESSORS.get(config.get("type"))
    if make is None:
        raise ValueError(f"no preprocessor is called {config.get('type')!r}; there are {', '.join(PREPROCESSORS)}")
    return make(**kwargs)
