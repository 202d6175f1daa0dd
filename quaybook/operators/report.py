"""Report tables R1-R9 and R15 (the data behind the charts and tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaybook.config import (CATEGORICAL_FEATURES, MAX_RUNS_TO_CHECK, NUMERIC_FEATURES,
                             TARGET_LABELS)

# Display names of the model and preprocessing types.
MODEL_NAME_MARKERS = {
    "RandomForestClassifier": "RandomForest",
    "LGBMClassifier": "LightGBM",
    "XGBClassifier": "XGBoost",
}


def latest_finished_run(runs: DataFrame, cv_results: DataFrame,
                        limit: int = MAX_RUNS_TO_CHECK) -> DataFrame:
    """Newest FINISHED run (among the newest ``limit``) that has a CV
    table. Empty when there is none; :func:`require_run` raises then."""
    newest = (F.desc("start_time"), F.desc("run_id"))  # the id decides between equal times
    recent = runs.where(F.col("status") == "FINISHED").orderBy(*newest).limit(limit)
    # The few recent runs are one side of a semi-join, which needs no distinct on the other.
    return recent.join(cv_results.select("run_id"), "run_id", "left_semi").orderBy(*newest).limit(1)


def require_run(latest: DataFrame) -> dict:
    row = latest.first()
    if row is None:
        raise RuntimeError("No finished run with CV results found.")
    return row.asDict(recursive=True)


def cv_results_of(cv_results: DataFrame, run_id: str) -> DataFrame:
    """R2: one run's CV table (partition-pruned on ``run_id``)."""
    return cv_results.where(F.col("run_id") == run_id)


def dataset_summary(df: DataFrame, target: str) -> DataFrame:
    """Rows, columns and target column name as (item, value) rows."""
    ncols = len(df.columns)
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(
        F.struct(F.lit("rows").alias("item"), F.col("n").cast("string").alias("value")),
        F.struct(F.lit("columns").alias("item"), F.lit(str(ncols)).alias("value")),
        F.struct(F.lit("target column").alias("item"), F.lit(target).alias("value")),
    )))


def feature_summary(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(feature_group, feature, dtype) from the schema; no job."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [("numeric type", c, types.get(c)) for c in NUMERIC_FEATURES]
    rows += [("string type", c, types.get(c)) for c in CATEGORICAL_FEATURES]
    return spark.createDataFrame(rows, "feature_group string, feature string, dtype string")


def candidate_label(cv: DataFrame) -> DataFrame:
    """R5: 'preprocessor + Model: k=v, k=v' (keys sorted, NULL values
    skipped; no hyperparameters -> 'preprocessor + Model')."""
    model = F.col("model_type")
    for marker, name in MODEL_NAME_MARKERS.items():
        model = F.when(F.col("model_type").contains(marker), F.lit(name)).otherwise(model)
    params = F.map_filter("params", lambda k, v: v.isNotNull() & (F.lower(v) != "nan"))
    pairs = F.transform(F.array_sort(F.map_keys(params)),
                        lambda k: F.concat(k, F.lit("="), F.element_at(params, k)))
    head = F.concat(F.col("preprocessor"), F.lit(" + "), model)
    label = F.when(F.size(pairs) == 0, head).otherwise(
        F.concat(head, F.lit(": "), F.array_join(pairs, ", ")))
    return cv.withColumn("candidate_pipeline", label)


def candidate_ranking(cv: DataFrame) -> DataFrame:
    """Rank, mean CV score to 3 decimals, label; sorted by rank."""
    return (candidate_label(cv)
            .select("rank_test_score",
                    F.format_string("%.3f", F.col("mean_test_score")).alias("mean_test_score"),
                    "candidate_pipeline")
            .orderBy("rank_test_score", "candidate_pipeline"))


def selected_pipeline(run: DataFrame) -> DataFrame:
    """(component, detail, value) rows from the run's best-parameter map;
    hyperparameters sorted by name."""
    p = F.col("params")
    fixed = run.select(F.inline(F.array(
        F.struct(F.lit(0).alias("o"), F.lit("preprocessor").alias("component"),
                 F.lit("selected preprocessor").alias("detail"),
                 F.element_at(p, F.lit("best__preprocess")).alias("value")),
        F.struct(F.lit(1).alias("o"), F.lit("model").alias("component"),
                 F.lit("selected model").alias("detail"),
                 F.element_at(p, F.lit("best__model")).alias("value")))))
    hyper = (run.select(F.explode(p).alias("k", "value"))
             .where(F.col("k").startswith("best__model__"))
             .select(F.lit(2).alias("o"), F.lit("hyperparameter").alias("component"),
                     F.expr("substr(k, 14)").alias("detail"), "value"))
    return fixed.unionByName(hyper).orderBy("o", "detail").drop("o")


def target_distribution(df: DataFrame, label: str) -> DataFrame:
    """Bookings per outcome (Show = 0, No-show = 1), 0 when absent;
    one aggregate, no join."""
    y = F.col(label).cast("int")
    show, no_show = TARGET_LABELS
    return df.agg(F.count_if(y == 0).alias("a"), F.count_if(y == 1).alias("b")).select(
        F.inline(F.array(
            F.struct(F.lit(show).alias("booking_outcome"), F.col("a").alias("bookings")),
            F.struct(F.lit(no_show).alias("booking_outcome"), F.col("b").alias("bookings")))))


def cv_bar_data(cv: DataFrame) -> DataFrame:
    """('Rank n', mean CV score) sorted by rank."""
    return (cv.select(F.concat(F.lit("Rank "), F.col("rank_test_score").cast("string"))
                      .alias("rank_label"), "rank_test_score", "mean_test_score")
            .orderBy("rank_test_score"))


def score_holdout(model, split: DataFrame, score: str = "score") -> DataFrame:
    """Score the recomputed (repeatable) holdout with a reloaded model."""
    return model.predict_proba(split.where(F.col("is_test")), score)
