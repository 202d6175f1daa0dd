"""Run log and persistence L1-L6.

Runs are rows of a Parquet ``runs`` table (append-only); each run's CV
results go to a ``cv_results`` table partitioned by ``run_id`` so reading one
run prunes to its partition. Maps are ``map<string,string>`` columns and are
formatted with higher-order map functions on the JVM side.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS_SCHEMA = ("run_id string, run_name string, experiment string, status string, "
               "start_time timestamp, end_time timestamp, best_cv_score double, "
               "params map<string,string>, metrics map<string,double>, model_path string")


def cv_results_table(cv: DataFrame) -> DataFrame:
    """L1: one row per setting with every hyperparameter as a text
    ``param_model__<name>`` column (NULL where a family lacks it)."""
    keys = sorted(r[0] for r in cv.select(F.explode(F.map_keys("params"))).distinct().collect())
    return cv.withColumns({f"param_model__{k}": F.col("params").getItem(k).cast("string")
                           for k in keys}).withColumn("param_model", F.col("model_type"))


def format_best_parameters(params: Column, prefix: str = "best__") -> Column:
    """L2: prefix every key; values as text."""
    return F.transform_keys(stringify_mapping(params), lambda k, v: F.concat(F.lit(prefix), k))


def stringify_mapping(m: Column) -> Column:
    """Map values to text."""
    return F.transform_values(m, lambda k, v: v.cast("string"))


def best_parameter_map(best: dict) -> dict[str, str]:
    """The selected preprocessing, model type and hyperparameters as one map."""
    out = {"preprocess": best["preprocessing"]["type"] if isinstance(best.get("preprocessing"), dict)
           else str(best.get("preprocessing")),
           "model": best.get("model_type") or best["estimator"]["type"]}
    for k, v in (best.get("params") or {}).items():
        out[f"model__{k}"] = str(v)
    return out


def append_cv_results(cv: DataFrame, root: str, run_id: str) -> None:
    """One run's CV table as a partition of its own."""
    (cv.withColumn("run_id", F.lit(run_id)).write.mode("append")
       .partitionBy("run_id").parquet(os.path.join(root, "cv_results")))


def record_run(spark: SparkSession, root: str, *, experiment: str, run_name: str,
               best_cv_score: float, params: dict[str, str], metrics: dict[str, float],
               model_path: str, cv: DataFrame, started: dt.datetime | None = None) -> str:
    """L3: append the run row and write its CV table partition. Returns the id."""
    run_id = uuid.uuid4().hex
    started = started or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    ended = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    append_cv_results(cv, root, run_id)
    row = [(run_id, run_name, experiment, "FINISHED", started, ended, float(best_cv_score),
            {f"best__{k}": str(v) for k, v in params.items()},
            {k: float(v) for k, v in metrics.items()}, model_path)]
    spark.createDataFrame(row, RUNS_SCHEMA).write.mode("append").parquet(os.path.join(root, "runs"))
    return run_id


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(RUNS_SCHEMA).parquet(os.path.join(root, "runs"))


def read_cv_results(spark: SparkSession, root: str) -> DataFrame:
    """All runs' CV tables. Runs differ in their hyperparameter and fold
    columns, so the schemas of all files are merged; a column that a run lacks
    is null. A filter on ``run_id`` prunes to that run's partition."""
    return spark.read.option("mergeSchema", "true").parquet(os.path.join(root, "cv_results"))


def cv_results_of_run(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """R2: one run's CV table with the columns of that run alone (none that
    only other runs have)."""
    whole = read_cv_results(spark, root).where(F.col("run_id") == run_id)
    own = spark.read.parquet(os.path.join(root, "cv_results", f"run_id={run_id}")).columns
    return whole.select(*own, "run_id")


def persist_model(model, root: str, name: str = "best_model") -> str:
    """L4: save the calibrated model (all fold pipelines and isotonic maps)."""
    path = os.path.join(root, name)
    model.save(path)
    return path


def pipeline_summary(spark: SparkSession, *, experiment: str, best_cv_score: float,
                     best_params: dict, run_id: str, model_path: str,
                     test_metrics: dict[str, float]) -> DataFrame:
    """One-row summary (written as JSON by :func:`write_json`)."""
    schema = ("experiment string, best_cv_score double, best_params map<string,string>, "
              "run_id string, model_path string, test_metrics map<string,double>")
    df = spark.createDataFrame([(experiment, float(best_cv_score), best_params, run_id,
                                 model_path, {k: float(v) for k, v in test_metrics.items()})],
                               schema)
    return df.withColumn("best_params", stringify_mapping(F.col("best_params")))


from quaybook.sources.sinks import write_json  # noqa: E402,F401  (used by the experiment chain)
