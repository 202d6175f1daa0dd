"""Model registry, grid and cross-validated search M1-M9, on Spark ML.

Mapping of the three model families (nearest Spark equivalents; the scores
are not claimed equal to the original libraries):

* random forest -> ``RandomForestClassifier``; unlimited depth -> 30, the
  largest depth Spark accepts; balanced class weights via ``weightCol``.
* leaf-wise boosting -> ``GBTClassifier``; ``num_leaves`` L -> ``maxDepth``
  ceil(log2(L + 1)) (15/31/63/127 -> 4/5/6/7); balanced weights.
* depth-wise boosting -> ``GBTClassifier`` with the given depth; the minimum
  hessian child weight is approximated by a minimum row count; no weights.

The search fits the preprocessing once per fold (on that fold's training
rows), caches the assembled fold data, and fits every candidate on it; fits
may overlap through a small driver thread pool (``parallelism``). Scores go
into a long table (candidate, fold, train/test AUC) that Spark aggregates
into the CV results; ranks use ``rank()`` on that 96-row table.
"""

from __future__ import annotations

import itertools
import math
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quaybook.config import (DEPTH_WISE_BOOSTING_GRID, LEAF_WISE_BOOSTING_GRID,
                             RANDOM_FOREST_GRID, SEED)
from quaybook.operators.prep import FEATURES_COL, build_preprocessor

MAX_SPARK_DEPTH = 30

# Family names and the candidate list of the experiment.
MODEL_FAMILIES = {
    "random_forest": {"estimator": {"type": "RandomForestClassifier",
                                    "params": {"random_state": SEED, "class_weight": "balanced"}},
                      "search_grid": RANDOM_FOREST_GRID},
    "lightgbm": {"estimator": {"type": "LGBMClassifier",
                               "params": {"random_state": SEED, "class_weight": "balanced"}},
                 "search_grid": LEAF_WISE_BOOSTING_GRID},
    "xgboost": {"estimator": {"type": "XGBClassifier", "params": {"random_state": SEED}},
                "search_grid": DEPTH_WISE_BOOSTING_GRID},
}
CANDIDATES = (
    {"name": "rf_preprocessor_v1", "preprocessing": {"type": "preprocessor_v1"},
     "model": "random_forest"},
    {"name": "lightgbm_preprocessor_v1", "preprocessing": {"type": "preprocessor_v1"},
     "model": "lightgbm"},
    {"name": "xgboost_preprocessor_v1", "preprocessing": {"type": "preprocessor_v1"},
     "model": "xgboost"},
)
@dataclass(frozen=True)
class ModelFamily:
    """M1: what a candidate trains. A family can't exist without the kind of
    its estimator and a grid to search."""

    kind: str
    grid: dict
    fixed: dict

    @classmethod
    def of(cls, name: str, families=None) -> "ModelFamily":
        conf = (MODEL_FAMILIES if families is None else families).get(name) or {}
        estimator, grid = conf.get("estimator") or {}, conf.get("search_grid")
        lacking = [part for part, there in (("an estimator kind", estimator.get("type")), ("a search grid", grid)) if not there]
        if lacking:
            raise ValueError(f"model family {name!r} has no {' and no '.join(lacking)}")
        return cls(estimator["type"], grid, estimator.get("params", {}))


def select_candidate_configs(candidates=CANDIDATES, families=MODEL_FAMILIES) -> list[dict]:
    """M1: the model config of each candidate, in order; each must make a
    whole ``ModelFamily``."""
    names = [c["model"] for c in candidates]
    for name in set(names):
        ModelFamily.of(name, families)
    return [families[name] for name in names]


def _leaves_to_depth(leaves: int) -> int:
    return max(1, math.ceil(math.log2(leaves + 1)))


def _rf(params: dict, base: dict, label: str):
    depth = params.get("max_depth")
    return RandomForestClassifier(
        featuresCol=FEATURES_COL, labelCol=label, seed=base.get("random_state", SEED),
        numTrees=int(params.get("n_estimators", 100)),
        maxDepth=MAX_SPARK_DEPTH if depth is None else int(depth),
        minInstancesPerNode=int(params.get("min_samples_leaf", 1)),
        featureSubsetStrategy=str(params.get("max_features", "sqrt")),
        **({"weightCol": "weight"} if base.get("class_weight") == "balanced" else {}))


def _leafwise(params: dict, base: dict, label: str):
    return GBTClassifier(
        featuresCol=FEATURES_COL, labelCol=label, seed=base.get("random_state", SEED),
        maxIter=int(params.get("n_estimators", 100)),
        stepSize=float(params.get("learning_rate", 0.1)),
        maxDepth=_leaves_to_depth(int(params.get("num_leaves", 31))),
        minInstancesPerNode=int(params.get("min_child_samples", 20)),
        **({"weightCol": "weight"} if base.get("class_weight") == "balanced" else {}))


def _depthwise(params: dict, base: dict, label: str):
    return GBTClassifier(
        featuresCol=FEATURES_COL, labelCol=label, seed=base.get("random_state", SEED),
        maxIter=int(params.get("n_estimators", 100)),
        stepSize=float(params.get("learning_rate", 0.3)),
        maxDepth=int(params.get("max_depth", 6)),
        minInstancesPerNode=int(params.get("min_child_weight", 1)))


MODEL_REGISTRY = {"RandomForestClassifier": _rf, "LGBMClassifier": _leafwise,
                  "XGBClassifier": _depthwise}


def build_model(estimator: dict, params: dict | None = None, label: str = "label"):
    """M2-M5: a Spark estimator for the named model type; unknown -> ValueError."""
    make = MODEL_REGISTRY.get(estimator.get("type"))
    if make is None:
        raise ValueError(f"no Spark estimator stands for {estimator.get('type')!r}; there are {', '.join(MODEL_REGISTRY)}")
    return make(params or {}, estimator.get("params", {}), label)


def expand_grid(grid: dict) -> list[dict]:
    keys = list(grid)
    return [dict(zip(keys, values)) for values in itertools.product(*grid.values())]


def candidate_grid(candidates=CANDIDATES, families=MODEL_FAMILIES) -> list[dict]:
    """M7: one grid per candidate, cross product inside each (32+32+32 = 96)."""
    configs = select_candidate_configs(candidates, families)
    out = []
    for cand, conf in zip(candidates, configs):
        for params in expand_grid(conf["search_grid"]):
            out.append({"candidate_id": len(out), "candidate": cand["name"],
                        "preprocessing": cand["preprocessing"],
                        "estimator": conf["estimator"], "params": params})
    return out


def grid_table(spark: SparkSession, grid: list[dict]) -> DataFrame:
    """The grid as rows (candidate_id, candidate, model_type, params map)."""
    rows = [(g["candidate_id"], g["candidate"], g["preprocessing"]["type"],
             g["estimator"]["type"], {k: str(v) for k, v in g["params"].items()}) for g in grid]
    return spark.createDataFrame(
        rows, "candidate_id int, candidate string, preprocessor string, model_type string, "
              "params map<string,string>")


def probability_of_one(df: DataFrame, out: str = "score") -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    return df.withColumn(out, vector_to_array(F.col("probability")).getItem(1))


def _auc(df: DataFrame, label: str) -> float:
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="score",
                                       metricName="areaUnderROC", numBins=0)
    return float(ev.evaluate(df))


def grid_search(train: DataFrame, grid: list[dict], label: str = "label",
                fold_col: str = "fold", parallelism: int = 1,
                return_train_score: bool = True) -> DataFrame:
    """M8: every grid entry x every fold; AUC on the held-out fold (and on
    the fold's training rows). Returns the CV results table (L1 form)."""
    spark = train.sparkSession
    folds = sorted(r[0] for r in train.select(fold_col).distinct().collect())
    scores = []
    for f in folds:
        fit_rows = train.where(F.col(fold_col) != f)
        held_out = train.where(F.col(fold_col) == f)
        by_prep: dict[str, list[dict]] = {}
        for g in grid:
            by_prep.setdefault(g["preprocessing"]["type"], []).append(g)
        for prep_name, entries in by_prep.items():
            prep = Pipeline(stages=build_preprocessor({"type": prep_name}, label=label)).fit(fit_rows)
            fit_x = prep.transform(fit_rows).select(label, "weight", FEATURES_COL).persist()
            held_x = prep.transform(held_out).select(label, FEATURES_COL).persist()

            def run(g, fit_x=fit_x, held_x=held_x, f=f):
                t0 = time.time()
                model = build_model(g["estimator"], g["params"], label).fit(fit_x)
                fit_time = time.time() - t0
                test = _auc(probability_of_one(model.transform(held_x)), label)
                tr = (_auc(probability_of_one(model.transform(fit_x)), label)
                      if return_train_score else None)
                return (g["candidate_id"], int(f), test, tr, fit_time)

            with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
                scores += list(pool.map(run, entries))
            fit_x.unpersist()
            held_x.unpersist()
    long = spark.createDataFrame(
        scores, "candidate_id int, fold int, test_score double, train_score double, fit_time double")
    return cv_results(long, grid_table(spark, grid))


def cv_results(long_scores: DataFrame, grid: DataFrame) -> DataFrame:
    """L1 / M8 aggregation: per candidate the split scores, mean, population
    std, rank (ties share the lowest rank) and mean fit time."""
    folds = sorted(r[0] for r in long_scores.select("fold").distinct().collect())
    agg = long_scores.groupBy("candidate_id").agg(
        *[F.max(F.when(F.col("fold") == f, F.col("test_score"))).alias(f"split{i}_test_score")
          for i, f in enumerate(folds)],
        F.stddev_pop("test_score").alias("std_test_score"),
        *[F.max(F.when(F.col("fold") == f, F.col("train_score"))).alias(f"split{i}_train_score")
          for i, f in enumerate(folds)],
        F.stddev_pop("train_score").alias("std_train_score"),
        F.avg("fit_time").alias("mean_fit_time"),
    )
    # Means are taken over the folds in their order, not in the order in which
    # rows meet in an aggregate: equal scores give equal means, so they tie.
    def mean(kind: str):
        splits = F.array_compact(F.array(*[F.col(f"split{i}_{kind}_score") for i in range(len(folds))]))
        return F.aggregate(splits, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(splits), F.lit(0))

    agg = agg.withColumns({f"mean_{kind}_score": mean(kind) for kind in ("test", "train")})
    rank = F.rank().over(Window.orderBy(F.desc("mean_test_score")))  # one row per candidate
    return (grid.join(agg, "candidate_id")
            .withColumn("rank_test_score", rank.cast("int")))


def best_candidate(cv: DataFrame) -> DataFrame:
    """K1 as a one-row table: highest mean CV score, the first candidate of
    equal ones (a bounded top-1, no sort of the whole table)."""
    return cv.orderBy(F.desc("mean_test_score"), "candidate_id").limit(1)


def select_best(cv: DataFrame) -> dict:
    """K1: the row of ``best_candidate``."""
    row = best_candidate(cv).first()
    if row is None:
        raise ValueError("the CV table has no candidate")
    return row.asDict(recursive=True)


def refit(train: DataFrame, entry: dict, label: str = "label") -> PipelineModel:
    """M9: preprocessing + model fitted on the whole training set."""
    stages = build_preprocessor(entry["preprocessing"], label=label)
    stages.append(build_model(entry["estimator"], entry["params"], label))
    return Pipeline(stages=stages).fit(train)
