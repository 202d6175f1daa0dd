"""The experiment chain: split -> search -> select -> calibrate -> score ->
metrics -> run log -> model files, and the report data built from them."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaybook.config import DEFAULT, EXPERIMENT_NAME, BookingConfig
from quaybook.operators import calibrate as K
from quaybook.operators import curves as R
from quaybook.operators import metrics as M
from quaybook.operators import models as MD
from quaybook.operators import report as RP
from quaybook.operators import runs as L
from quaybook.operators import split as S
from quaybook.plans.stages import write_stage


def run_experiment(features: DataFrame, root: str, grid: list[dict] | None = None,
                   parallelism: int = 1, cfg: BookingConfig = DEFAULT) -> dict:
    """Runs the whole experiment on a feature table and returns its summary.
    ``grid`` defaults to the full 96-setting grid (a cluster-sized job). The
    id, target, seed, holdout share and folds are those of ``cfg``; they are
    written beside the model, so that the report cuts the same holdout again."""
    spark = features.sparkSession
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    id_col = cfg.id_col
    cut = {"id_col": id_col, "seed": cfg.seed, "test_size": cfg.test_size, "folds": cfg.cv_folds}
    labelled = features.withColumn("label", F.col(cfg.target_col).cast("int"))
    split = write_stage(S.stratified_split(labelled, **cut), "split")
    train, test = S.train_test(split)
    grid = grid if grid is not None else MD.candidate_grid()
    cv = MD.grid_search(train, grid, parallelism=parallelism)
    best = MD.select_best(cv)
    entry = next(g for g in grid if g["candidate_id"] == best["candidate_id"])
    model = K.calibrate(train, entry)
    scored = write_stage(model.predict_proba(test).select(id_col, "label", "score"), "scored")
    metrics = M.evaluate(scored).first().asDict()
    # What the metrics leave out and how much was searched stays on record.
    counts = {f"dropped_{k}": v for k, v in M.dropped_scores(scored).first().asDict().items()}
    counts.update(searched_settings=len(grid), full_grid_settings=len(MD.candidate_grid()))
    model_path = L.persist_model(model, root)
    K.save_manifest(spark, model_path, {"folds": len(model.pipelines), "split": {**cut, "target": cfg.target_col}, "entry": {
        k: entry[k] for k in ("candidate_id", "candidate", "preprocessing", "estimator", "params")}})
    params = L.best_parameter_map(entry)
    run_id = L.record_run(spark, root, experiment=EXPERIMENT_NAME, run_name=EXPERIMENT_NAME,
                          best_cv_score=best["mean_test_score"], params=params,
                          metrics={**metrics, **counts}, model_path=model_path,
                          cv=L.cv_results_table(cv), started=started)
    summary = L.pipeline_summary(spark, experiment=EXPERIMENT_NAME,
                                 best_cv_score=best["mean_test_score"], best_params=params,
                                 run_id=run_id, model_path=model_path, test_metrics=metrics)
    L.write_json(summary, os.path.join(root, "summary"))
    return {"run_id": run_id, "model_path": model_path, "metrics": metrics, "counts": counts,
            "best": best, "scored": scored, "cv": cv}


#: Report data with up to one row per distinct score; the rest is a few rows.
LARGE_REPORTS = frozenset({"roc", "pr"})


def report_data(features: DataFrame, root: str) -> dict[str, DataFrame]:
    """R1-R15 from the persisted run: latest run, its CV table, the redone
    split (by the settings of that run) scored by the reloaded model, and
    every chart's data."""
    spark = features.sparkSession
    runs, cvs = L.read_runs(spark, root), L.read_cv_results(spark, root)
    run = RP.require_run(RP.latest_finished_run(runs, cvs))
    cv = RP.cv_results_of(cvs, run["run_id"])
    manifest = K.load_manifest(spark, run["model_path"])
    model = K.CalibratedModel.load(run["model_path"], manifest["folds"])
    cut = dict(manifest["split"])
    target = cut.pop("target")
    labelled = features.withColumn("label", F.col(target).cast("int"))
    split = S.stratified_split(labelled, **cut)
    # The curves read the scores several times; the model runs once.
    scored = write_stage(RP.score_holdout(model, split).select(cut["id_col"], "label", "score"), "report_scores")
    table = M.score_table(scored)
    roc = R.roc_points(table)
    pr = R.pr_points(table)
    run_df = runs.where(F.col("run_id") == run["run_id"])
    return {
        "dataset_summary": RP.dataset_summary(features, target),
        "feature_summary": RP.feature_summary(spark, features),
        "candidate_ranking": RP.candidate_ranking(cv),
        "selected_pipeline": RP.selected_pipeline(run_df),
        "target_distribution": RP.target_distribution(features, target),
        "cv_bars": RP.cv_bar_data(cv),
        "roc": roc, "roc_guide": R.roc_guide_point(roc),
        "pr": pr, "pr_guide": R.pr_guide_point(pr),
        "calibration": R.calibration_curve(scored),
        "metrics": M.metric_set(table),
    }
