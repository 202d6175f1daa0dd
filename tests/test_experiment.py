import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from quaybook.config import DEFAULT
from quaybook.operators import models as MD
from quaybook.operators import quality as Q
from quaybook.operators import report as RP
from quaybook.operators import runs as L
from quaybook.plans.experiment import report_data, run_experiment
from quaybook.plans.queries import cleaned, featured, raw
from quaybook.sources import sinks
from conftest import SF001


def _tiny_grid():
    grid = [g for g in MD.candidate_grid() if g["candidate_id"] in (7, 40)]
    for g in grid:
        g["params"] = dict(g["params"], n_estimators=4)
    return grid


def test_sink_round_trip(spark, scratch):
    feat = featured(spark, SF001)
    sinks.write_parquet(feat, os.path.join(scratch, "features"))
    back = sinks.read_parquet(spark, os.path.join(scratch, "features"))
    assert back.exceptAll(feat).count() == 0 and feat.exceptAll(back).count() == 0
    res = Q.run_suite(cleaned(spark, SF001))
    sinks.write_json(res, os.path.join(scratch, "results"))
    sinks.write_csv(Q.failures(res), os.path.join(scratch, "failures"))
    csv = spark.read.option("header", True).csv(os.path.join(scratch, "failures"))
    assert tuple(csv.columns) == Q.REPORT_COLUMNS
    assert spark.read.json(os.path.join(scratch, "results")).count() == 69


def test_overwrite_from_itself_and_after_a_failure(spark, scratch):
    path = os.path.join(scratch, "t")
    sinks.write_parquet(spark.range(10), path)
    sinks.write_parquet(sinks.read_parquet(spark, path).where("id < 4"), path)
    assert sinks.read_parquet(spark, path).count() == 4
    with pytest.raises(Exception):
        sinks.write_parquet(spark.range(3).select(F.raise_error(F.lit("no")).alias("id")), path)
    assert sinks.read_parquet(spark, path).count() == 4
    assert not [f for f in os.listdir(scratch) if ".old-" in f]


def test_experiment_and_report(spark, scratch):
    feat = featured(spark, SF001)
    cfg = dataclasses.replace(DEFAULT, seed=7, test_size=0.3, cv_folds=3)
    out = run_experiment(feat, scratch, grid=_tiny_grid(), parallelism=2, cfg=cfg)
    assert out["scored"].count() == 445  # ceil(0.3 * 1483)
    m = out["metrics"]
    assert 0.5 < m["test_roc_auc"] <= 1.0
    assert 0.0 <= m["test_brier_score"] <= 1.0
    logged = L.read_runs(spark, scratch).first().metrics
    assert (logged["searched_settings"], logged["full_grid_settings"]) == (2, 96)
    assert (logged["dropped_null_score"], logged["dropped_null_label"]) == (0, 0)
    data = report_data(feat, scratch)
    # The report cuts the run's own holdout again, not the default one.
    again = data["metrics"].first().asDict()
    assert all(again[k] == pytest.approx(v, abs=1e-9) for k, v in m.items() if k in again)
    summary = {r.item: r.value for r in data["dataset_summary"].collect()}
    assert summary == {"rows": "1483", "columns": str(len(feat.columns)), "target column": "no_show"}
    rank = data["candidate_ranking"].collect()
    assert [r.rank_test_score for r in rank] == [1, 2]
    assert all(" + " in r.candidate_pipeline for r in rank)
    sel = data["selected_pipeline"].collect()
    assert sel[0].component == "preprocessor" and sel[0].value == "preprocessor_v1"
    assert sel[1].component == "model"
    assert [r.detail for r in sel[2:]] == sorted(r.detail for r in sel[2:])
    dist = {r.booking_outcome: r.bookings for r in data["target_distribution"].collect()}
    assert sum(dist.values()) == 1483
    assert [r.rank_label for r in data["cv_bars"].collect()] == ["Rank 1", "Rank 2"]
    # the reloaded model scores the recomputed holdout exactly as the run did
    again = data["metrics"].first().asDict()
    assert abs(again["test_roc_auc"] - m["test_roc_auc"]) < 1e-12
    feats = data["feature_summary"].collect()
    assert len(feats) == 20 and feats[0].feature_group == "numeric type"
    assert data["calibration"].count() >= 1
    assert data["roc_guide"].count() == 1 and data["pr_guide"].count() == 1
    summ = spark.read.json(os.path.join(scratch, "summary")).first()
    assert summ.run_id == out["run_id"]


def test_latest_run_picks_newest_with_cv(spark):
    runs = spark.createDataFrame(
        [("a", "FINISHED", 1), ("b", "FINISHED", 3), ("c", "FAILED", 4), ("d", "FINISHED", 5)],
        "run_id string, status string, t int").withColumn("start_time", F.col("t").cast("timestamp"))
    cv = spark.createDataFrame([("a",), ("b",)], "run_id string")
    assert RP.require_run(RP.latest_finished_run(runs, cv))["run_id"] == "b"


def test_candidate_label_skips_nulls(spark):
    cv = spark.createDataFrame(
        [("preprocessor_v1", "LGBMClassifier", {"num_leaves": "15", "x": None}),
         ("preprocessor_v1", "XGBClassifier", {})],
        "preprocessor string, model_type string, params map<string,string>")
    got = [r.candidate_pipeline for r in RP.candidate_label(cv).collect()]
    assert got == ["preprocessor_v1 + LightGBM: num_leaves=15", "preprocessor_v1 + XGBoost"]


def test_raw_suite_on_source(spark):
    assert Q.run_suite(raw(spark, SF001)).count() == 69
