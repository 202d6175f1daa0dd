import numpy as np
from pyspark.sql import functions as F

from quaybook.operators import curves as R
from quaybook.operators import metrics as M
from quaybook.operators import split as S
from quaybook.plans.queries import labelled, score_table, scored_fixture
from quaybook.plans.prefix import next_row
from conftest import SF01

SIX = [(1, .9), (0, .8), (1, .7), (1, .6), (0, .6), (0, .2)]


def six(spark):
    return spark.createDataFrame(SIX, "label int, score double")


def test_six_row_metrics(spark):
    m = M.evaluate(six(spark), n_buckets=3).first()
    assert round(m.test_roc_auc, 6) == 0.722222
    assert round(m.test_average_precision, 6) == 0.755556
    assert round(m.test_brier_score, 6) == 0.216667
    assert round(m.test_log_loss, 6) == 0.620289


def test_bucket_count_does_not_change_results(spark):
    a = M.evaluate(six(spark), n_buckets=1).first()
    b = M.evaluate(six(spark), n_buckets=64).first()
    assert a == b


def test_fixture_golden_metrics(spark):
    m = M.metric_set(score_table(spark, SF01)).first()
    assert abs(m.test_roc_auc - 0.686138425420383) < 1e-9
    assert abs(m.test_average_precision - 0.5643737009406414) < 1e-9
    assert abs(m.test_brier_score - 0.22942317852863192) < 1e-9
    assert abs(m.test_log_loss - 0.6370034129671094) < 1e-9
    assert abs(m.test_accuracy - 0.6053252443545669) < 1e-9
    c = M.confusion_counts(score_table(spark, SF01)).first()
    assert (c.tp, c.fp, c.fn) == (2753, 4075, 1780)


def test_no_positive_predictions_zero_division(spark):
    df = spark.createDataFrame([(1, .1), (0, .2), (1, .3)], "label int, score double")
    m = M.evaluate(df).first()
    assert m.test_precision == 0.0 and m.test_recall == 0.0 and m.test_f1 == 0.0


def test_roc_and_pr_points(spark):
    t = M.score_table(six(spark), n_buckets=2)
    roc = R.roc_points(t).orderBy("point").collect()
    assert roc[0].threshold == float("inf") and roc[0].fpr == 0.0
    assert roc[-1].fpr == 1.0 and roc[-1].tpr == 1.0
    pr = R.pr_points(t).collect()
    assert any(r.threshold is None and r.recall == 0.0 and r.precision == 1.0 for r in pr)
    g = R.roc_guide_point(R.roc_points(t)).first()
    assert abs(g.tpr - 2 / 3) < 1e-12


def test_roc_drop_intermediate_keeps_corners(spark):
    df = spark.createDataFrame([(1, .9), (1, .8), (1, .7), (0, .3)], "label int, score double")
    pts = R.roc_points(M.score_table(df)).orderBy("point").collect()
    assert [(p.fpr, p.tpr) for p in pts] == [(0.0, 0.0), (0.0, 1 / 3), (0.0, 1.0), (1.0, 1.0)]


def test_calibration_all_equal_scores(spark):
    df = spark.createDataFrame([(1, .4)] * 5 + [(0, .4)] * 5, "label int, score double")
    rows = R.calibration_curve(df).collect()
    assert len(rows) == 1 and rows[0].n == 10 and rows[0].observed_rate == 0.5


def test_calibration_bins_cover_rows(spark):
    rows = R.calibration_curve(scored_fixture(spark, SF01)).collect()
    assert sum(r.n for r in rows) == 14835 and len(rows) <= 25


def test_split_golden(spark):
    sp = S.stratified_split(labelled(spark, SF01))
    got = {r.label: r for r in sp.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t"),
        F.sum(F.when(F.col("is_test"), F.col("booking_id"))).alias("s")).collect()}
    assert (got[0].n, got[0].t, got[0].s) == (10302, 2060, 15743611)
    assert (got[1].n, got[1].t, got[1].s) == (4533, 907, 6693202)


def test_folds_golden_and_balanced(spark):
    f = S.assign_folds(labelled(spark, SF01))
    sizes = sorted(r[1] for r in f.where("label = 0").groupBy("fold").count().collect())
    assert sizes == [2060, 2060, 2060, 2061, 2061]
    sp = S.stratified_split(labelled(spark, SF01))
    per = sp.where("not is_test").groupBy("label", "fold").count().collect()
    for lab in (0, 1):
        counts = [r["count"] for r in per if r.label == lab]
        assert max(counts) - min(counts) <= 1


def test_split_independent_of_partitioning(spark):
    base = labelled(spark, SF01)
    a = S.stratified_split(base).where("is_test").select("booking_id")
    b = S.stratified_split(base.repartition(13), max_bucket_rows=300).where("is_test").select("booking_id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_no_unpartitioned_window_over_data(spark):
    import re
    from quaybook.plans.prefix import running_totals
    per = scored_fixture(spark, SF01).groupBy("score").agg(F.sum("label").alias("pos"))
    plan = running_totals(per, "score", ["pos"])._jdf.queryExecution().executedPlan().toString()
    # the per-value windows are partitioned by bucket; the offsets come from
    # the small bucket table and are broadcast back
    assert re.search(r"Window \[.*\], \[bucket#\d+\]", plan)
    assert "BroadcastExchange" in plan or "BroadcastHashJoin" in plan


def test_s1_features_and_target(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, 0.0, "b")], "booking_id bigint, no_show double, branch string")
    out = S.features_and_target(df)
    assert "no_show" not in out.columns and [r.label for r in out.collect()] == [1, 0]


def test_hot_id_is_spread_and_ranked_exactly(spark):
    from pyspark.sql import Window
    # 40 % of the rows share booking_id 7 (copies that differ in another column).
    rows = [(7 if i % 5 < 2 else 1000 + i, i % 2, float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "booking_id bigint, label int, v double")
    got = S.rank_in_class(df, "label", "booking_id", max_bucket_rows=50)
    key = S.order_key("booking_id")
    rh = F.xxhash64(*[F.col(c) for c in df.columns])
    brute = df.withColumn("want", F.row_number().over(
        Window.partitionBy("label").orderBy(key, "booking_id", rh)))
    joined = got.join(brute, ["booking_id", "label", "v"])
    assert joined.count() == 3000
    assert joined.where("rank_in_class != want").count() == 0
    # the hot group is cut into many sub-buckets, not one task
    subs = df.where("booking_id = 7").select(
        F.shiftrightunsigned(rh, 58).alias("s")).distinct().count()
    assert subs > 16


def test_split_unchanged_when_nothing_is_hot(spark):
    base = labelled(spark, SF01)
    a = S.stratified_split(base).select("booking_id", "rank_in_class")
    b = S.stratified_split(base, max_bucket_rows=1).select("booking_id", "rank_in_class")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_next_row_crosses_buckets(spark):
    """Every bucket border, buckets of one row and nulls, against one list."""
    rows = [(i, b, None if i % 4 == 0 else i * 10) for i, b in enumerate([9, 9, 9, 7, 4, 4, 0, 0, 0, 0])]
    df = spark.createDataFrame(rows, "row_index long, bucket int, v int")
    got = {r.row_index: r.next_v for r in next_row(df, ["v"]).collect()}
    assert got == {i: rows[i + 1][2] if i + 1 < len(rows) else None for i in range(len(rows))}
    assert next_row(df.limit(0), ["v"]).collect() == []


def test_calibration_edges_are_linear_quantiles(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.random(400), np.full(300, 0.25), [0.0, 1.0]])
    df = spark.createDataFrame([(float(v), i % 2 if i % 5 else None) for i, v in enumerate(values)] + [(None, 1)], "score double, label int")
    edges = R.calibration_edges(R.calibration_counts(df, n_buckets=7), 25)
    assert np.allclose(edges, np.quantile(values, [i / 25 for i in range(26)]), rtol=0, atol=1e-12)
    assert sum(r.n for r in R.calibration_curve(df).collect()) == len(values)
    assert R.calibration_curve(df.limit(0)).collect() == []
