import random
from fractions import Fraction

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quaybook.operators import calibrate as K
from quaybook.operators import models as MD
from quaybook.operators import prep as P
from quaybook.operators import split as S
from quaybook.plans.queries import featured
from quaybook.plans.stages import write_stage
from conftest import SF001


def test_grid_has_96_settings():
    grid = MD.candidate_grid()
    assert len(grid) == 96
    assert [g["candidate"] for g in grid].count("lightgbm_preprocessor_v1") == 32


def test_config_errors():
    with pytest.raises(ValueError):
        MD.build_model({"type": "Nope"})
    with pytest.raises(ValueError):
        MD.select_candidate_configs([{"model": "missing", "preprocessing": {}}])
    with pytest.raises(ValueError):
        MD.select_candidate_configs([{"model": "x"}], {"x": {"estimator": {}}})
    with pytest.raises(ValueError):
        P.build_preprocessor({"type": "nope"})


def test_unseen_category_is_all_zero(spark):
    train = spark.createDataFrame([("a", 1.0, 0), ("b", 2.0, 1)], "branch string, arrival_day double, label int")
    test = spark.createDataFrame([("zzz", 1.0, 0), (None, None, 1)], "branch string, arrival_day double, label int")
    stages = P.preprocessor_v1(numeric=["arrival_day"], categorical=["branch"])
    pm = Pipeline(stages=stages).fit(train)
    out = pm.transform(test).select(vector_to_array("branch__ohe").alias("v")).collect()
    assert [list(r.v) for r in out] == [[0.0, 0.0], [0.0, 0.0]]  # two known categories; 'missing' unseen


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "label int")
    m = P.BalancedClassWeights(labelCol="label", weightCol="w").fit(df)
    w = {r.label: r.w for r in m.transform(df).distinct().collect()}
    assert w == {0: 8 / (2 * 6), 1: 8 / (2 * 2)}


def _tiny_grid():
    grid = [g for g in MD.candidate_grid() if g["candidate_id"] in (7, 33, 64)]
    for g in grid:
        g["params"] = dict(g["params"], n_estimators=5)
    return grid


def test_search_select_calibrate_save_load(spark, scratch):
    feat = featured(spark, SF001).withColumn("label", F.col("no_show").cast("int"))
    train, test = S.train_test(write_stage(S.stratified_split(feat), "split"))  # as the chain does
    grid = _tiny_grid()
    cv = MD.grid_search(train, grid, parallelism=2)
    rows = cv.collect()
    assert len(rows) == 3 and sorted(r.rank_test_score for r in rows)[0] == 1
    best = MD.select_best(cv)
    entry = next(g for g in grid if g["candidate_id"] == best["candidate_id"])
    model = K.calibrate(train, entry)
    scored = model.predict_proba(test)
    vals = [r.score for r in scored.select("score").collect()]
    assert all(0.0 <= v <= 1.0 for v in vals)
    path = model.save(scratch + "/m")
    again = K.CalibratedModel.load(path, len(model.pipelines)).predict_proba(test)
    a = {r.booking_id: r.score for r in scored.select("booking_id", "score").collect()}
    b = {r.booking_id: r.score for r in again.select("booking_id", "score").collect()}
    assert a == b


def plain_isotonic(pairs):
    """max over starts at or before, min over ends at or after, of the mean between."""
    xs = sorted({x for x, _ in pairs})
    rows = [(sum(y for a, y in pairs if a == x), sum(a == x for a, _ in pairs)) for x in xs]
    def mean(j, k):
        return Fraction(sum(p for p, _ in rows[j:k + 1]), sum(n for _, n in rows[j:k + 1]))
    return {x: max(min(mean(j, k) for k in range(i, len(xs))) for j in range(i + 1)) for i, x in enumerate(xs)}


@pytest.mark.parametrize("buckets,fan_in", [(1, 32), (7, 2), (64, 3)])
def test_isotonic_blocks_by_the_min_max_formula(spark, buckets, fan_in):
    rng = random.Random(buckets)
    pairs = [(round(rng.random(), 1 + i % 2), int(rng.random() < 0.2 + 0.5 * i / 120)) for i in range(120)]
    rows = [(x, y) for x, y in pairs] + [(None, 1), (0.5, None), (float("nan"), 0)]
    got = K.isotonic_blocks(spark.createDataFrame(rows, "score double, label int"), n_buckets=buckets, fan_in=fan_in).collect()
    want = plain_isotonic(pairs)
    assert sum(r.rows for r in got) == 120 and len({r.calibrated for r in got}) == len(got) == len(set(want.values()))
    for x, v in want.items():
        assert [Fraction(r.positives, r.rows) for r in got if r.lo <= x <= r.hi] == [v]
    assert K.isotonic_blocks(spark.createDataFrame([], "score double, label int")).collect() == []


def test_category_indexes_match_the_pipeline(spark):
    train = spark.createDataFrame([("b", "x"), ("a", None), (None, "y"), ("b", "x")], "branch string, room string")
    rows = spark.createDataFrame([("a", "y"), ("zz", None), (None, "zz")], "branch string, room string")
    dictionary = P.category_dictionary(train, ["branch", "room"])
    assert sorted(map(tuple, dictionary.collect())) == [("branch", "a", 0), ("branch", "b", 1), ("branch", "missing", 2),
                                                        ("room", "missing", 0), ("room", "x", 1), ("room", "y", 2)]
    got = P.category_indexes(rows, dictionary, ["branch", "room"])
    assert sorted((r.branch or "", r.branch__idx, r.room__idx) for r in got.collect()) == [("", 2, 3), ("a", 0, 2), ("zz", 3, 0)]
    model = P.DictionaryIndexer(inputCols=["branch", "room"], outputCols=["i", "j"]).fit(train)
    filled = P.prepared_columns(rows, [], ["branch", "room"]).selectExpr("branch__cat AS branch", "room__cat AS room")
    assert sorted((r.branch, r.i, r.j) for r in model.transform(filled).collect()) == [("a", 0, 2), ("missing", 2, 3), ("zz", 3, 0)]


def test_isotonic_pools_ties(spark):
    df = spark.createDataFrame([(.1, 0), (.1, 1), (.4, 1), (.5, 0), (.9, 1)], "score double, label int")
    m = K.isotonic_fit(df)
    assert list(m.boundaries) == [0.1, 0.5, 0.9]
    assert list(m.predictions) == [0.5, 0.5, 1.0]
