"""Registered queries: one per operator, each a lazy DataFrame over the given
tables (the booking table is derived from ``orders`` and ``customer``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaybook.config import DEFAULT
from quaybook.operators import calibrate as K
from quaybook.operators import clean as C
from quaybook.operators import curves as R
from quaybook.operators import features as FE
from quaybook.operators import metrics as M
from quaybook.operators import models as MD
from quaybook.operators import prep as P
from quaybook.operators import quality as Q
from quaybook.operators import report as RP
from quaybook.operators import runs as L
from quaybook.operators import split as S
from quaybook.plans.stages import new_stage_path, stage_table
from quaybook.sources import sinks
from quaybook.sources.bookings import derive_raw_bookings
from quaybook.sources.tables import read_table, table_path

Query = Callable[[SparkSession, str], DataFrame]

CLEAN_STEPS = (
    ("c1", C.drop_duplicate_rows),
    ("c2", C.drop_missing_target),
    ("c3", C.drop_rows_with_low_missingness),
    ("c4", C.adult_words_to_digits),
    ("c5", C.parse_numeric_columns),
    ("c6", C.standardize_months),
    ("c7", C.null_invalid_days),
)


def _stage(spark: SparkSession, name: str, sf_dir: str, build,
           tables: tuple[str, ...] = ("orders", "customer"), written: bool = False) -> DataFrame:
    """A stage of the given tables, rebuilt when their files change."""
    return stage_table(spark, (name, sf_dir), build,
                       tuple(table_path(sf_dir, t) for t in tables), written)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw booking table, ingested once per session and source."""
    return _stage(spark, "raw_bookings", sf_dir, lambda: derive_raw_bookings(spark, sf_dir))


ROW_LOCAL_FROM = "c4"  # C4-C7 are row-local projections


def _steps(df: DataFrame, steps, until: str) -> DataFrame:
    for name, fn in steps:
        df = fn(df)
        if name == until:
            return df
    raise ValueError(until)


def after_c3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows left after C1-C3: C3's filters on the stage that it writes, once
    per session; the row-local C4-C7 start from here."""
    return _stage(spark, "after_c3", sf_dir,
                  lambda: _steps(raw(spark, sf_dir), CLEAN_STEPS, "c3"), written=True)


def cleaned_until(spark: SparkSession, sf_dir: str, step: str) -> DataFrame:
    names = [n for n, _ in CLEAN_STEPS]
    if step == "c3":
        return after_c3(spark, sf_dir)
    if names.index(step) < names.index(ROW_LOCAL_FROM):
        return _steps(raw(spark, sf_dir), CLEAN_STEPS, step)
    row_local = CLEAN_STEPS[names.index(ROW_LOCAL_FROM):]
    return _steps(after_c3(spark, sf_dir), row_local, step)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned booking table (C1-C7), written at the stage boundary."""
    return _stage(spark, "cleaned_bookings", sf_dir,
                  lambda: cleaned_until(spark, sf_dir, "c7"))


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.add_features(cleaned(spark, sf_dir), DEFAULT)


def _feature_query(*cols: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return featured(spark, sf_dir).select("booking_id", *cols)
    return q


def branch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: bookings, mean SGD price and no-show rate per branch."""
    return (featured(spark, sf_dir).groupBy("branch")
            .agg(F.count(F.lit(1)).alias("bookings"),
                 F.round(F.avg("price_amount_sgd"), 6).alias("mean_price_sgd"),
                 F.round(F.avg("no_show"), 6).alias("no_show_rate")))


def f3_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (FE.add_reference_dates(cleaned(spark, sf_dir))
            .select("booking_id", "arrival_date", "checkout_date"))


QUERIES: dict[str, Query] = {
    "branch_summary": branch_summary,
    "i1_raw_bookings": raw,
    "c1_distinct": lambda s, d: cleaned_until(s, d, "c1"),
    "c2_target_present": lambda s, d: cleaned_until(s, d, "c2"),
    "c3_low_missing_drop": lambda s, d: cleaned_until(s, d, "c3"),
    "c3a_missing_profile": lambda s, d: C.missing_profile(cleaned_until(s, d, "c2")),
    "c4_adult_words": lambda s, d: cleaned_until(s, d, "c4"),
    "c5_numeric_parse": lambda s, d: cleaned_until(s, d, "c5"),
    "c5_parse_rejects": lambda s, d: C.numeric_parse_rejects(cleaned_until(s, d, "c4")),
    "c6_month_standardise": lambda s, d: cleaned_until(s, d, "c6"),
    "c7_invalid_day": lambda s, d: cleaned_until(s, d, "c7"),
    "f1_price_parse": _feature_query("price", "price_currency", "price_amount"),
    "f2_price_sgd": _feature_query("price_currency", "price_amount", "price_amount_sgd"),
    "f3_reference_dates": f3_dates,
    "f4_stay_nights": _feature_query("stay_length_nights"),
    "f5_month_gap": _feature_query("booking_to_arrival_month_gap"),
    "f6_total_guests": _feature_query("total_guests"),
    "f7_price_per_guest": _feature_query("price_per_guest"),
    "f8_price_per_night": _feature_query("price_per_night"),
    "f9_price_guest_night": _feature_query("price_per_guest_per_night"),
    "feature_table": featured,
}


QUERIES.update({
    "v11_suite_raw": lambda s, d: Q.run_suite(raw(s, d)),
    "v11_suite_clean": lambda s, d: Q.run_suite(cleaned(s, d)),
    "v12_failures_raw": lambda s, d: Q.failures(Q.run_suite(raw(s, d))),
    "v12_failures_clean": lambda s, d: Q.failures(Q.run_suite(cleaned(s, d))),
})


def scored_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic scores on the rows left after C1-C3 (stand-in for model
    output, which SQL cannot reproduce)."""
    base = after_c3(spark, sf_dir)
    return base.select(
        "booking_id",
        F.col("no_show").cast("int").alias("label"),
        (((F.col("booking_id") * 7919) % 1000 + 200 * F.col("no_show")) / 1200).alias("score"))


def score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture's score table, written once per session."""
    return _stage(spark, "scores", sf_dir,
                  lambda: M.score_rows(scored_fixture(spark, sf_dir)))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table with the target as an integer label (S1 keeps it)."""
    return featured(spark, sf_dir).withColumn("label", F.col("no_show").cast("int"))


def split_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table with split and fold ids, written once per session
    (the experiment chain writes it the same way)."""
    return _stage(spark, "split", sf_dir,
                  lambda: S.stratified_split(labelled(spark, sf_dir)))


def doc_length_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document length as a score for the quality label (labels joined to
    documents on doc_id; both sides are large, so this is a shuffle join
    unless AQE measures one side small)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return (labels.join(docs, "doc_id")
            .select("doc_id", F.col("quality").alias("label"),
                    F.col("n_chars").cast("double").alias("score")))


def doc_score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage(spark, "doc_scores", sf_dir,
                  lambda: M.score_rows(doc_length_scores(spark, sf_dir)),
                  ("documents", "labels"))


def _roc(s, d):
    return R.roc_points(score_table(s, d))


def _pr(s, d):
    return R.pr_points(score_table(s, d))


QUERIES.update({
    "s2_split": lambda s, d: split_frame(s, d).select(
        "booking_id", "label", "rank_in_class", "is_test"),
    "s3_folds": lambda s, d: split_frame(s, d).where(~F.col("is_test")).select(
        "booking_id", "fold"),
    "s3_folds_all_rows": lambda s, d: S.assign_folds(labelled(s, d)).select(
        "booking_id", "label", "fold"),
    "e1_predict_class": lambda s, d: M.predict_class(scored_fixture(s, d)),
    "e3_auc": lambda s, d: M.roc_auc(score_table(s, d)),
    "e4_avg_precision": lambda s, d: M.average_precision(score_table(s, d)),
    "e11_metrics": lambda s, d: M.metric_set(score_table(s, d)),
    "e_confusion_counts": lambda s, d: M.confusion_counts(score_table(s, d)),
    "r10_roc": _roc,
    "r11_roc_guide": lambda s, d: R.roc_guide_point(_roc(s, d)),
    "r12_pr": _pr,
    "r13_pr_guide": lambda s, d: R.pr_guide_point(_pr(s, d)),
    "r14_calibration": lambda s, d: R.calibration_curve(scored_fixture(s, d)),
    "e3_auc_doc_length_quality": lambda s, d: M.roc_auc(doc_score_table(s, d)),
    "r10_roc_doc_length_quality": lambda s, d: R.roc_points(doc_score_table(s, d)),
})


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_frame(spark, sf_dir).where(~F.col("is_test"))


def category_index_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary that the training rows give ``preprocessor_v1``."""
    return P.category_dictionary(train_rows(spark, sf_dir))


QUERIES.update({
    "m6_class_weights": lambda s, d: P.class_weight_table(train_rows(s, d)),
    "p3_category_index": category_index_table,
    "r3_dataset_summary": lambda s, d: RP.dataset_summary(featured(s, d), "no_show"),
    "r8_target_distribution": lambda s, d: RP.target_distribution(featured(s, d), "no_show"),
})


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


QUERIES.update({
    "c3a_missing_profile_events": lambda s, d: C.missing_profile(events(s, d)),
    "v11_suite_events": lambda s, d: Q.run_suite(
        events(s, d), Q.table_suite(events(s, d).columns, "event_id")),
})

# One query per check kind (V2-V9) on the raw table.
CHECK_KIND_QUERIES = {
    "v2_compound_unique": ("compound_unique",),
    "v3_column_unique": ("unique",),
    "v4_not_null": ("not_null",),
    "v5_column_types": ("type",),
    "v6_value_in_set": ("in_set",),
    "v7_v8_value_between": ("between",),
    "v9_price_regex": ("regex",),
}


def _kind_query(kinds):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        suite = [k for k in Q.build_suite() if k.kind in kinds]
        return Q.run_suite(raw(spark, sf_dir), suite)
    return q


QUERIES.update({name: _kind_query(kinds) for name, kinds in CHECK_KIND_QUERIES.items()})


def fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(candidate_id, fold, test_score, train_score, fit_time): stand-in for
    the search's long score table, one grouped pass over ``orders``. The last
    three candidates repeat the scores of the first three, so ranks tie."""
    orders = read_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey % 24 AS c", "CAST(o_custkey % 5 AS INT) AS fold", "CAST(floor(o_totalprice) AS BIGINT) AS p")
    scores = orders.groupBy("c", "fold").agg(
        (F.avg(F.col("p") % 1000) / 1000).alias("test_score"), (F.avg(F.col("p") % 900) / 900).alias("train_score"),
        F.avg(F.col("p") % 7).alias("fit_time"))
    c = F.col("c").cast("int")
    ids = F.explode(F.when(c < 3, F.array(c, c + 24)).otherwise(F.array(c)))
    return scores.select(ids.alias("candidate_id"), "fold", "test_score", "train_score", "fit_time")


def candidate_settings(scores: DataFrame) -> DataFrame:
    """(candidate_id, candidate, preprocessor, model_type, params) of the
    fixture's candidates; one family has no learning rate."""
    c = F.col("candidate_id")
    kinds = [f["estimator"]["type"] for f in MD.MODEL_FAMILIES.values()]
    rate = F.when(c % 3 == 0, F.lit(None)).otherwise(F.when(c % 2 == 0, "0.05").otherwise("0.1"))
    return scores.select("candidate_id").distinct().select(
        "candidate_id", F.concat(F.lit("candidate_"), c.cast("string")).alias("candidate"),
        F.lit("preprocessor_v1").alias("preprocessor"), F.element_at(F.array(*map(F.lit, kinds)), c % 3 + 1).alias("model_type"),
        F.create_map(F.lit("n_estimators"), (100 * (1 + c % 3)).cast("string"), F.lit("learning_rate"), rate,
                     F.lit("max_depth"), (c % 5).cast("string")).alias("params"))


def cv_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 / L1 over the fixture scores, written once per session."""
    def build() -> DataFrame:
        scores = fold_scores(spark, sf_dir)
        return MD.cv_results(scores, candidate_settings(scores))
    return _stage(spark, "cv_results", sf_dir, build, ("orders",))


def run_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(runs, CV rows): stand-in for the run log, one run per order and a CV
    row per line item of most orders."""
    runs = read_table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS run_id", "IF(o_orderstatus = 'F', 'FINISHED', 'FAILED') AS status",
        "CAST(o_orderdate AS TIMESTAMP) AS start_time", "o_orderkey % 9 AS c")
    cv = read_table(spark, sf_dir, "lineitem").where("l_orderkey % 3 <> 0").selectExpr("CAST(l_orderkey AS STRING) AS run_id")
    return runs, cv


def cv_results_of_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: two runs with different hyperparameters are stored; one is read back."""
    root = new_stage_path(spark, "run-log")
    cv = cv_table(spark, sf_dir)
    with_rate = F.col("model_type") != "RandomForestClassifier"
    L.append_cv_results(L.cv_results_table(cv.where(~with_rate).withColumn(
        "params", F.map_filter("params", lambda k, v: k != "learning_rate"))), root, "first")
    L.append_cv_results(L.cv_results_table(cv.where(with_rate)), root, "second")
    return L.cv_results_of_run(spark, root, "second").select(
        "run_id", "candidate_id", "rank_test_score", "param_model__learning_rate", "param_model__max_depth",
        "param_model__n_estimators", "param_model")


def best_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each candidate's settings as the run log keeps them."""
    chosen = F.map_concat(F.create_map(F.lit("preprocess"), F.col("preprocessor"), F.lit("model"), F.col("model_type")),
                          F.transform_keys(F.map_filter("params", lambda k, v: v.isNotNull()), lambda k, v: F.concat(F.lit("model__"), k)))
    return cv_table(spark, sf_dir).select("candidate_id", L.format_best_parameters(chosen).alias("params"))


def _rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    return df.select(*[F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


def _pairs(df: DataFrame, column: str) -> DataFrame:
    """A map column as rows."""
    return df.select("candidate_id", F.explode(column).alias("key", "value"))


def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.latest_finished_run(*run_log(spark, sf_dir)).select(
        "run_id", "status", F.col("start_time").cast("date").cast("string").alias("start_day"))


QUERIES.update({
    "k2_isotonic": lambda s, d: _rounded(K.isotonic_blocks(scored_fixture(s, d))),
    "k2_isotonic_doc_length": lambda s, d: _rounded(K.isotonic_blocks(doc_length_scores(s, d))),
    "m8_cv_results": lambda s, d: _rounded(cv_table(s, d).drop("params")),
    "k1_best": lambda s, d: _rounded(MD.best_candidate(cv_table(s, d)).select("candidate_id", "candidate", "mean_test_score")),
    "r1_latest_run": latest_run,
    "r2_cv_of_run": cv_results_of_run,
    "l2_best_parameters": lambda s, d: _pairs(best_settings(s, d), "params"),
    "l5_stringify": lambda s, d: _pairs(cv_table(s, d).select("candidate_id", L.stringify_mapping(F.create_map(
        F.lit("rank"), F.col("rank_test_score"), F.lit("id"), F.col("candidate_id"))).alias("m")), "m"),
    "r5_candidate_label": lambda s, d: RP.candidate_label(cv_table(s, d)).select("candidate_id", "candidate_pipeline"),
    "r6_candidate_ranking": lambda s, d: RP.candidate_ranking(cv_table(s, d)),
    "r7_selected_pipeline": lambda s, d: RP.selected_pipeline(best_settings(s, d).join(
        MD.best_candidate(cv_table(s, d)).select("candidate_id"), "candidate_id", "left_semi")),
    "r9_cv_bars": lambda s, d: _rounded(RP.cv_bar_data(cv_table(s, d))),
})


def round_trip(df: DataFrame, name: str) -> DataFrame:
    """A table that is written, replaced by a rewrite of what was
    read from it, and read back."""
    spark = df.sparkSession
    path = new_stage_path(spark, name)
    sinks.write_parquet(df, path)
    sinks.write_parquet(sinks.read_parquet(spark, path), path)
    return sinks.read_parquet(spark, path)


def continuous_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score that hardly repeats: the share of an order's price in its
    line's price, against whether the line was returned."""
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_extendedprice").cast("double").alias("part"), (F.col("l_returnflag") == "R").cast("int").alias("label"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("whole"))
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        "label", (F.col("part") / (F.col("part") + F.col("whole"))).alias("score"))


def continuous_score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage(spark, "line_scores", sf_dir, lambda: M.score_rows(continuous_scores(spark, sf_dir)), ("lineitem", "orders"))


QUERIES.update({
    "i2_cleaned_round_trip": lambda s, d: round_trip(cleaned(s, d), "i2"),
    "i5_features_round_trip": lambda s, d: round_trip(featured(s, d), "i5"),
    "s1_features_target": lambda s, d: S.features_and_target(featured(s, d)),
    "p1_p2_prepared": lambda s, d: P.prepared_columns(labelled(s, d)).select(
        "booking_id", *[f"{c}__{k}" for k, cols in (("cat", P.CATEGORICAL_FEATURES), ("num", P.NUMERIC_FEATURES),
                                                    ("missing", P.NUMERIC_FEATURES)) for c in cols]),
    "e3_auc_line_share": lambda s, d: M.roc_auc(continuous_score_table(s, d)),
    "r10_roc_line_share": lambda s, d: R.roc_points(continuous_score_table(s, d)),
    "r14_calibration_line_share": lambda s, d: R.calibration_curve(continuous_scores(s, d)),
})
