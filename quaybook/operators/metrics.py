"""Holdout metrics E1, E3-E11 on a scored frame (label 0/1, score in [0, 1]).

Everything is computed from the *score table*: one row per distinct score
with its positive/negative counts and their running sums in descending
score order (:func:`quaybook.plans.prefix.running_totals`). Ranking metrics
need those running sums; the threshold metrics and the two losses are plain
sums over the same table, so the whole metric set is one aggregate over a
table no larger than the number of distinct scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaybook.config import LOG_LOSS_EPS
from quaybook.plans.prefix import DEFAULT_BUCKETS, quantile_edges, running_totals
from quaybook.plans.stages import write_stage

THRESHOLD = 0.5
METRIC_DIGITS = 10
METRIC_COLUMNS = ("test_roc_auc", "test_average_precision", "test_brier_score",
                  "test_log_loss", "test_accuracy", "test_precision", "test_recall",
                  "test_f1")


def predict_class(scored: DataFrame, score: str = "score", out: str = "prediction",
                  threshold: float = THRESHOLD) -> DataFrame:
    """Class 1 iff the positive-class probability exceeds the threshold
    (an exact tie goes to class 0)."""
    return scored.withColumn(out, (F.col(score) > F.lit(threshold)).cast("int"))


def score_rows(scored: DataFrame, label: str = "label", score: str = "score",
                n_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Distinct scores (descending) with pos/neg counts, running tp/fp and
    the totals P/N. Columns: score, pos, neg, bucket, row_index, tp, fp, P, N.

    A row with a null score or label cannot be ranked; ``dropped_scores``
    counts those rows."""
    y = F.col(label).cast("int")
    rows = (scored.where(F.col(score).isNotNull() & y.isNotNull())
            .select(F.col(score).cast("double").alias("score"), y.alias("y")))
    per = rows.groupBy("score").agg(F.sum("y").cast("bigint").alias("pos"),
                                    F.sum(1 - F.col("y")).cast("bigint").alias("neg"))
    t = running_totals(per, "score", ["pos", "neg"], descending=True, n_buckets=n_buckets,
                       edges=quantile_edges(rows, "score", n_buckets))
    return t.select("score", "pos", "neg", "bucket", "row_index",
                    F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                    F.col("total_pos").alias("P"), F.col("total_neg").alias("N"))


def score_table(scored: DataFrame, label: str = "label", score: str = "score",
                n_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """``score_rows`` written once as a stage: the metrics and curves read
    it several times and prune different columns, so Spark would not reuse
    one computation for them."""
    return write_stage(score_rows(scored, label, score, n_buckets), "scores")


def dropped_scores(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Rows that ``score_rows`` leaves out, by reason."""
    return scored.agg(
        F.count_if(F.col(score).isNull()).alias("null_score"),
        F.count_if(F.col(score).isNotNull() & F.col(label).cast("int").isNull()).alias("null_label"))


def _r(c: Column) -> Column:
    return F.round(c, METRIC_DIGITS)


def _auc() -> Column:
    """Sum over distinct scores of pos x (negatives below + half the tied
    negatives), over P x N."""
    pos, neg, fp = F.col("pos"), F.col("neg"), F.col("fp")
    # P x N in double: as 64-bit integers it overflows past 9.2e18 pairs.
    return F.try_divide(F.sum(pos * (F.col("N") - fp + 0.5 * neg)).cast("double"),
                        F.first("P").cast("double") * F.first("N"))


def _ap() -> Column:
    pos, tp, fp = F.col("pos"), F.col("tp"), F.col("fp")
    return F.try_divide(F.sum(pos * (tp / (tp + fp))), F.first("P"))


def roc_auc(table: DataFrame) -> DataFrame:
    """Exact ROC AUC; tied scores count one half."""
    return table.agg(_r(_auc()).alias("roc_auc"))


def average_precision(table: DataFrame) -> DataFrame:
    """Step-wise average precision, sum over thresholds of
    (R_n - R_(n-1)) * P_n (not the trapezoid area)."""
    return table.agg(_r(_ap()).alias("average_precision"))


def metric_set(table: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """E11 (with E5-E10): all eight holdout metrics in one row, from one
    aggregate over the score table. The predicted class is score > threshold."""
    s, pos, neg = F.col("score"), F.col("pos"), F.col("neg")
    above = s > F.lit(threshold)
    tp = F.sum(F.when(above, pos).otherwise(0))
    fp = F.sum(F.when(above, neg).otherwise(0))
    fn = F.sum(F.when(above, 0).otherwise(pos))
    tn = F.sum(F.when(above, 0).otherwise(neg))
    n = F.sum(pos + neg)
    clipped = F.least(F.greatest(s, F.lit(LOG_LOSS_EPS)), F.lit(1 - LOG_LOSS_EPS))
    brier = F.sum(pos * F.pow(1 - s, 2) + neg * F.pow(s, 2)) / n
    log_loss = -F.sum(pos * F.log(clipped) + neg * F.log(1 - clipped)) / n
    zero = F.lit(0.0)
    return table.agg(
        _r(_auc()).alias("test_roc_auc"),
        _r(_ap()).alias("test_average_precision"),
        _r(brier).alias("test_brier_score"),
        _r(log_loss).alias("test_log_loss"),
        _r((tp + tn) / n).alias("test_accuracy"),
        _r(F.coalesce(F.try_divide(tp, tp + fp), zero)).alias("test_precision"),
        _r(F.coalesce(F.try_divide(tp, tp + fn), zero)).alias("test_recall"),
        _r(F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero)).alias("test_f1"),
    )


def confusion_counts(table: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """tp / fp / fn / tn at the threshold."""
    above = F.col("score") > F.lit(threshold)
    return table.agg(
        F.sum(F.when(above, F.col("pos")).otherwise(0)).cast("bigint").alias("tp"),
        F.sum(F.when(above, F.col("neg")).otherwise(0)).cast("bigint").alias("fp"),
        F.sum(F.when(above, 0).otherwise(F.col("pos"))).cast("bigint").alias("fn"),
        F.sum(F.when(above, 0).otherwise(F.col("neg"))).cast("bigint").alias("tn"),
    )


def evaluate(scored: DataFrame, label: str = "label", score: str = "score",
             n_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Scored rows -> the one-row metric set."""
    return metric_set(score_table(scored, label, score, n_buckets))
