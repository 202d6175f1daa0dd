"""Curve data R10-R14: the points behind the ROC, precision-recall and
calibration charts, and the guide points at a target rate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaybook.config import CALIBRATION_BINS, GUIDE_RATE
from quaybook.plans.prefix import (DEFAULT_BUCKETS, count_less_than, next_row, order_statistics,
                                   quantile_edges, running_totals)
from quaybook.plans.stages import write_stage

INF = float("inf")
DIGITS = 10


def roc_points(table: DataFrame, drop_intermediate: bool = True) -> DataFrame:
    """(fpr, tpr, threshold) per distinct score, descending, starting
    at (0, 0, +inf). With ``drop_intermediate`` a point is dropped when it is
    collinear with its neighbours, i.e. when the next score carries the same
    positive and negative counts (first and last points always stay).
    Neighbours come from a window inside each bucket, not a global one."""
    pts = table
    if drop_intermediate:
        pts = next_row(table, ["pos", "neg"])
        keep = ((F.col("row_index") == 0) | F.col("next_pos").isNull()
                | (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg")))
        pts = pts.where(keep)
    body = pts.select(
        F.col("row_index").cast("bigint").alias("point"),
        F.try_divide(F.col("fp").cast("double"), F.col("N")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("P")).alias("tpr"),
        F.col("score").alias("threshold"))
    start = table.where(F.col("row_index") == 0).select(
        F.lit(-1).cast("bigint").alias("point"), F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"), F.lit(INF).alias("threshold"))
    return start.unionByName(body)


def roc_guide_point(points: DataFrame, rate: float = GUIDE_RATE) -> DataFrame:
    """The ROC point whose tpr is nearest the rate; the first one in
    descending-threshold order wins ties."""
    key = F.struct(F.abs(F.col("tpr") - F.lit(rate)).alias("d"),
                   F.col("point").alias("p"))
    best = F.min_by(F.struct("fpr", "tpr", "threshold"), key)
    return points.agg(best.alias("b")).select("b.fpr", "b.tpr", "b.threshold")


def pr_points(table: DataFrame) -> DataFrame:
    """(recall, precision, threshold) per distinct score plus the end
    point (recall 0, precision 1, no threshold)."""
    tp, fp = F.col("tp").cast("double"), F.col("fp")
    body = table.select(
        F.col("row_index").cast("bigint").alias("point"),
        F.coalesce(F.try_divide(tp, F.col("P")), F.lit(1.0)).alias("recall"),
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.col("score").alias("threshold"))
    end = table.where(F.col("row_index") == 0).select(
        F.lit(-1).cast("bigint").alias("point"), F.lit(0.0).alias("recall"),
        F.lit(1.0).alias("precision"), F.lit(None).cast("double").alias("threshold"))
    return body.unionByName(end)


def pr_guide_point(points: DataFrame, rate: float = GUIDE_RATE) -> DataFrame:
    """The PR point whose recall is nearest the rate; ties go to the
    lowest threshold (the curve is listed by ascending threshold, end point
    last)."""
    order = F.coalesce(F.col("threshold"), F.lit(INF))
    key = F.struct(F.abs(F.col("recall") - F.lit(rate)).alias("d"), order.alias("t"))
    best = F.min_by(F.struct("recall", "precision", "threshold"), key)
    return points.agg(best.alias("b")).select("b.recall", "b.precision", "b.threshold")


def calibration_counts(scored: DataFrame, label: str = "label", score: str = "score",
                       n_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """One row per distinct score: ``n`` rows, of them ``labelled`` with
    ``positive`` in sum, and the running counts ``cum_n`` and ``total_n``.
    Rows without a score take no part."""
    rows = scored.select(F.col(score).cast("double").alias("score"), F.col(label).cast("double").alias("y")).where("score IS NOT NULL")
    per = rows.groupBy("score").agg(F.count(F.lit(1)).alias("n"), F.count("y").alias("labelled"), F.sum("y").alias("positive"))
    return running_totals(per, "score", ["n"], descending=False, n_buckets=n_buckets,
                          edges=quantile_edges(rows, "score", n_buckets))


def calibration_edges(counts: DataFrame, n_bins: int = CALIBRATION_BINS) -> list[float | None]:
    """The n_bins + 1 quantile edges (exact, linear interpolation)."""
    return order_statistics(counts, "score", [i / n_bins for i in range(n_bins + 1)])


def calibration_curve(scored: DataFrame, label: str = "label", score: str = "score",
                      n_bins: int = CALIBRATION_BINS) -> DataFrame:
    """Quantile bins; per non-empty bin the mean predicted probability
    and the observed positive rate. A score equal to an inner edge goes to
    the lower bin. The scored rows are read for the counts only; edges and
    bins come from the written table of distinct scores."""
    counts = write_stage(calibration_counts(scored, label, score), "calibration")
    inner = [e for e in calibration_edges(counts, n_bins)[1:-1] if e is not None]
    s = F.col("score")
    return (counts.withColumn("bin", count_less_than(s, inner))
            .groupBy("bin")
            .agg(F.sum("n").alias("n"),
                 F.round(F.sum(s * F.col("n")) / F.sum("n"), DIGITS).alias("mean_predicted"),
                 F.round(F.try_divide(F.sum("positive"), F.sum("labelled")), DIGITS).alias("observed_rate")))
