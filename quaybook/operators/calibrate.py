"""Cross-fitted isotonic calibration K2, probability scoring E2 and model
persistence L4.

K2: for each calibration fold, fit the selected pipeline on the other folds
and fit an isotonic map score -> label on the held-out fold; the final
probability is the mean of the per-fold calibrated probabilities.

The isotonic map is pooled in parallel (``isotonic_blocks``): held-out scores
are aggregated per distinct score and cut into score ranges, every range pools
its adjacent violators by itself, and the block summaries of neighbouring
ranges are pooled again level by level. Pooling a part first never changes
the result, since two scores pooled there are pooled in the whole too. What
is left has strictly increasing rates; n rows can't make more than about
n**(2/3) of them (the rates are different fractions whose denominators add up
to n), and only these blocks reach Spark's own isotonic model, which keeps
and interpolates them.

Scoring chains the fold models as row-local projections (no join, no
shuffle): each pipeline and isotonic model adds one probability column.
"""

from __future__ import annotations

import json
import os

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaybook.operators.models import probability_of_one, refit
from quaybook.plans.prefix import add_bucket, quantile_edges
from quaybook.plans.stages import write_stage

RANGES = 256  # score ranges that pool by themselves first
FAN_IN = 32  # neighbouring ranges that are pooled together in a level
BLOCK = "bucket int, lo double, hi double, rows long, positives long"


class CalibratedModel:
    """Fold pipelines with their isotonic maps."""

    def __init__(self, pipelines: list[PipelineModel], isotonics: list[IsotonicRegressionModel]):
        self.pipelines = pipelines
        self.isotonics = isotonics

    def predict_proba(self, df: DataFrame, out: str = "score") -> DataFrame:
        """Mean calibrated positive-class probability."""
        keep = df.columns
        cur = df
        cols = []
        for i, (pm, iso) in enumerate(zip(self.pipelines, self.isotonics)):
            scored = probability_of_one(pm.transform(cur), f"__raw{i}")
            iso_i = iso.copy().setFeaturesCol(f"__raw{i}").setPredictionCol(f"__cal{i}")
            cur = iso_i.transform(scored).select(*keep, *cols, f"__cal{i}")
            cols.append(f"__cal{i}")
        mean = sum((F.col(c) for c in cols[1:]), F.col(cols[0])) / F.lit(float(len(cols)))
        return cur.withColumn(out, mean).drop(*cols)

    def predict(self, df: DataFrame, score: str = "score", out: str = "prediction") -> DataFrame:
        """E1 on calibrated probabilities: class 1 iff p > 0.5."""
        return self.predict_proba(df, score).withColumn(out, (F.col(score) > 0.5).cast("int"))

    # L4 ---------------------------------------------------------------------
    def save(self, path: str) -> str:
        for i, (pm, iso) in enumerate(zip(self.pipelines, self.isotonics)):
            pm.write().overwrite().save(os.path.join(path, f"fold{i}", "pipeline"))
            iso.write().overwrite().save(os.path.join(path, f"fold{i}", "isotonic"))
        return path

    @classmethod
    def load(cls, path: str, folds: int) -> "CalibratedModel":
        pms = [PipelineModel.load(os.path.join(path, f"fold{i}", "pipeline")) for i in range(folds)]
        isos = [IsotonicRegressionModel.load(os.path.join(path, f"fold{i}", "isotonic"))
                for i in range(folds)]
        return cls(pms, isos)


def isotonic_blocks(scored: DataFrame, label: str = "label", score: str = "score",
                    n_buckets: int = RANGES, fan_in: int = FAN_IN) -> DataFrame:
    """(lo, hi, rows, positives, calibrated) of the blocks of the increasing
    isotonic fit of a 0/1 label, ordered by their scores. Rows without a score
    or a label are left out; no rows give no blocks."""
    def pool(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        """Adjacent violators of one range, pooled until the rates increase."""
        out: list[list] = []
        columns = ("lo", "hi", "rows", "positives")
        for lo, hi, rows, positives in blocks.sort_values("lo")[list(columns)].itertuples(index=False, name=None):
            # Rates are compared as fractions of whole numbers, so exactly.
            while out and out[-1][3] * rows >= positives * out[-1][2]:
                lo, _, n, p = out.pop()
                rows, positives = rows + n, positives + p
            out.append([lo, hi, rows, positives])
        pooled = pd.DataFrame(out, columns=columns)
        pooled.insert(0, "bucket", key[0])
        return pooled

    x, y = F.col(score).cast("double"), F.col(label).cast("int")
    rows = scored.select(x.alias("x"), y.alias("y")).where("x IS NOT NULL AND NOT isnan(x) AND y IS NOT NULL")
    per = rows.groupBy("x").agg(F.count(F.lit(1)).alias("rows"), F.sum("y").alias("positives"))
    edges = quantile_edges(rows, "x", n_buckets)
    blocks = add_bucket(per, "x", edges).select("bucket", F.col("x").alias("lo"), F.col("x").alias("hi"), "rows", "positives")
    ranges = len(edges) + 1
    while True:
        blocks = write_stage(blocks.groupBy("bucket").applyInPandas(pool, BLOCK), "isotonic")
        if ranges <= 1:
            return blocks.select("lo", "hi", "rows", "positives", (F.col("positives") / F.col("rows")).alias("calibrated"))
        blocks = blocks.withColumn("bucket", F.floor(F.col("bucket") / fan_in).cast("int"))
        ranges = -(-ranges // fan_in)


def isotonic_fit(scored: DataFrame, label: str = "label", score: str = "score",
                 n_buckets: int = RANGES) -> IsotonicRegressionModel:
    """Increasing isotonic map score -> P(label = 1): Spark's model over the
    ends of the pooled blocks, between which it interpolates."""
    ends = isotonic_blocks(scored, label, score, n_buckets).select(
        F.explode(F.array_distinct(F.array("lo", "hi"))).alias("__x"), F.col("calibrated").alias("__y"), F.lit(1.0).alias("__w"))
    return IsotonicRegression(featuresCol="__x", labelCol="__y", weightCol="__w", isotonic=True).fit(ends)


def calibrate(train: DataFrame, entry: dict, label: str = "label",
              fold_col: str = "fold") -> CalibratedModel:
    """K2 on a training frame that carries calibration fold ids."""
    folds = sorted(r[0] for r in train.select(fold_col).distinct().collect())
    pipelines, isotonics = [], []
    for f in folds:
        pm = refit(train.where(F.col(fold_col) != f), entry, label)
        held = probability_of_one(pm.transform(train.where(F.col(fold_col) == f)), "__s")
        isotonics.append(isotonic_fit(held.select(label, "__s"), label, "__s"))
        pipelines.append(pm)
    return CalibratedModel(pipelines, isotonics)


def save_manifest(spark, path: str, manifest: dict) -> None:
    """Small JSON manifest next to a saved model (one row, written by Spark)."""
    spark.createDataFrame([(json.dumps(manifest),)], "manifest string") \
        .coalesce(1).write.mode("overwrite").text(os.path.join(path, "manifest"))


def load_manifest(spark, path: str) -> dict:
    return json.loads(spark.read.text(os.path.join(path, "manifest")).first()[0])
