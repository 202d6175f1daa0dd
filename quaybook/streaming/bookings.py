"""Booking operators on Structured Streaming.

The row-local operators (C2, C4-C7, F1-F9) are plain projections and
filters, so they apply unchanged to a streaming DataFrame. Operators that
need the whole table do not: C1 would keep every row ever seen as state, and
C3's missing rates are table-wide. They run per micro-batch instead:
:func:`start_quality_sink` runs C1 and the quality suite (V11) on every
batch inside ``foreachBatch`` and writes the results as the batch's partition.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaybook.config import DEFAULT, BookingConfig
from quaybook.operators import clean as C
from quaybook.operators import features as FE
from quaybook.operators import quality as Q
from quaybook.sources.bookings import RAW_SCHEMA, TEXT_SCHEMA


def read_booking_stream(spark: SparkSession, folder: str, fmt: str = "parquet",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """New raw booking files in ``folder`` as a stream (declared schema; csv
    columns stay text until C5, as in the batch reader)."""
    reader = spark.readStream.schema(TEXT_SCHEMA if fmt == "csv" else RAW_SCHEMA).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)


def row_local_features(stream: DataFrame, cfg: BookingConfig = DEFAULT) -> DataFrame:
    """C2, C4, C5, C6, C7 then F1-F9 on a streaming (or batch) DataFrame."""
    return (stream.transform(C.drop_missing_target, cfg)
                  .transform(C.adult_words_to_digits, cfg)
                  .transform(C.parse_numeric_columns, cfg)
                  .transform(C.standardize_months)
                  .transform(C.null_invalid_days)
                  .transform(FE.add_features, cfg))


def _checkpoint(spark: SparkSession, name: str, location: str | None) -> str:
    if location:
        return location
    from quaybook.session import ensure_checkpoint_dir
    return os.path.join(ensure_checkpoint_dir(spark), "streams", name)


def start_feature_sink(features: DataFrame, out: str, checkpoint: str | None = None,
                       available_now: bool = False):
    """Append the streamed feature rows to a parquet folder (exactly-once
    through the file sink's log and the checkpoint)."""
    w = (features.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", _checkpoint(features.sparkSession, "features", checkpoint))
         .outputMode("append"))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def start_quality_sink(raw_stream: DataFrame, out: str, checkpoint: str | None = None,
                       available_now: bool = False):
    """Per micro-batch: C1 and the full check suite, as one partition
    ``batch_id`` of a parquet table. A batch that runs again after a failure
    replaces its own partition and no other, so every batch counts once."""
    def run(batch: DataFrame, batch_id: int) -> None:
        results = Q.run_suite(C.drop_duplicate_rows(batch)).withColumn(
            "batch_id", F.lit(batch_id).cast("bigint"))
        (results.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch_id").parquet(out))

    w = (raw_stream.writeStream.foreachBatch(run)
         .option("checkpointLocation", _checkpoint(raw_stream.sparkSession, "quality", checkpoint)))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
