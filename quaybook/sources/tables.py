"""Readers for the given parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one given table. Column pruning and filter pushdown reach the
    parquet scan because everything downstream is declarative."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}; expected one of {TABLES}")
    return spark.read.parquet(table_path(sf_dir, name))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin spread when a scan yields fewer partitions than the
    cluster can run at once (a metadata check, no job). Large inputs already
    have many splits and pass through unchanged, so no shuffle is added at
    scale; a small single-file table stops being a one-task bottleneck."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)
