"""Sinks and stage reloads I2-I5."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str) -> None:
    """Overwrite a whole table (cleaned or feature table).

    The rows are written aside first and then take the table's place by two
    renames, so no reader sees a half-written table, a job that fails leaves
    the old one as it was, and ``df`` may itself read ``path``. A reader that
    comes between the renames finds no table, as before a first write; a
    driver lost between them leaves the whole old table in ``<path>.old-*``."""
    spark = df.sparkSession
    tag = uuid.uuid4().hex[:8]
    top = path.rstrip("/")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    new, old, here = hadoop(f"{top}.new-{tag}"), hadoop(f"{top}.old-{tag}"), hadoop(top)
    fs = here.getFileSystem(spark._jsc.hadoopConfiguration())
    df.write.parquet(new.toString())
    replaced = fs.exists(here)
    if replaced and not fs.rename(here, old):
        raise OSError(f"{top} can't be moved aside; the new table is in {new.toString()}")
    if not fs.rename(new, here):
        if replaced:
            fs.rename(old, here)
        raise OSError(f"the new table can't take its place; it is in {new.toString()}")
    if replaced:
        fs.delete(old, True)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Reload a persisted table (schema from the files)."""
    return spark.read.parquet(path)


def write_json(df: DataFrame, path: str, one_file: bool = True) -> None:
    """JSON sink; one file for frames of a handful of rows (validation
    results, metrics, summary), ``one_file=False`` for any that grow with the
    data (curves), which every task then writes by itself."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """I4: CSV with a header (failure reports). Values keep their outer
    whitespace (the writer trims it by default, and examples such as
    ' April ' are the point of the report)."""
    (df.coalesce(1).write.mode("overwrite").option("header", True)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))
