"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile

import pyarrow as pa
import quaybook
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaybook.session import ensure_checkpoint_dir

_SHIPPED: set[str] = set()
BATCH_BYTES = "2m"  # of an Arrow batch; a longer row comes alone
READ_ROWS = "512"  # of a Parquet batch, whose texts lie in one array of the heap


def prepare(spark: SparkSession) -> None:
    """Make the session ready for these operators: the shared folder is known,
    Arrow batches of whole texts are bounded by bytes and not only by rows,
    Parquet batches hold few rows, and the executors can import this package
    (its source files are sent to them once per application)."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", READ_ROWS)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(quaybook.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="quaybook-src-"), "quaybook.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(top):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("quaybook", os.path.relpath(path, top)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def release_memory() -> None:
    """Give the system back what this worker process has freed. Workers stay
    for later stages, and what their allocators hold counts against the
    executor until then."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under fixed names (``new=old``), so that extra
    columns of the input can't clash with what an operator adds."""
    return df.select(*[df[old].alias(new) for new, old in columns.items()])


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
