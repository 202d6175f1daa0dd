"""Stage tables: where a chain is written out and read back.

The original pipeline hands cleaned and feature tables between stages as
files. Here a stage is a parquet table below the session's
``spark.checkpoint.dir`` (a shared folder on a cluster). Writing it cuts
lineage, so work lost with an executor is recomputed from the written table
instead of from the raw scan. Reading it back is an ordinary parquet scan:
columns are pruned, filters pushed down, and the planner knows its size (so
whether a join side is broadcast is decided by ``autoBroadcastJoinThreshold``
and never by a hint).

All stages of one session lie in one folder named after the application and
a random run id, so no run reads another run's tables; ``clear_stages``
removes the folder, and it is also removed when the driver process ends.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from quaybook.session import ensure_checkpoint_dir

_RUN_ID = uuid.uuid4().hex[:12]
_STAGES: dict[tuple, DataFrame] = {}
_FOLDERS: dict[str, SparkSession] = {}


def _hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of any path that Spark can open."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def stage_folder(spark: SparkSession) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    folder = f"{base}/stages-{spark.sparkContext.applicationId}-{_RUN_ID}"
    if folder not in _FOLDERS:
        if not _FOLDERS:
            atexit.register(_clear_all)
        _FOLDERS[folder] = spark
    return folder


def new_stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the session's stage folder."""
    return f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}"


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet stage (one job) and return the scan of it."""
    spark = df.sparkSession
    path = new_stage_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def drop_stage(df: DataFrame) -> None:
    """Remove the files of a frame returned by ``write_stage`` (for example
    the previous round of an iteration). Nothing may read it afterwards."""
    path = getattr(df, "_stage_path", None)
    if path:
        fs, p = _hadoop_path(df.sparkSession, path)
        fs.delete(p, True)


def clear_stages(spark: SparkSession) -> None:
    """Remove every stage table of this session and forget the reused ones."""
    folder = stage_folder(spark)
    app = spark.sparkContext.applicationId
    for key in [k for k in _STAGES if k[0] == app]:
        del _STAGES[key]
    fs, p = _hadoop_path(spark, folder)
    fs.delete(p, True)


def _clear_all() -> None:
    for folder, spark in _FOLDERS.items():
        try:
            fs, p = _hadoop_path(spark, folder)
            fs.delete(p, True)
        except Exception:  # the JVM may be gone when the driver exits
            pass


def source_state(spark: SparkSession, *paths: str) -> tuple:
    """(path, bytes, newest change) of each source, so that a stage is not
    reused after its files changed. Reads file metadata only."""
    state = []
    for path in paths:
        fs, p = _hadoop_path(spark, path)
        if not fs.exists(p):
            state.append((path, None, None))
            continue
        top = fs.getFileStatus(p)
        files = list(fs.listStatus(p)) if top.isDirectory() else [top]
        state.append((path, sum(f.getLen() for f in files),
                      max((f.getModificationTime() for f in files), default=0)))
    return tuple(state)


def stage_table(spark: SparkSession, key: tuple, build, sources: tuple[str, ...] = (), written: bool = False) -> DataFrame:
    """A stage written once per session and source state, and reused by
    every later query of that session. ``key`` names the stage and its
    inputs; ``sources`` are the paths whose files decide whether it is fresh;
    ``written`` says that ``build`` returns a scan of stages already."""
    full = ((spark.sparkContext.applicationId,) + tuple(key) + source_state(spark, *sources))
    if full not in _STAGES:
        _STAGES[full] = build() if written else write_stage(build(), str(key[0]))
    return _STAGES[full]
