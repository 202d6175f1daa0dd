"""Spark session settings the operators are designed for."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces small
# shuffle partitions, skew-join splits hot keys, and the UI stays off.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "quaybook") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for key, value in SCALE_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``. Only a local-mode
    session without one gets a scratch folder (tests, single-machine runs);
    on a cluster a machine-local folder would not survive an executor loss,
    so the setting is required there."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        # "local" and "local[n]" run executors inside the driver; "local-cluster"
        # does not, and counts as a cluster.
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("Set spark.checkpoint.dir to a shared folder (for example "
                               "on the cluster file system); stage tables are written there.")
        configured = tempfile.mkdtemp(prefix="quaybook-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(configured)
    return configured
