"""Spark session defaults and lineage helpers.

The library itself never creates a session: every operator takes DataFrames and returns a lazy DataFrame. This module
is for scripts, tests and the benchmark.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; local runs use the same ones with fewer partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce small shuffle partitions to the advisory size (64 MB) instead of keeping many tiny tasks
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime bloom filters prune the big side of selective shuffle joins (reconciliation joins on iid).
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of shared intermediates are deleted once their DataFrames are no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "tillroll") -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster set `spark.sql.shuffle.partitions` from the largest shuffle (about its bytes / 128 MB, e.g. tens of
    thousands for 100 TB of order lines) and let AQE coalesce; locally one partition per core is enough."""
    master = master or os.environ.get("SPARK_MASTER", f"local[{os.environ.get('BENCH_CPUS', '8')}]")
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions or master.startswith("local"):  # a cluster's own setting stays
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    builder = builder.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder; set a scratch one only when none is configured (local mode).

    Under Spark Connect there is no SparkContext: the server's `spark.checkpoint.dir` is used as configured, and required."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on the server")
        return configured
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith(("local", "local-cluster")):  # single-machine masters may use a scratch folder
        # a machine-local folder would not survive the loss of the executor that wrote it
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS) before running the reports")
    path = tempfile.mkdtemp(prefix="tillroll-ckpt-")  # local mode only (tests, benchmark)
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
