"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings that matter at any scale. AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones (a key holding a
# third of the rows is split across tasks instead of landing in one).
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Small shuffles feeding row-multiplying joins (pair counting) are not
    # squeezed into a single task.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Starting point on a large cluster (~100 TB inputs, ~1000 executors); the
# deployment may override any of these.
# * Scans: 512 MB splits -> ~200k scan tasks for 100 TB.
# * Shuffles: AQE starts from 16k partitions and coalesces to ~256 MB each,
#   so a 2-3 TB shuffle (e.g. 77 bn bigram rows) lands at ~150 MB per task
#   and small shuffles collapse; 200k mappers x 16k reducers keeps the block
#   count manageable. parallelismFirst is off so the advisory size is
#   honoured on a busy cluster.
# * Skew: a partition is split when > 4x the median and > 512 MB.
# * Broadcast: checked sides are at most 256 MB (functions.joins), built on
#   the driver, hence the result-size and timeout settings.
CLUSTER_CONF: dict[str, str] = {
    "spark.sql.files.maxPartitionBytes": "512MB",
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
    "spark.driver.maxResultSize": "4g",
    "spark.sql.broadcastTimeout": "1800",
}


def get_session(app: str = "tidepool", master: str | None = None,
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None, profile: str = "local") -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` and ``shuffle_partitions`` are only for local runs; on a
    cluster they come from the submit configuration, and ``profile="cluster"``
    adds ``CLUSTER_CONF``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    base = {**DEFAULT_CONF, **(CLUSTER_CONF if profile == "cluster" else {})}
    for k, v in {**base, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it (a file system every executor can
    reach), and an unset one is an error: a folder of the driver's machine
    would not be seen by the executors. Only a local session gets a fresh
    scratch folder, as in tests.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that every executor can reach")
        current = tempfile.mkdtemp(prefix="tidepool-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder, under the application's id, which a deployment clears when it has ended."""
    return f"{ensure_checkpoint_dir(spark)}/tables/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def dealt_by_weight(df, weight, most: int, *by):
    """``df`` dealt out by the columns ``by``, to so many partitions that each has about ``most`` of the sum of ``weight``.

    For steps that make many rows of one: a task's share of them stays the same
    as the table grows, and what groups by ``by`` needs no further shuffle. It
    runs one aggregate over ``df``.
    """
    total = df.agg(F.sum(weight)).first()[0] or 0
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(total / most)), *by)


def materialize(df):
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Used where one intermediate feeds several parts of a plan, so that it is
    computed once and its size is known to the planner. It runs a job. The
    files are reliable storage, so a lost executor does not lose them; they lie
    under the application's id, which a deployment clears when it has ended.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
