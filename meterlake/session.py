"""Session construction and shared-folder helpers.

Library code never builds a session; it receives one. ``build_session`` is for
tests, the bench and command-line runs. On a cluster the session comes from
the launcher and ``checkpoint_root`` reads the shared folder it names.
"""

from __future__ import annotations

import os
import tempfile

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation, SparkSession

# Settings our jobs rely on. Queries do not depend on the session time zone
# (all timestamps are TIMESTAMP_NTZ), but UTC keeps printed values stable.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only by MEASURED size: static planning never broadcasts (its
    # size estimates can be far too small, e.g. after an explode), and AQE
    # turns a sort-merge join into a broadcast join once the finished stage
    # of one side is measured under 32 MiB. Above that the join stays
    # sort-merge (with AQE skew splitting).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings we recommend for a large cluster (the launcher applies them; the
# library never builds a session there). Sizes are per task, so they hold as
# the data grows: AQE starts from many shuffle partitions and merges them to
# about the advisory size; a partition over 5x the median and 512 MiB is split
# (skew join, skewed rebalance before writes); file splits of 256 MiB keep
# scan tasks large enough for the vectorised Parquet reader.
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    # Arrow batches for the workbook decoder are set per job (few files per
    # batch), see sources.workbook.few_files_per_batch.
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "meterlake", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):
        # one JVM runs every task: give it room (only applies when this call
        # starts the JVM)
        conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir``. Where it is unset, a local session (tests)
    gets a fresh folder; on a cluster a machine-local folder would differ from
    node to node, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="meterlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    return root


def observed(obs: Observation) -> dict:
    """The values of an observation whose action has ended. Where Spark found
    at run time that there are no rows, it drops the observed plan and with it
    the observation, which then cannot be read: that gives no values."""
    try:
        return obs.get
    except Py4JJavaError:
        return {}
