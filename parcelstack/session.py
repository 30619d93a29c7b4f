"""SparkSession settings the jobs rely on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job needs: UTC day arithmetic, runtime re-planning (AQE
# coalesce + skew-join split + runtime broadcast by measured size), and
# dynamic partition overwrite for per-partition snapshots.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Join keys here are normalized text (regex chains). Inferred IS NOT NULL
    # constraints get pushed below the projections and re-inline those chains
    # into filters many times over (measured 6x slower on the instrument join);
    # keys are never null by construction, so the inference buys nothing.
    "spark.sql.constraintPropagation.enabled": "false",
    # A side is broadcast by its measured size only. The size Spark estimates
    # for a stored table is that of its compressed files, scaled by column
    # widths: 45 MB of owner keys count as under 10 MB there, and such a side
    # would pass the driver and grow with the input.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    # a folder per page file is listed by a few tasks a core, not a task each
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(4 * spark.sparkContext.defaultParallelism))
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "parcelstack") -> SparkSession:
    """A local session for tests and the bench (UI off, no extra ports)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("PARCELSTACK_DRIVER_MEM", "8g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared spark.checkpoint.dir. Without one, a local session
    (tests) gets a scratch folder; on a cluster that is an error, since each
    executor would write to a disk of its own."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="parcelstack-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cluster_settings(input_bytes: int, executor_cores_total: int,
                     target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a cluster run, from the input size.

    Initial shuffle partitions are sized so each holds about
    `target_partition_bytes` of input (at least 2x the cores); AQE then
    coalesces small ones toward the same advisory size and splits skewed
    ones (a partition 5x the median and over 1 GiB). Scans split files at the
    same size. For 100 TB this gives ~400k initial partitions, which AQE
    reduces to what the shuffled volume actually needs (evidence and the
    partially aggregated fold are far smaller than the raw input).
    """
    n = max(2 * executor_cores_total, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    }
