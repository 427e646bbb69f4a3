"""Session helpers: settings the library relies on, and the checkpoint folder.

Nothing here is required when a cluster session is already configured; the
library only reads ``spark.checkpoint.dir`` from the session and sets a
folder of its own where none is set and the master is local (tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in the library is written against.
#  * AQE re-plans joins from runtime sizes, coalesces small shuffle partitions
#    and splits skewed join partitions (one project or version may own a third
#    of all rows).
#  * Timestamps are produced as TIMESTAMP_NTZ holding UTC wall time, so the
#    session zone only matters for reading zoned inputs; UTC keeps that simple.
RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    master: str | None = None,
    app_name: str = "catalink",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with the library's recommended settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    A cluster names it in ``spark.checkpoint.dir``; this is read and used as
    is.  Only a local session without one (unit tests) gets a fresh folder
    under the system temp dir.  A non-local session without a setting is an
    error: a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/ABFS) for lineage cuts"
        )
    folder = tempfile.mkdtemp(prefix="catalink-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def scale_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a cluster run, from the input size and the core count.

    Shuffle partitions are set so that each holds about
    ``target_partition_bytes`` of the input (at least two waves of tasks);
    AQE then coalesces the small ones and splits skewed ones, so the number
    is an upper bound, not a guess to be exact about.  File splits match the
    same size so scan tasks fit in executor memory with room to spill.
    """
    partitions = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }
