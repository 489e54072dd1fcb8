"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library should carry. Time zone pinned to UTC so
# epoch <-> timestamp conversions are stable; ANSI stays on (Spark 4 default).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def _default_driver_memory() -> str:
    """About 60% of physical memory, capped at 16 GB (local mode: the driver is the
    only JVM)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    gb = max(1, min(16, int(total * 0.6 / 2**30)))
    return f"{gb}g"


def local_session(app: str = "tessera", cores: str = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("TESSERA_DRIVER_MEMORY", _default_driver_memory())
    # local sessions keep catalog tables out of the working directory
    conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="tessera-wh-")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    return spark.sparkContext.getCheckpointDir() or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Read ``spark.checkpoint.dir`` from the session; only when it is unset in a local
    session (tests, bench) point it at a fresh scratch folder. A cluster session must
    name a shared folder: executors cannot see each other's disks."""
    d = checkpoint_dir(spark)
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df):
    """Reliable lineage cut: ``checkpoint()`` into the shared checkpoint folder.
    Survives executor loss (never ``localCheckpoint``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scale_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 * 2**20) -> dict[str, str]:
    """Settings for a large run, sized from the input volume (a starting point for the
    cluster's own configuration; nothing here is applied automatically).

    * initial shuffle partitions ~ input / target size (AQE coalesces them down to the
      advisory size at runtime, so over-provisioning is cheap), never below 2x cores;
    * scan splits of the same target size;
    * AQE skew-join on, with a skewed partition being 5x the median and > 2x the target.
    """
    parts = max(2 * cores, min(200_000, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 2**20),
    }
