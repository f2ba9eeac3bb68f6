"""Session construction for tests, the bench and local runs.

On a cluster the caller owns the session; ``tune`` only fills in settings
that matter for these plans and leaves anything already set alone.
"""

from __future__ import annotations

import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings every plan here relies on.  AQE re-plans joins from runtime sizes
# (a filtered side that turns out small becomes a broadcast), coalesces small
# shuffle partitions and splits skewed join partitions, so a user or movie
# holding a large share of the ratings does not land in one task.
PLAN_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    # A one-user query selects a few orders out of a table as large as the
    # ratings: a runtime bloom filter of their keys filters the ratings at
    # their scan, before the shuffle.  Spark's defaults expect the filter's
    # side to be a small table; here it is a selective filter on a large one.
    # The filter's own size stays bounded (runtime.bloomFilter.maxNumBits).
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1024t",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1m",
}


MB = 1 << 20


# A map status keeps about one bit per reducer on the driver, so scan tasks
# times reducers / 8 bytes is what the driver holds for one shuffle.
MAX_SCAN_TASKS = 100_000
MIN_SPLIT = 128 * MB
REDUCER_BYTES = 512 * MB


def scale_settings(
    input_bytes: int, total_cores: int, shuffle_bytes: int | None = None, reducer_bytes: int = REDUCER_BYTES
) -> dict[str, str]:
    """Scan and shuffle sizing for ``input_bytes`` of input on ``total_cores``.

    The two are sized apart.  Scans stream, so a split may be large: 128 MB,
    or what keeps the scan within ``MAX_SCAN_TASKS`` tasks.  A reducer sorts
    what it reads, so the count of reducers follows the bytes a shuffle really
    moves (pruned columns, after partial aggregation; a tenth of the input
    unless ``shuffle_bytes`` says otherwise) at ``reducer_bytes`` each, two
    waves of the cores at least; AQE coalesces them for small shuffles.

    100 TB on 8,000 cores: splits of 1 GB, 100,000 scan tasks (12.5 waves);
    10 TB moved, 20,480 reducers of 512 MB; 2 * 10^9 blocks, and a map status
    of 20,480 bits per scan task, 256 MB on the driver.
    """
    if input_bytes < 0 or total_cores < 1 or reducer_bytes < 1:
        raise ValueError("input_bytes must be >= 0, total_cores and reducer_bytes >= 1")
    moved = input_bytes // 10 if shuffle_bytes is None else shuffle_bytes
    split = max(MIN_SPLIT, -(-input_bytes // MAX_SCAN_TASKS))
    reducers = max(2 * total_cores, -(-moved // reducer_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(reducers),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(reducers),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(reducer_bytes // 4),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(reducer_bytes),
    }


def build_session(
    master: str | None = None,
    app_name: str = "reelscope",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    driver_memory: str | None = None,
) -> SparkSession:
    """A session with the UI off, UTC and the plan defaults applied.

    Without ``master`` the one Spark is configured with is used, or
    ``local[*]``.  Memory and partitions are the caller's choice; unset they
    are Spark's defaults.
    """
    builder = SparkSession.builder.appName(app_name)
    if master or not SparkConf().contains("spark.master"):
        builder = builder.master(master or "local[*]")
    settings = {"spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", **PLAN_DEFAULTS}
    if driver_memory:
        settings["spark.driver.memory"] = driver_memory
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in {**settings, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``PLAN_DEFAULTS`` to an existing session where unset."""
    for key, value in PLAN_DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the cluster names; make one only if unset.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is.  Only a local/test session without it gets a fresh folder.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="reelscope-ckpt-")
    sc.setCheckpointDir(path)
    return path
