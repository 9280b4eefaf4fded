"""Session defaults and the shared scratch location.

Library functions never create a session; callers pass one in. ``get_session``
exists for tests, the bench and command-line runs.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed join partitions even when that needs an extra shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python call-site capture for error messages is a development aid; it
    # costs driver time on every Column operation while plans are built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(
    master: str | None = None,
    app: str = "clinlake",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Runtime settings that differ from Spark's defaults and that jobs apply to a
# session they did not build, unless the submitter set them.
RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# Static settings a job passes to the builder, unless the submitter set them.
BUILD_DEFAULTS = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def job_session(app: str) -> SparkSession:
    """Session for a submitted job: the environment's settings plus the
    defaults above where the submitter left them unset."""
    from pyspark import SparkConf

    submitted = SparkConf()
    builder = SparkSession.builder.appName(app)
    for key, value in BUILD_DEFAULTS.items():
        if not submitted.contains(key):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_defaults(spark)
    return spark


def apply_runtime_defaults(spark: SparkSession) -> None:
    try:
        submitted = dict(spark.sparkContext.getConf().getAll())
    except Exception:  # noqa: BLE001 - no SparkContext under Spark Connect
        submitted = {}
    for key, value in RUNTIME_DEFAULTS.items():
        if key not in submitted:
            spark.conf.set(key, value)


def _context_checkpoint_dir(spark: SparkSession) -> str | None:
    from pyspark.errors import PySparkException

    try:
        return spark.sparkContext.getCheckpointDir()
    except (AttributeError, PySparkException):  # no SparkContext under Spark Connect
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    The setting is read from the session and never replaced. Where it is unset
    a fresh folder is made only for a local master (tests, bench), whose
    executors see the driver's disk; on a cluster an unset folder is an error,
    since executors would write scratch tables to disks nobody else can read.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or _context_checkpoint_dir(spark)
    if current:
        return current.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.match(r"local(\[|$)", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    local = tempfile.mkdtemp(prefix="clinlake-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/clinlake/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system Spark knows."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


#: Spark keeps an execution's shuffle files until the driver collects its garbage;
#: with this they go when it ends.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of every query and write go as soon as it ends: for
    runs of many writes, each executed once. A DataFrame executed again shuffles again."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def is_local_path(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:")


def local_fs_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def ensure_local_dir(path: str) -> None:
    if is_local_path(path):
        os.makedirs(local_fs_path(path), exist_ok=True)


#: Reducers above this many cost more in shuffle blocks than they gain.
MAX_REDUCERS = 20_000


def scale_conf(shuffle_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20,
               split_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a run whose largest shuffle moves ``shuffle_bytes``.

    Shuffle partitions aim at ``target_partition_bytes`` each, two waves of the
    cores at least and ``MAX_REDUCERS`` at most: mappers times reducers is the
    number of shuffle blocks, so very large shuffles take multi-GB partitions,
    which sort and aggregate by spilling. AQE coalesces small partitions to the
    advisory size (rather than maximising parallelism, so table writes do not
    scatter) and splits skewed ones. Input splits grow with the input likewise.
    """
    partitions = min(MAX_REDUCERS, max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes)))
    target = max(target_partition_bytes, -(-shuffle_bytes // partitions) if partitions == MAX_REDUCERS else 0)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
        "spark.sql.files.maxPartitionBytes": str(max(split_bytes, min(target, 2 << 30))),
    }
