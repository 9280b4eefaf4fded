"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from clinlake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by Spark's own reader (any path Spark can read)."""
    show_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that Spark hands to Python at once, where the session does not say:
#: documents are long, and every running task holds a few batches of them.
ARROW_ROWS = "1000"
#: Rows of a Parquet batch, where the session does not say: with texts, Spark's
#: 4,096 rows are arrays of many MB, which fragment an executor's heap.
READER_ROWS = "512"


def show_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it
    (on a cluster it is installed there or shipped with ``--py-files``), and
    keep their batches small."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    for key, rows in (("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS), ("spark.sql.parquet.columnarReaderBatchSize", READER_ROWS)):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, rows)


def materialize(df: DataFrame, name: str, scratch: list[str] | None = None) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage with a table all executors can read, so a lost executor
    costs no recomputation of what came before. ``scratch`` notes the table
    for ``discard``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if scratch is not None:
        scratch.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, scratch: list[str]) -> None:
    """Delete scratch tables that nothing reads any more."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while scratch:
        path = jvm.org.apache.hadoop.fs.Path(scratch.pop())
        path.getFileSystem(conf).delete(path, True)


def release_memory() -> None:
    """Give a Python worker's free memory back at the end of a task, for the worker
    lives on and may run another operator next (glibc keeps it otherwise)."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
