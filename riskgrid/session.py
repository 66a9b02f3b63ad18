"""Session settings and the shared scratch folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Rows of a grid that a task generates and sorts at most, if places are spread evenly.
TASK_ROWS = 1 << 20


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskgrid")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def own_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings and views, but state of its own.

    A session that has observed counts can't send freshly fitted MLlib models to tasks any more (they refer to it), so
    observations are made in one of their own.
    """
    return SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())


@cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix="riskgrid-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a machine-local folder: executors on other
    machines could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_root(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below the application's scratch folder."""
    return f"{_own_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def _own_scratch(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/riskgrid/{spark.sparkContext.applicationId}"


def delete(spark: SparkSession, folder: str) -> bool:
    """Delete a folder with all below it. Frames that read it can't be used afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> bool:
    """Delete what this application has staged. Frames that read it can't be used afterwards."""
    return delete(spark, _own_scratch(spark))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts lineage: a lost executor re-reads files instead of recomputing the plan, and
    several consumers share one computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def grid_width(spark: SparkSession, rows: int) -> int:
    """Partitions of a frame that will have so many rows, of which no task should sort more than ``TASK_ROWS`` or so."""
    return max(shuffle_width(spark), -(-rows // TASK_ROWS))


@contextmanager
def partition_bytes(spark: SparkSession, most: str) -> Iterator[None]:
    """Adaptive execution aims at partitions of this size in what is run inside."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name, None)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
