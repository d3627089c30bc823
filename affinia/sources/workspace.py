"""The shared work area that multi-pass jobs write their stage tables to.

A job that reads one result several times writes it as a parquet table first.
That cuts the lineage, survives lost executors, and gives the later passes
column pruning and filter pushdown, which a cached or checkpointed RDD does not.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that deletes the shuffle files of a query when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def work_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Where a cluster names none this raises, because a machine-local folder would
    lose data there. In local mode (tests) a new temporary folder is set instead.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named.rstrip("/")
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the work area that no earlier run has used."""
    return f"{work_root(spark)}/{name}-{uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Let Spark delete the shuffle files of each query run here when the query ends.

    For writes, whose plans are run once. An action on a frame that is run again would
    have to make its shuffles anew.
    """
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` once to the work area and read it back.

    What was shuffled for it is deleted once it is written: otherwise the files of all
    steps of a job lie on the executors' disks until the driver happens to collect them.
    """
    spark = frame.sparkSession
    path = fresh_path(spark, name)
    with shuffles_freed(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
