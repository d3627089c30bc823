"""Parquet sinks and catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return bool(target.getFileSystem(conf).exists(target))


def write_parquet(frame: DataFrame, path: str) -> None:
    """Write parquet, replacing what is there."""
    frame.write.mode("overwrite").parquet(path)


def write_new(frame: DataFrame, path: str) -> bool:
    """Write parquet to a path that must not exist yet.

    Returns False at once, before any job starts, where the path exists. A path
    that appears while the job runs still makes the write fail.
    """
    if path_exists(frame.sparkSession, path):
        return False
    frame.write.mode("errorifexists").parquet(path)
    return True


def clustered(
    frame: DataFrame, column: str, *, order: Sequence[str] = (), most_files: int | None = None
) -> DataFrame:
    """Rows of a partition value together, sorted, for a partitioned write.

    Without ``most_files`` the rebalance hint hash-partitions by value and lets adaptive
    execution split a value too large for one task and merge the tiny ones, so files have
    a bounded size and one value may hold most of the rows. With it, each value is dealt
    over that many tasks at most and has no more files, whatever its size. The partition
    column leads the sort; otherwise the writer would sort again and lose the order.
    """
    if most_files is None:
        dealt = frame.hint("rebalance", column)
    else:
        slot = F.pmod(F.xxhash64(*frame.columns), F.lit(most_files))
        dealt = frame.repartition(F.col(column), slot)
    return dealt.sortWithinPartitions(column, *order)


def write_partitioned(
    frame: DataFrame,
    path: str,
    column: str,
    *,
    only_given_partitions: bool = False,
    order: Sequence[str] = (),
    most_files: int | None = None,
) -> None:
    """Write one folder per value of ``column``, clustered (see ``clustered``).

    With ``only_given_partitions`` the folders of values absent from ``frame`` stay.
    """
    dealt = clustered(frame, column, order=order, most_files=most_files)
    writer = dealt.write.mode("overwrite").partitionBy(column)
    if only_given_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def create_or_replace_table(
    frame: DataFrame,
    table: str,
    *,
    path: str | None = None,
    partition_by: str | None = None,
    order: Sequence[str] = (),
    most_files: int | None = None,
) -> DataFrame:
    """Publish a frame as a catalog table, replacing an earlier one."""
    return _save(frame, table, "overwrite", path, partition_by, order, most_files)


def create_table(
    frame: DataFrame,
    table: str,
    *,
    path: str | None = None,
    partition_by: str | None = None,
    order: Sequence[str] = (),
    most_files: int | None = None,
) -> DataFrame:
    """Publish a frame as a new catalog table; fails where the table exists."""
    return _save(frame, table, "errorifexists", path, partition_by, order, most_files)


def _save(
    frame: DataFrame,
    table: str,
    mode: str,
    path: str | None,
    partition_by: str | None,
    order: Sequence[str],
    most_files: int | None,
) -> DataFrame:
    if partition_by is not None:
        frame = clustered(frame, partition_by, order=order, most_files=most_files)
    writer = frame.write.format("parquet").mode(mode)
    if path is not None:
        writer = writer.option("path", path)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(table)
    return frame.sparkSession.table(table)
