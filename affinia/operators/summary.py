"""Counts, averages, top lists and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(frame: DataFrame, *columns: str) -> DataFrame:
    """Rows per value, most frequent first. An array counts as one value."""
    return frame.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *columns)


def count_present(frame: DataFrame, column: str) -> DataFrame:
    """Non-null values per value: the null group counts 0."""
    return frame.groupBy(column).agg(F.count(column).alias("n"))


def average_by(frame: DataFrame, value: str, *columns: str) -> DataFrame:
    """Average of a column per group."""
    return frame.groupBy(*columns).agg(F.avg(value).alias(f"avg_{value}"))


def row_count(frame: DataFrame) -> DataFrame:
    """Number of rows, as a frame of one row."""
    return frame.agg(F.count("*").alias("n"))


def distinct_values(frame: DataFrame, *columns: str) -> DataFrame:
    """Distinct values of the columns."""
    return frame.select(*columns).distinct()


def top_rated(items: DataFrame, k: int = 20) -> DataFrame:
    """The k best rated items; equal ratings go by id."""
    return items.orderBy(F.desc("rating"), "item_id").limit(k)


def bernoulli_sample(frame: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Keep each row with the same chance. Which rows depends on the partitioning."""
    return frame.sample(withReplacement=False, fraction=fraction, seed=seed)


def keyed_sample(frame: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Keep each key with the same chance, whatever the partitioning and the engine.

    A key stays where the first eight hex digits of md5 of ``seed:key`` are below the
    fraction of all such numbers, so any engine with md5 draws the same keys. Rows
    without a key are drawn by ``seed:`` alone: all of them or none.
    """
    limit = min(round(fraction * 2**32), 2**32)
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.md5(said), 1, 8), 16, 10).cast("long")
    return frame.where(drawn < F.lit(limit))


def partition_sizes(frame: DataFrame) -> DataFrame:
    """Rows per partition of a frame."""
    return frame.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count("*").alias("n")
    )
