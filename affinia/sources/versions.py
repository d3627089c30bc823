"""Versioned catalog tables that are published without being written again.

A published name is a view of one external table, ``name__v<number>``, over files that a
job has written. Publishing registers the files under the next number and points the view
at it: one change of the catalog entry, no data file. Readers that hold the old version
go on reading its files; ``retire`` forgets old versions and leaves their files alone.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def _quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def versions(spark: SparkSession, name: str) -> list[int]:
    """Numbers of the registered versions of a published name, ascending."""
    *space, plain = name.split(".")
    listed = spark.catalog.listTables(".".join(space) or None, f"{plain}__v*")
    found = (re.fullmatch(rf"{re.escape(plain)}__v(\d+)", t.name, re.IGNORECASE) for t in listed)
    return sorted(int(m.group(1)) for m in found if m)


def version(spark: SparkSession, name: str, number: int) -> DataFrame:
    """One version of a published table."""
    return spark.table(_quoted(f"{name}__v{number}"))


def publish_files(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Make the parquet files of ``path`` the current version of ``name``.

    Fails, and leaves the old version current, where the path cannot be read as a table or
    the name belongs to a table that is no view of versions.
    """
    number = max(versions(spark, name), default=0) + 1
    held = f"{name}__v{number}"
    made = spark.catalog.createTable(held, path=path, source="parquet")
    if any(column.isPartition for column in spark.catalog.listColumns(held)):
        spark.catalog.recoverPartitions(held)
    # Column metadata (thresholds, directions) is part of the view's schema.
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS SELECT * FROM {_quoted(held)}")
    del made
    return spark.table(_quoted(name))


def retire(spark: SparkSession, name: str, keep: int = 1) -> list[int]:
    """Forget all but the last ``keep`` versions; their files stay. Returns their numbers."""
    if keep < 1:
        raise ValueError("the current version cannot be retired")
    old = versions(spark, name)[:-keep]
    for number in old:
        spark.sql(f"DROP TABLE {_quoted(f'{name}__v{number}')}")
    return old
