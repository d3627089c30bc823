"""The work area: what a staged table leaves behind."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from affinia.plans import bindings
from affinia.sources.workspace import FREE_SHUFFLES, staged


def _shuffle_files(spark) -> set[str]:
    # Spark's block managers keep their files below the local folders, in local mode in this process's.
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for folder in folders for _, _, files in os.walk(folder.getPath()) for f in files if f.startswith("shuffle_")}


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    frame = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).agg(F.sum("id").alias("s"))
    first, again = staged(frame, "sums"), staged(frame, "sums")
    assert not _shuffle_files(spark) - before
    assert sorted(first.collect()) == sorted(again.collect()) == sorted(frame.collect()) == sorted(frame.collect())
    assert spark.conf.get(FREE_SHUFFLES) == "false"


def test_item_tables_leave_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    items = bindings.stored_items(spark, "/root/testdata/sf0.001")
    assert items.count() > 0
    # The count itself keeps its one row for each task.
    left = {f for f in _shuffle_files(spark) - before if f.endswith(".data")}
    assert len({f.split("_")[1] for f in left}) <= 1


def test_many_lines_are_shuffled_in_parts(spark, monkeypatch):
    folder, written = "/root/testdata/sf0.001", []
    whole = sorted(map(repr, bindings.stored_items(spark, folder).collect()))
    monkeypatch.setattr(bindings, "LINES_PER_PART", 2500)
    monkeypatch.setattr(bindings, "staged", lambda frame, name: written.append(name) or staged(frame, name))
    parts = sorted(map(repr, bindings.stored_items(spark, folder).collect()))
    assert parts == whole
    # About 6,000 lines: three parts, and no part shuffles the lines of another.
    assert written.count("items") == written.count("first-orders") == 3
