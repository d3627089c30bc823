"""Clustered partitioned writes, versioned tables and samples that other engines repeat."""

from __future__ import annotations

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from affinia.operators.edge_store import holds_both_ways, write_edge_store
from affinia.operators.neighbours import least_similarity
from affinia.operators.summary import keyed_sample
from affinia.sources.sinks import create_or_replace_table, create_table, write_partitioned
from affinia.sources.versions import publish_files, retire, version, versions
from affinia.sources.workspace import fresh_path


def local(path: str) -> Path:
    return Path(path.removeprefix("file://").removeprefix("file:"))


def files(path: str) -> dict[str, int]:
    return {d.name: len(list(d.glob("part-*"))) for d in local(path).iterdir() if d.is_dir()}


@pytest.fixture(scope="module")
def skewed(spark):
    """Nine rows in ten are of one kind, spread over many partitions."""
    kind = F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string")))
    return spark.range(20_000).repartition(16).withColumn("kind", kind).withColumn("name", F.sha2(F.col("id").cast("string"), 256))


def test_values_have_one_file_by_default(spark, skewed):
    path = fresh_path(spark, "kinds")
    write_partitioned(skewed, path, "kind", order=["name"])
    assert set(files(path).values()) == {1} and len(files(path)) == 8
    rows = [r.name for r in spark.read.parquet(f"{path}/kind=hot").collect()]
    assert rows == sorted(rows) and len(rows) == 18_000


def test_a_large_value_is_split_by_size(spark, skewed):
    path = fresh_path(spark, "kinds")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "200k")
    try:
        write_partitioned(skewed, path, "kind")
    finally:
        spark.conf.set(key, old)
    # A small value may share a task's rows with the large one, and then its cuts too.
    assert files(path)["kind=hot"] > 2
    assert spark.read.parquet(path).count() == 20_000


@pytest.mark.parametrize("most", [1, 4])
def test_files_of_a_value_are_bounded(spark, skewed, most):
    path = fresh_path(spark, "kinds")
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # which would merge tasks as small as these
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        write_partitioned(skewed, path, "kind", most_files=most)
    finally:
        spark.conf.set(key, old)
    found = files(path)
    assert max(found.values()) <= most and (found["kind=hot"] > 1 or most == 1)
    assert spark.read.parquet(path).count() == 20_000


@pytest.mark.parametrize("write", [create_table, create_or_replace_table])
def test_tables_are_clustered_too(spark, skewed, write):
    path = fresh_path(spark, "table")
    write(skewed, "kinds_" + path.rsplit("-", 1)[1], path=path, partition_by="kind", most_files=2)
    assert max(files(path).values()) <= 2


def data_files(folder: Path) -> set[Path]:
    return set(folder.rglob("*.parquet"))


def test_publishing_writes_no_data(spark):
    first, second = fresh_path(spark, "v"), fresh_path(spark, "v")
    spark.range(5).write.parquet(first)
    spark.range(100, 103).write.parquet(second)
    name = "published_" + first.rsplit("-", 1)[1]
    areas = [local(first).parent, local(spark.conf.get("spark.sql.warehouse.dir"))]
    before = [data_files(a) for a in areas]
    old = publish_files(spark, first, name)
    assert sorted(r.id for r in spark.table(name).collect()) == [0, 1, 2, 3, 4]
    new = publish_files(spark, second, name)
    assert [data_files(a) for a in areas] == before
    # Names show the new rows; who holds the old version still reads it.
    assert sorted(r.id for r in spark.table(name).collect()) == sorted(r.id for r in new.collect()) == [100, 101, 102]
    assert old.count() == 5 and version(spark, name, 1).count() == 5
    assert versions(spark, name) == [1, 2]
    assert retire(spark, name) == [1] and versions(spark, name) == [2]
    assert spark.read.parquet(first).count() == 5 and spark.table(name).count() == 3
    with pytest.raises(ValueError, match="current"):
        retire(spark, name, keep=0)


def test_a_failed_publish_leaves_the_old_version(spark):
    path = fresh_path(spark, "v")
    spark.range(2).write.parquet(path)
    name = "kept_" + path.rsplit("-", 1)[1]
    publish_files(spark, path, name)
    with pytest.raises(Exception, match="(?i)path|schema|exist"):
        publish_files(spark, fresh_path(spark, "nothing"), name)
    assert spark.table(name).count() == 2


def test_published_names_keep_what_a_table_says(spark):
    path = fresh_path(spark, "edges")
    edges = spark.createDataFrame([(1, 2, 0.5)], "item_id long, other_id long, similarity double")
    write_edge_store(edges.withMetadata("similarity", {"least_similarity": 0.3}), path)
    name = "edges_" + path.rsplit("-", 1)[1]
    published = publish_files(spark, path, name)
    assert holds_both_ways(published) and least_similarity(published) == 0.3
    parts = fresh_path(spark, "parts")
    write_partitioned(spark.range(6).withColumn("kind", F.col("id") % 2), parts, "kind")
    assert publish_files(spark, parts, "parts_" + parts.rsplit("-", 1)[1]).count() == 6


def test_keyed_sample_is_by_md5(spark):
    keys = [*range(2_000), None]
    frame = spark.createDataFrame([(k,) for k in keys], "k long")
    limit = round(0.2 * 2**32)

    def drawn(k):
        return int(hashlib.md5(f"7:{'' if k is None else k}".encode()).hexdigest()[:8], 16) < limit

    found = {r.k for r in keyed_sample(frame.repartition(5), "k", 0.2, 7).collect()}
    assert found == {k for k in keys if drawn(k)}
    assert keyed_sample(frame, "k", 1.0, 7).count() == len(keys) and keyed_sample(frame, "k", 0.0, 7).count() == 0
