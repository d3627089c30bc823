"""Plans and skew: what must hold for the jobs to grow with the data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from affinia.operators import skew
from affinia.operators.neighbours import top_k_of_edges
from affinia.operators.skew import count_total, join_counted
from affinia.plans import bindings
from affinia.plans.registry import QUERIES
from affinia.sources.sinks import create_table, path_exists, write_new
from affinia.sources.workspace import fresh_path, staged, work_root

SMALL = "/root/testdata/sf0.001"


def plan(frame) -> str:
    return frame._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_in_plans(spark, name):
    text = plan(QUERIES[name][0](spark, SMALL))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEval",
                 "MapInPandas", "FlatMapGroupsInPandas"):
        assert word not in text


@pytest.mark.parametrize("frequent_rows", [5, 4096])
def test_pair_join_plan(spark, frequent_rows):
    from affinia.operators.features import build_vectors
    from affinia.operators.pairs import similar_vectors

    vectors = build_vectors(bindings.stored_items(spark, SMALL))
    text = plan(similar_vectors(vectors, 0.3, frequent_rows=frequent_rows))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert word not in text


def test_filters_and_columns_reach_the_scan(spark):
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    path = fresh_path(spark, "edges")
    lines.select(
        F.col("l_partkey").alias("item_id"), F.col("l_orderkey").alias("other_id"),
        F.col("l_discount").alias("similarity"), "l_tax",
    ).write.parquet(path)
    from affinia.operators.neighbours import edges_of

    text = plan(edges_of(spark.read.parquet(path), 5, direction="stored"))
    assert "EqualTo(item_id,5)" in text
    assert "l_tax" not in text[text.index("ReadSchema"):]


def test_ranking_limits_rows_before_the_shuffle(spark):
    edges = spark.range(10).selectExpr("id AS item_id", "id + 1 AS other_id", "0.5D AS similarity")
    assert "WindowGroupLimit" in plan(top_k_of_edges(edges, 3))


def test_credits_are_cut_before_they_are_grouped(spark):
    assert "LeftSemi" in plan(bindings.items(spark, SMALL, min_rating="5"))


@pytest.mark.parametrize("share", [1.0 / 1000, 0.2, 2.0])
def test_join_counted_on_a_hot_key(spark, share):
    rows = staged(
        spark.range(3_000).selectExpr("id", "IF(id % 3 = 0, -1, id % 50) AS key"), "rows"
    )
    counts = rows.groupBy("key").agg(F.count("*").alias("n")).withColumn("word", F.concat(F.lit("w"), "key"))
    dictionary = staged(counts, "dictionary")
    total = count_total(dictionary, "n")
    assert total == 3_000
    found = join_counted(rows, dictionary, "key", "n", total, hot_share=share)
    assert found.count() == 3_000
    assert found.where("word <> concat('w', key)").isEmpty()


def test_hot_dictionary_is_bounded():
    assert 1 / skew.HOT_SHARE <= 1000


def test_work_area(spark):
    root = work_root(spark)
    assert work_root(spark) == root
    assert fresh_path(spark, "a") != fresh_path(spark, "a")
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert root.startswith(named.rstrip("/") if named else root)


def test_existing_targets_are_refused(spark):
    path = fresh_path(spark, "once")
    assert not path_exists(spark, path)
    assert write_new(spark.range(3), path)
    assert not write_new(spark.range(5), path)
    assert spark.read.parquet(path).count() == 3
    name = "once_" + path.rsplit("-", 1)[1]
    create_table(spark.range(2), name)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        create_table(spark.range(2), name)
