"""Pair tables stored for lookups by either end.

The table holds every pair in both directions, globally sorted by item, score and other
item. A lookup is then one scan with an equality on ``item_id``: files and row groups
whose range does not hold the id are skipped by their statistics, and the rows of an item
stand together, best first. An item with very many pairs spreads over several files,
because the ranges are cut on all three columns.

That a table holds both directions is said in the metadata of ``item_id``, which parquet
files, tables and views keep; the functions in ``neighbours`` go by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinia.operators.layout import order_edges

#: Key of the id column's metadata in tables with both directions.
BOTH_WAYS = "both_ways"
#: Bytes of a row group: small, so that a lookup reads little around its rows.
ROW_GROUP = 4 << 20


def holds_both_ways(edges: DataFrame) -> bool:
    return bool(edges.schema["item_id"].metadata.get(BOTH_WAYS, False))


def mirrored(edges: DataFrame) -> DataFrame:
    """Each edge in both directions; a table that has them already comes back as it is."""
    if holds_both_ways(edges):
        return edges
    forward = edges.select("item_id", "other_id", "similarity")
    # One pass over the edges: each row becomes two.
    ends = F.array(F.struct("item_id", "other_id"), F.struct(F.col("other_id").alias("item_id"), F.col("item_id").alias("other_id")))
    both = forward.select(F.inline(ends).alias("item_id", "other_id"), "similarity")
    return both.withMetadata("item_id", {BOTH_WAYS: True}).withMetadata(
        "similarity", edges.schema["similarity"].metadata
    )


def forward_only(edges: DataFrame) -> DataFrame:
    """Each pair once, with the smaller id first."""
    if not holds_both_ways(edges):
        return edges
    return edges.where("item_id < other_id").withMetadata("item_id", {})


def write_edge_store(edges: DataFrame, path: str, *, row_group: int = ROW_GROUP, mode: str = "errorifexists") -> None:
    """Write pairs (item_id, other_id, similarity) in both directions, laid out for lookups."""
    order_edges(mirrored(edges)).write.mode(mode).option("parquet.block.size", row_group).parquet(path)


def stored_positions(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a stored table with ``position``, their place (from 1) in the order of the files.

    For checks of a layout. Files go by the number of the task that wrote them; the
    counts that are summed up have one row per file.
    """
    number = F.regexp_extract("file_name", r"part-(\d+)", 1).cast("long")
    read = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("row_index")
    )
    earlier = Window.orderBy(number, "file_name").rowsBetween(Window.unboundedPreceding, -1)
    sizes = read.groupBy("file_name").agg(F.count("*").alias("rows"))
    offsets = sizes.select("file_name", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"))
    return (
        read.join(offsets, "file_name")
        .withColumn("position", F.col("offset") + F.col("row_index") + 1)
        .drop("file_name", "row_index", "offset")
    )
