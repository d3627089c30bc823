"""The jobs a deployment runs: files to items, items to layout, pairs and tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from affinia.operators.layout import partition_by_category
from affinia.operators.pairs import write_similar_pairs
from affinia.operators.profiles import build_profiles
from affinia.sources.columnar import read_parquet
from affinia.sources.delimited import read_catalogue_files
from affinia.sources.sinks import write_parquet
from affinia.sources.versions import publish_files


def prepare_items(
    spark: SparkSession,
    folder: str,
    output: str,
    *,
    kind: str | None = "movie",
    min_rating: Decimal | str | int = 6,
    min_votes: int = 500,
) -> None:
    """Catalogue files to the item table."""
    frames = read_catalogue_files(spark, folder)
    items = build_profiles(frames, kind=kind, min_rating=min_rating, min_votes=min_votes)
    write_parquet(items, output)


def prepare_categories(
    spark: SparkSession, items_path: str, output: str, *, mode: str = "all"
) -> None:
    """The item table to one folder per category."""
    partition_by_category(read_parquet(spark, items_path), output, mode=mode)


def prepare_similarity(
    spark: SparkSession, items_path: str, output: str, *, threshold: float = 0.1
) -> bool:
    """The item table to the table of similar pairs, in both directions; False where that exists."""
    return write_similar_pairs(read_parquet(spark, items_path), output, threshold, both_ways=True)


def publish(
    spark: SparkSession,
    items_path: str,
    edges_path: str,
    *,
    items_table: str = "items",
    edges_table: str = "item_edges",
) -> tuple[DataFrame, DataFrame]:
    """Both tables in the catalog, for SQL and for the lookup functions.

    The files are registered where they are, as the next version of each name; nothing is
    copied, and readers of the old versions go on.
    """
    return (
        publish_files(spark, items_path, items_table),
        publish_files(spark, edges_path, edges_table),
    )
