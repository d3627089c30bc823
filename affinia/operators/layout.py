"""Physical layout: items by category, edges by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.functions.tokens import first_element
from affinia.sources.sinks import write_partitioned


def with_category(
    items: DataFrame, *, mode: str = "first", source: str = "genres", column: str = "genre"
) -> DataFrame:
    """Add a scalar category from an array of categories.

    ``first`` takes the first element. ``all`` repeats the item under each of its
    categories. Items without any get a null category in both modes.
    """
    if mode == "first":
        return items.withColumn(column, first_element(source))
    if mode == "all":
        distinct = F.array_distinct(F.col(source))
        return items.select("*", F.explode_outer(distinct).alias(column))
    raise ValueError(f"mode must be 'first' or 'all', not {mode!r}")


def partition_by_category(
    items: DataFrame,
    path: str,
    *,
    mode: str = "first",
    column: str = "genre",
    order: str = "persons",
    most_files: int | None = None,
) -> None:
    """Write items in one folder per category, in one job for all categories.

    A category's rows are together and sorted; see ``sinks.clustered``.
    """
    categorised = with_category(items, mode=mode, column=column)
    write_partitioned(categorised, path, column, order=[order], most_files=most_files)


def order_edges(edges: DataFrame) -> DataFrame:
    """Edges by item, best first. Range partitions on all three columns, so an
    item with very many edges spreads over several tasks and files."""
    return edges.orderBy("item_id", F.desc("similarity"), "other_id")


def range_partitioned(frame: DataFrame, partitions: int, *columns: str) -> DataFrame:
    """Repartition by ranges of the columns."""
    return frame.repartitionByRange(partitions, *columns)
