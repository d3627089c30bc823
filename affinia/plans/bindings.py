"""The test tables seen as a catalogue of items.

``part`` plays titles, ``lineitem`` ratings and credits, ``supplier`` names, and
``orders`` gives the year. Ratings are integer-exact, because the text of a
rating is a feature token and must not depend on how an average is rounded.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.operators.profiles import build_profiles
from affinia.sources.delimited import CatalogueFrames
from affinia.sources.workspace import shuffles_freed, staged


# Lines that are shuffled at a time while the item table is built: about 16 MB for a million.
LINES_PER_PART = 8_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def part_of(frame: DataFrame, part: tuple[int, int] | None) -> DataFrame:
    """The rows of one part of the titles, (number, parts); all rows without one."""
    if part is None:
        return frame
    number, parts = part
    return frame.where(F.pmod(F.xxhash64(F.col("title_id").cast("long")), F.lit(parts)) == number)


def titles(spark: SparkSession, folder: str, part: tuple[int, int] | None = None) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, folder, "lineitem").select("l_orderkey", F.col("l_partkey").alias("title_id"))
    first_order = (
        part_of(lines, part)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("title_id")
        .agg(F.min("o_orderdate").cast("date").alias("year"))
    )
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("title_id"),
        F.col("p_type").alias("kind"),
        F.col("p_name").alias("title"),
        F.col("p_size").alias("duration"),
        F.split("p_name", r"\s+").alias("genres"),
    )
    # Written first, so that its shuffles of all lines are gone before others begin.
    return part_of(parts, part).join(staged(first_order, "first-orders"), "title_id", "left")


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    hundredths = F.floor(
        F.sum(F.col("l_quantity").cast("bigint")) * F.lit(20.0) / F.count("*")
    ).cast("bigint")
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_partkey").alias("title_id"))
        .agg(
            (hundredths / F.lit(100.0)).cast("decimal(4,2)").alias("rating"),
            F.count("*").cast("int").alias("vote_count"),
        )
    )


def credits(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("title_id"),
        F.col("l_linenumber").alias("ordering"),
        F.col("l_suppkey").alias("person_id"),
        F.col("l_returnflag").alias("job"),
    )


def names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("person_id"), F.col("s_name").alias("name")
    )


def frames(spark: SparkSession, folder: str, part: tuple[int, int] | None = None) -> CatalogueFrames:
    return CatalogueFrames(
        titles=titles(spark, folder, part),
        ratings=part_of(ratings(spark, folder), part),
        credits=part_of(credits(spark, folder), part),
        names=names(spark, folder),
    )


def items(
    spark: SparkSession,
    folder: str,
    *,
    kind: str | None = None,
    min_rating: str = "0",
    min_votes: int = 0,
    part: tuple[int, int] | None = None,
) -> DataFrame:
    """Item profiles of the test tables; all items unless told otherwise."""
    return build_profiles(
        frames(spark, folder, part),
        kind=kind,
        min_rating=min_rating,
        min_votes=min_votes,
        id_prefix=None,
    )


def stored_items(spark: SparkSession, folder: str, **filters) -> DataFrame:
    """The item table written out, as the similarity jobs expect it.

    Many lines are gone over in parts of the titles, one after another, so that only the
    lines of one part lie on disk as shuffle files.
    """
    with shuffles_freed(spark):
        lines = table(spark, folder, "lineitem").count()
    parts = max(1, ceil(lines / LINES_PER_PART))
    if parts == 1:
        return staged(items(spark, folder, **filters), "items")
    written = [staged(items(spark, folder, part=(n, parts), **filters), "items") for n in range(parts)]
    return reduce(DataFrame.unionByName, written)


def flat(frame: DataFrame) -> DataFrame:
    """Arrays and dates as text and decimals as doubles, for comparison."""
    columns = []
    for name, kind in frame.dtypes:
        if kind.startswith("array"):
            columns.append(F.array_join(name, "|").alias(name))
        elif kind == "date":
            columns.append(F.col(name).cast("string").alias(name))
        elif kind.startswith("decimal"):
            columns.append(F.col(name).cast("double").alias(name))
        else:
            columns.append(F.col(name))
    return frame.select(*columns)


# The same binding in SQL. ``items`` is every item; ``flat_items`` its flat form.
ITEMS_SQL = r"""
rated AS (
    SELECT l_partkey AS item_id,
           CAST(CAST(floor(CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) * 20.0 / count(*))
                AS BIGINT) / 100.0 AS DECIMAL(4, 2)) AS rating,
           CAST(count(*) AS INTEGER) AS vote_count
    FROM lineitem GROUP BY l_partkey
),
dated AS (
    SELECT l_partkey AS item_id, CAST(min(o_orderdate) AS DATE) AS year
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey
),
credited AS (
    SELECT l_partkey AS item_id, list_sort(list(DISTINCT s_name)) AS persons
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_partkey
),
items AS (
    SELECT p_partkey AS item_id, p_name AS title, year, p_size AS duration,
           string_split_regex(p_name, '\s+') AS genres, rating, vote_count, persons,
           p_type AS kind
    FROM part
    JOIN rated ON rated.item_id = p_partkey
    JOIN credited ON credited.item_id = p_partkey
    LEFT JOIN dated ON dated.item_id = p_partkey
    WHERE p_size IS NOT NULL AND p_name IS NOT NULL
),
flat_items AS (
    SELECT item_id, title, CAST(year AS VARCHAR) AS year, duration,
           array_to_string(genres, '|') AS genres,
           CAST(rating AS DOUBLE) AS rating, vote_count,
           array_to_string(persons, '|') AS persons
    FROM items
)
"""
