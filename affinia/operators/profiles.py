"""Item profiles from titles, ratings, credits and names."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.functions.predicates import all_of, within
from affinia.functions.tokens import comma_list, numeric_id
from affinia.sources.delimited import CatalogueFrames

ITEM_COLUMNS = (
    "item_id",
    "title",
    "year",
    "duration",
    "genres",
    "rating",
    "vote_count",
    "persons",
)


def keep_item(
    kind: str | None = "movie",
    min_rating: Decimal | str | int = 6,
    min_votes: int = 500,
) -> Column:
    """The item filter: kind, category present, rating, votes, duration known.

    Bounds are inclusive. ``kind=None`` keeps every kind.
    """
    predicates = [
        F.col("genres").isNotNull(),
        within("rating", low=Decimal(str(min_rating))),
        within("vote_count", low=min_votes),
        F.col("duration").isNotNull(),
    ]
    if kind is not None:
        predicates.insert(0, F.col("kind") == F.lit(kind))
    return all_of(predicates)


def persons_by_title(credits: DataFrame, names: DataFrame) -> DataFrame:
    """Distinct names per title, sorted so that the array is the same on every run.

    Repeated credits go before the names are joined: one row per title and
    person is left however often a person is credited.
    """
    once = credits.select("title_id", "person_id").distinct()
    return (
        once.join(names.select("person_id", "name"), "person_id")
        .groupBy("title_id")
        .agg(F.sort_array(F.collect_set("name")).alias("persons"))
    )


def build_profiles(
    frames: CatalogueFrames,
    *,
    kind: str | None = "movie",
    min_rating: Decimal | str | int = 6,
    min_votes: int = 500,
    id_prefix: str | None = "tt",
) -> DataFrame:
    """One row per kept item: see ``ITEM_COLUMNS``.

    Titles without a rating, and titles without any named credit, are absent.
    Credits, by far the largest input, are cut down to the kept titles by a semi
    join before they are joined with names and grouped. ``genres`` arrives as a
    comma list, or as an array already.
    """
    kept = frames.titles.join(frames.ratings, "title_id").where(
        keep_item(kind, min_rating, min_votes)
    )
    wanted = frames.credits.join(kept.select("title_id"), "title_id", "left_semi")
    items = kept.join(persons_by_title(wanted, frames.names), "title_id")
    if dict(items.dtypes)["genres"] == "string":
        items = items.withColumn("genres", comma_list("genres"))
    if id_prefix is not None:
        items = items.withColumn("title_id", numeric_id("title_id", id_prefix))
    return items.withColumnsRenamed({"title_id": "item_id"}).select(*ITEM_COLUMNS)
