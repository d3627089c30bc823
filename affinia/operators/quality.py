"""Row constraints on items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a published item must satisfy.
TITLE_LENGTH = (3, 128)
DURATION_FROM = 1
DURATION_BELOW = 300
MOST_GENRES = 5
RATING_TOP = 10
RATING_TYPE = "decimal(4,2)"
MOST_PERSONS = 50
REQUIRED = ("item_id", "title", "year", "duration", "genres", "rating", "vote_count", "persons")


def violations() -> Column:
    """Names of the constraints a row breaks, in a fixed order; empty if none."""
    rules: list[tuple[str, Column]] = [
        (f"{name}_missing", F.col(name).isNull()) for name in REQUIRED
    ]
    rules += [
        ("title_length", ~F.char_length("title").between(*TITLE_LENGTH)),
        (
            "duration_range",
            (F.col("duration") < DURATION_FROM) | (F.col("duration") >= DURATION_BELOW),
        ),
        ("too_many_genres", F.size("genres") > MOST_GENRES),
        (
            "rating_range",
            (F.col("rating") > RATING_TOP)
            | (
                F.col("rating").isNotNull()
                & ~F.col("rating").eqNullSafe(F.col("rating").try_cast(RATING_TYPE))
            ),
        ),
        ("negative_votes", F.col("vote_count") < 0),
        ("too_many_persons", F.size("persons") > MOST_PERSONS),
    ]
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))


def with_violations(items: DataFrame) -> DataFrame:
    """Items with the array of constraints each breaks."""
    return items.withColumn("violations", violations())


def split_valid(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid items, and rejected items with their reasons."""
    checked = with_violations(items)
    valid = checked.where(F.size("violations") == 0).drop("violations")
    return valid, checked.where(F.size("violations") > 0)
