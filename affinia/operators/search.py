"""Lookup by id and search by any mix of criteria."""

from __future__ import annotations

from dataclasses import dataclass, fields
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.functions.predicates import all_of, any_element_matches, has_all, matches, within

# The bounds a search request must keep.
EARLIEST_DATE_FROM = date(1880, 1, 1)
LATEST_DATE_TO = date(2030, 1, 1)
MIN_DURATION_RANGE = (1, 239)
MAX_DURATION_RANGE = (10, 299)
RATING_TOP = Decimal("10")
RATING_DECIMALS = 2
RATING_DIGITS = 4
TITLE_LENGTH = 128
GENRE_LENGTH = 24
PERSON_LENGTH = 32
LIST_LENGTH = 5
RESULT_LIMIT = 100


@dataclass(frozen=True)
class SearchSpec:
    """Search criteria; each is optional and all given ones must hold."""

    title: str | None = None
    earliest_date: date | None = None
    latest_date: date | None = None
    min_duration: int | None = None
    max_duration: int | None = None
    genre: str | None = None
    genres: tuple[str, ...] | None = None
    min_rating: Decimal | None = None
    max_rating: Decimal | None = None
    vote_count: int | None = None
    person: str | None = None
    persons: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        for name in ("min_rating", "max_rating"):
            value = getattr(self, name)
            if value is not None:
                object.__setattr__(self, name, Decimal(str(value)))
        for name in ("earliest_date", "latest_date"):
            value = getattr(self, name)
            if isinstance(value, str):
                object.__setattr__(self, name, date.fromisoformat(value))
        for name in ("genres", "persons"):
            value = getattr(self, name)
            if value is not None:
                object.__setattr__(self, name, tuple(value))
        problems = self.problems()
        if problems:
            raise ValueError("; ".join(problems))

    def problems(self) -> list[str]:
        """What is out of bounds, as one message per criterion."""
        checks = [
            ("title", self.title is None or len(self.title) <= TITLE_LENGTH),
            ("genre", self.genre is None or len(self.genre) <= GENRE_LENGTH),
            ("person", self.person is None or len(self.person) <= PERSON_LENGTH),
            ("genres", self.genres is None or len(self.genres) <= LIST_LENGTH),
            ("persons", self.persons is None or len(self.persons) <= LIST_LENGTH),
            (
                "earliest_date",
                self.earliest_date is None or self.earliest_date >= EARLIEST_DATE_FROM,
            ),
            ("latest_date", self.latest_date is None or self.latest_date <= LATEST_DATE_TO),
            ("min_duration", _in_range(self.min_duration, *MIN_DURATION_RANGE)),
            ("max_duration", _in_range(self.max_duration, *MAX_DURATION_RANGE)),
            ("vote_count", self.vote_count is None or self.vote_count >= 0),
            (
                "min_rating",
                _in_range(self.min_rating, 0, RATING_TOP) and _short_decimal(self.min_rating),
            ),
            (
                "max_rating",
                (self.max_rating is None or self.max_rating <= RATING_TOP)
                and _short_decimal(self.max_rating),
            ),
        ]
        return [
            f"{name} is out of bounds: {getattr(self, name)!r}" for name, fine in checks if not fine
        ]

    def is_empty(self) -> bool:
        return all(getattr(self, field.name) is None for field in fields(self))

    def predicates(self) -> list[Column]:
        """One predicate per given criterion."""
        found = [
            within("year", self.earliest_date, self.latest_date),
            within("duration", self.min_duration, self.max_duration),
            within("rating", self.min_rating, self.max_rating),
            within("vote_count", low=self.vote_count),
            matches("title", self.title) if self.title else None,
            has_all("genres", self.genres) if self.genres else None,
            has_all("persons", self.persons) if self.persons else None,
            any_element_matches("genres", self.genre) if self.genre else None,
            any_element_matches("persons", self.person) if self.person else None,
        ]
        return [predicate for predicate in found if predicate is not None]


def _in_range(value, low, high) -> bool:
    return value is None or low <= value <= high


def _short_decimal(value: Decimal | None) -> bool:
    if value is None:
        return True
    digits, exponent = value.as_tuple().digits, value.as_tuple().exponent
    decimals = max(0, -exponent)
    return decimals <= RATING_DECIMALS and max(len(digits) + max(0, exponent), decimals) <= (
        RATING_DIGITS
    )


def search_items(
    items: DataFrame, spec: SearchSpec, *, limit: int | None = RESULT_LIMIT
) -> DataFrame:
    """Items meeting all criteria, by title; the first ``limit``, or all for None.

    No criteria means the first items of the whole table. Equal titles go by id.
    A result is as good a match as it gets, so its ``similarity`` is 1.
    """
    condition = all_of(spec.predicates())
    found = items if condition is None else items.where(condition)
    ordered = found.withColumn("similarity", F.lit(1.0)).orderBy("title", "item_id")
    return ordered if limit is None else ordered.limit(limit)


def lookup(items: DataFrame, item_id: int) -> DataFrame:
    """The item with this id, or no row."""
    return (
        items.where(F.col("item_id") == F.lit(item_id))
        .limit(1)
        .withColumn("similarity", F.lit(1.0))
    )


def lookup_many(items: DataFrame, wanted: DataFrame) -> DataFrame:
    """The items whose ``item_id`` is in ``wanted``."""
    return items.join(wanted.select("item_id").distinct(), "item_id", "left_semi").withColumn(
        "similarity", F.lit(1.0)
    )


def lookup_missing(items: DataFrame, wanted: DataFrame) -> DataFrame:
    """The ids in ``wanted`` that no item has."""
    return wanted.select("item_id").distinct().join(items.select("item_id"), "item_id", "left_anti")
