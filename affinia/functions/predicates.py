"""Predicates over item columns.

Values enter as literals, never as SQL text, so a quote in a value is only a
quote. Range bounds are inclusive. ``None`` means "no bound"; zero is a bound.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def all_of(predicates: Iterable[Column]) -> Column | None:
    """AND of the predicates, or None where there are none."""
    given = list(predicates)
    return reduce(lambda left, right: left & right, given) if given else None


def matches(column: str | Column, pattern: str, *, ignore_case: bool = True) -> Column:
    """The regular expression occurs somewhere in the text."""
    return _column(column).rlike(f"(?i){pattern}" if ignore_case else pattern)


def any_element_matches(
    column: str | Column, pattern: str, *, ignore_case: bool = True
) -> Column:
    """The regular expression occurs in the elements joined by commas.

    A pattern may therefore span two neighbouring elements.
    """
    return matches(F.array_join(_column(column), ","), pattern, ignore_case=ignore_case)


def match_count(column: str | Column, pattern: str) -> Column:
    """How often the regular expression occurs in the elements joined by commas."""
    return F.regexp_count(F.array_join(_column(column), ","), F.lit(pattern))


def has_all(column: str | Column, values: Iterable[str]) -> Column:
    """The array holds every value, exactly as written."""
    wanted = list(dict.fromkeys(values))
    checks = (F.array_contains(_column(column), F.lit(value)) for value in wanted)
    found = all_of(checks)
    return F.lit(True) if found is None else found


def has_any(column: str | Column, values: Iterable[str]) -> Column:
    """The array holds at least one of the values, exactly as written."""
    wanted = F.array(*[F.lit(value) for value in values]).cast("array<string>")
    return F.arrays_overlap(_column(column), wanted)


def has_value(column: str | Column, value: str) -> Column:
    """The array holds the value; negate with ``~``."""
    return F.array_contains(_column(column), F.lit(value))


def element_equals(column: str | Column, value: str) -> Column:
    """Some element satisfies a condition; here equality."""
    return F.exists(_column(column), lambda element: element == F.lit(value))


def within(column: str | Column, low: Any = None, high: Any = None) -> Column | None:
    """Inclusive range with either end open; None where both are."""
    target = _column(column)
    bounds = []
    if low is not None:
        bounds.append(target >= F.lit(low))
    if high is not None:
        bounds.append(target <= F.lit(high))
    return all_of(bounds)


def one_of(column: str | Column, values: Iterable[Any]) -> Column:
    """The value is one of a set."""
    return _column(column).isin(list(values))


def like(column: str | Column, pattern: str) -> Column:
    """SQL LIKE."""
    return _column(column).like(pattern)


def early_credit(job: str, last_ordering: int) -> Column:
    """A credit of one job listed no later than ``last_ordering``."""
    return (F.col("job") == F.lit(job)) & (F.col("ordering") <= F.lit(last_ordering))
