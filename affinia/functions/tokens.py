"""Text, list and identifier expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def comma_list(column: str | Column) -> Column:
    """Split a comma list; blanks around the commas go."""
    return F.split(column, r"\s*,\s*")


def numeric_id(column: str | Column, prefix: str) -> Column:
    """Integer part of a prefixed id such as ``tt0099785``; null where there is none.

    Every occurrence of the prefix is removed.
    """
    text = F.col(column) if isinstance(column, str) else column
    return F.replace(text, F.lit(prefix), F.lit("")).try_cast("int")


def first_element(column: str | Column) -> Column:
    """First element, or null for an empty or null array."""
    return F.get(column, F.lit(0))


def joined(column: str | Column, separator: str) -> Column:
    """Array elements as one string; null elements are skipped."""
    return F.array_join(column, separator)


def feature_tokens(frame: DataFrame, columns: Sequence[str]) -> Column:
    """The feature tokens of a row, from text, array and number columns.

    Columns are joined by comma and blank, then split on commas. So the first
    token has no leading blank and all later ones have one; nulls are skipped;
    a text with a comma gives several tokens; a number is its text form.
    """
    parts = [
        F.col(name)
        if isinstance(frame.schema[name].dataType, (T.ArrayType, T.StringType))
        else F.col(name).cast("string")
        for name in columns
    ]
    return F.split(F.concat_ws(", ", *parts), ",")
