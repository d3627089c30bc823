"""Join to a counted dictionary without piling a hot key on one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with at least this share of all rows is hot. There can be at most
# 1 / HOT_SHARE such keys, whatever the size of the data, which is the proven
# bound that lets their dictionary rows be broadcast.
HOT_SHARE = 1.0 / 1000


def count_total(dictionary: DataFrame, count_column: str) -> int:
    """Rows that a counted dictionary stands for."""
    return dictionary.agg(F.coalesce(F.sum(count_column), F.lit(0)).alias("total")).first()["total"]


def join_counted(
    rows: DataFrame,
    dictionary: DataFrame,
    key: str,
    count_column: str,
    total: int,
    *,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Inner join of ``rows`` with a dictionary of unique keys.

    ``count_column`` says how many of the ``total`` rows carry each key. Rows of
    hot keys meet their dictionary entry by broadcast and stay where they are;
    all other rows go through an ordinary join, where no key is large.
    """
    floor = total * hot_share
    hot = dictionary.where(F.col(count_column) >= F.lit(floor))
    cold = dictionary.where(F.col(count_column) < F.lit(floor))
    hot_keys = F.broadcast(hot.select(key))
    return rows.join(F.broadcast(hot), key).unionByName(
        rows.join(hot_keys, key, "left_anti").join(cold, key)
    )
