"""Vectors stored by token, so that one item is scored from the rows of its tokens alone.

A folder holds three tables, each globally sorted on the column it is looked up by:

* ``vectors``   vector_id, copies, token_ids, weights, by vector_id
* ``postings``  token_id, vector_id, weight, by token_id and vector_id
* ``members``   item_id, vector_id, copies, by item_id; missing where no two items are copies

Scoring an item reads its row group of members and of vectors, and then the row groups of
postings whose token range holds one of its tokens. The tokens of one item come to the
driver and go into the plan as literals, so the filter reaches the parquet scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.operators.features import Vectors
from affinia.operators.pairs import DIGITS, members_of_scores
from affinia.sources.sinks import path_exists

#: Bytes of a row group of postings: small, because a lookup reads whole ones.
ROW_GROUP = 1 << 20
#: Values of an ``IN`` that the parquet reader still checks one by one.
VALUES_PER_TEST = 10


@dataclass(frozen=True)
class Postings:
    """The stored tables; ``members`` is None where no two items are copies."""

    vectors: DataFrame
    postings: DataFrame
    members: DataFrame | None


def write_postings(vectors: Vectors, path: str, *, row_group: int = ROW_GROUP) -> Postings:
    """Store vectors by token below ``path``, which must not hold them yet."""
    spark = vectors.frame.sparkSession

    def write(frame: DataFrame, name: str, *order: str) -> None:
        frame.orderBy(*order).write.option("parquet.block.size", row_group).parquet(f"{path}/{name}")

    plain = vectors.frame.select(
        "vector_id", "copies", F.col("entries.token_id").alias("token_ids"), F.col("entries.weight").alias("weights")
    )
    write(plain, "vectors", "vector_id")
    write(vectors.frame.select(F.inline("entries"), "vector_id").select("token_id", "vector_id", "weight"),
          "postings", "token_id", "vector_id")
    if vectors.members is not None:
        write(vectors.members.select("item_id", "vector_id", "copies"), "members", "item_id")
    return read_postings(spark, path)


def read_postings(spark: SparkSession, path: str) -> Postings:
    members = f"{path}/members"
    return Postings(
        spark.read.parquet(f"{path}/vectors"),
        spark.read.parquet(f"{path}/postings"),
        spark.read.parquet(members) if path_exists(spark, members) else None,
    )


def one_of(column: str, values: list[int]) -> Column:
    """Whether a column has one of the values, in tests short enough to be pushed down value by value."""
    ordered = sorted(values)
    parts = [ordered[i : i + VALUES_PER_TEST] for i in range(0, len(ordered), VALUES_PER_TEST)]
    test = F.lit(False)
    for part in parts:
        test = test | F.col(column).isin(part)
    return test


def vector_of(store: Postings, item_id: int) -> dict[int, float] | None:
    """Weights by token of one item; None where the item is unknown or has no weights."""
    vector_id = item_id
    if store.members is not None:
        member = store.members.where(F.col("item_id") == F.lit(item_id)).select("vector_id").first()
        if member is None:
            return None
        vector_id = member["vector_id"]
    row = store.vectors.where(F.col("vector_id") == F.lit(vector_id)).select("token_ids", "weights").first()
    return None if row is None else dict(zip(row["token_ids"], row["weights"], strict=True))


def score_stored_item(store: Postings, item_id: int, *, digits: int = DIGITS) -> DataFrame:
    """(other_id, similarity) of one item with every item that shares a token with it.

    An unknown item, or one without weights, has no rows.
    """
    asked = vector_of(store, item_id) or {}
    held = store.postings.where(one_of("token_id", list(asked)))
    weight_of = F.create_map(*(F.lit(x) for pair in sorted(asked.items()) for x in pair)) if asked else None
    part = F.lit(0.0) if weight_of is None else F.col("weight") * weight_of[F.col("token_id")]
    scored = held.groupBy("vector_id").agg(F.round(F.sum(part), digits).alias("similarity"))
    return members_of_scores(scored, store.members, item_id)
