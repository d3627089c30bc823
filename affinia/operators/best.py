"""The k most similar items of every item, exactly and without a threshold.

A pair matters only where its score reaches the k-th best of a vector. So every vector
has a floor, a score that k others are known to reach:

1. The rare tokens, whose lists make few meetings, are summed first. Scores are sums of
   positive products, so the k-th best partial sum of a vector is a floor.
2. A block of vectors stays in the memory of a task while all vectors go by, as one index
   after the other (see ``pairs``). A vector sums its usual tokens; its k-th best sum so
   far lifts its floor. It sums frequent ones while its remaining length may reach the
   floor; the rest is added where a pair may still reach it. Each vector holds its k best
   in the task, and no other pair is written.
3. The k best are ranked.

A vector that fewer than k others share a token with has no floor and meets all that share
one; pairs that share nothing score 0 and are no neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.operators.features import Vectors
from affinia.operators.neighbours import BEST, items_of_best
from affinia.operators.pairs import (
    DIGITS,
    FREQUENT_ROWS,
    _Effort,
    _slack,
    _usual_parts,
    best_links,
    score_in_blocks,
)
from affinia.sources.workspace import staged

#: Meetings of a vector in rare tokens, on average, from which the first floors come.
SEED_MEETINGS = 256


def _effort(vocabulary: DataFrame, most_rows: int) -> _Effort:
    count = F.col("rows").cast("double")
    usual = F.col("rows") <= F.lit(most_rows)
    row = vocabulary.agg(
        F.coalesce(F.sum(F.when(usual, count * (count - 1) / 2)), F.lit(0.0)).alias("meetings"),
        F.coalesce(F.max(~usual), F.lit(False)).alias("frequent"),
    ).first()
    return _Effort(most_rows, row["meetings"], row["frequent"])


def _seed_rows(vocabulary: DataFrame, vectors: int, frequent_rows: int) -> int:
    """The most rows of a token of the first pass, a power of two (at most 64 numbers are counted)."""
    count = F.col("rows").cast("double")
    levels = (
        vocabulary.where(F.col("rows") <= F.lit(frequent_rows))
        .groupBy(F.ceil(F.log2(count)).cast("int").alias("level"))
        .agg(F.sum(count * (count - 1) / 2).alias("meetings"))
        .orderBy("level")
        .collect()
    )
    total, limit = 0.0, 2
    for found in levels:
        total += found["meetings"]
        if total > SEED_MEETINGS * max(1, vectors):
            break
        limit = 2 ** found["level"]
    return min(limit, frequent_rows)


def floors_of(parts: DataFrame, k: int, digits: int) -> DataFrame:
    """(vector_id, floor) of the vectors with k pairs or more; rounding may not lift a floor."""
    links = parts.select("vector_id", "other_vector", F.col("part").alias("similarity"))
    kth = best_links(links, k).where(F.col("position") == k)
    return kth.select("vector_id", (F.col("similarity") - F.lit(_slack(digits))).alias("floor"))


def best_vectors(
    vectors: Vectors,
    k: int = BEST,
    *,
    digits: int = DIGITS,
    frequent_rows: int = FREQUENT_ROWS,
    seed_rows: int | None = None,
) -> DataFrame:
    """(vector_id, position, other_vector, similarity): the k best others of every vector.

    Only scores above 0 after rounding count; equal scores go by the id of the other.
    ``seed_rows`` fixes which tokens the first floors come from.
    """
    size = vectors.frame.count()
    seeds = _effort(vectors.vocabulary, seed_rows or _seed_rows(vectors.vocabulary, size, frequent_rows))
    floors = staged(floors_of(_usual_parts(vectors, seeds, None, 0.0), k, digits), "floors")
    # The least score that is not rounded to 0.
    above = _slack(digits) / 2
    parts = score_in_blocks(vectors, above, frequent_rows, best=k, floors=floors, digits=digits)
    links = parts.select("vector_id", "other_vector", F.round("part", digits).alias("similarity")).where("similarity > 0")
    best = Window.partitionBy("vector_id").orderBy(F.desc("similarity"), "other_vector")
    return (
        links.withColumn("position", F.row_number().over(best))
        .where(F.col("position") <= F.lit(k))
        .select("vector_id", "position", "other_vector", "similarity")
    )


def best_neighbours(
    vectors: Vectors, k: int = BEST, *, digits: int = DIGITS, frequent_rows: int = FREQUENT_ROWS
) -> DataFrame:
    """(item_id, position, other_id, similarity): the k best of every item, whatever their scores.

    Items that share no token with an item are not among its best. Copies of an item have
    a score of 1; a group of copies costs one vector, and its pairs are not written out.
    """
    best = best_vectors(vectors, k, digits=digits, frequent_rows=frequent_rows)
    if vectors.members is None:
        return best.select(
            F.col("vector_id").alias("item_id"), "position", F.col("other_vector").alias("other_id"), "similarity"
        )
    own = vectors.frame.where("copies > 1").select(
        "vector_id", F.col("vector_id").alias("other_vector"), F.lit(1.0).alias("similarity")
    )
    ranked = best.drop("position").unionByName(own)
    order = Window.partitionBy("vector_id").orderBy(F.desc("similarity"), "other_vector")
    kept = ranked.withColumn("position", F.row_number().over(order)).where(F.col("position") <= F.lit(k + 1))
    return items_of_best(kept.drop("position"), vectors.members, k)
