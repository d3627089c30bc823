"""Similar items: for one item, and the best k for every item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.functions.vectors import dense_cosine, dense_literal
from affinia.operators.edge_store import forward_only, holds_both_ways
from affinia.operators.features import Vectors
from affinia.operators.pairs import (
    COPIES_PER_SLOT,
    DIGITS,
    LEAST,
    SimilarityIndex,
    best_links,
    score_item,
)
from affinia.operators.postings import Postings, score_stored_item

BEST = 10
THRESHOLD = 0.1


class UnknownItem(LookupError):
    """No item has the id."""


class NothingSimilar(LookupError):
    """The item is known, but nothing reaches the threshold."""


def least_similarity(edges: DataFrame) -> float | None:
    """The threshold a pair table was found with; None for a table that does not say."""
    return edges.schema["similarity"].metadata.get(LEAST)


def _check_threshold(asked: float, least: float | None) -> None:
    if least is not None and asked < least:
        raise ValueError(f"pairs are stored from {least} up, so {asked} would miss some")


def edges_of(edges: DataFrame, item_id: int, *, direction: str = "both") -> DataFrame:
    """(other_id, similarity) of one item.

    ``stored`` finds larger ids only, as a table with each pair once has them; ``both``
    finds all. The id filters reach the parquet scan. A table with both directions
    (``edge_store``) is read once, by ``item_id``; any other is read by either end.
    """
    wanted = F.lit(item_id)
    forward = edges.where(F.col("item_id") == wanted).select("other_id", "similarity")
    if holds_both_ways(edges):
        if direction in ("both", "stored"):
            return forward if direction == "both" else forward.where(F.col("other_id") > wanted)
    if direction == "stored":
        return forward
    if direction == "both":
        return forward.unionByName(
            edges.where(F.col("other_id") == wanted).select(
                F.col("item_id").alias("other_id"), "similarity"
            )
        )
    raise ValueError(f"direction must be 'both' or 'stored', not {direction!r}")


def similar_items(
    items: DataFrame,
    edges: DataFrame | None,
    item_id: int,
    *,
    threshold: float = THRESHOLD,
    k: int | None = BEST,
    direction: str = "both",
    how: str = "inner",
    vectors: Vectors | Postings | None = None,
    digits: int = DIGITS,
) -> DataFrame:
    """The items most similar to one item, with their score, best first.

    No row means: the id is unknown, or nothing reaches the threshold;
    ``found_similar`` tells the two apart. ``k=None`` gives all. ``how="left"`` keeps neighbours that are missing from ``items``.
    A threshold of 0, or below the one the edges were found with, needs
    ``vectors``: the item is then scored against all others, from stored postings by
    reading those of its tokens only, and at 0 the items
    that share nothing with it follow with a score of 0. Without vectors it raises;
    with vectors there need be no edges at all. ``digits`` rounds scores from vectors.
    Equal scores go by id. Edges are not broadcast by hint: adaptive execution
    does so where the edges of the item turn out small.
    """
    if direction not in ("both", "stored"):
        raise ValueError(f"direction must be 'both' or 'stored', not {direction!r}")
    columns = [name for name in items.columns if name != "similarity"]
    wanted = F.lit(item_id)
    least = None if edges is None else least_similarity(edges)
    if edges is None or threshold <= 0 or (least is not None and threshold < least):
        if vectors is None:
            if threshold <= 0:
                raise ValueError("a threshold of 0 needs vectors: edges hold no zero scores")
            if edges is None:
                raise ValueError("give edges, vectors or both")
            _check_threshold(threshold, least)
        score = score_stored_item if isinstance(vectors, Postings) else score_item
        near = score(vectors, item_id, digits=digits)
        if direction == "stored":
            near = near.where(F.col("other_id") > wanted)
    else:
        near = edges_of(edges, item_id, direction=direction)
    if threshold > 0:
        near = near.where(F.col("similarity") >= F.lit(float(threshold)))
        if how == "left" and k is not None:
            near = near.orderBy(F.desc("similarity"), "other_id").limit(k)
        found = near.join(
            items.select(*columns), F.col("other_id") == F.col("item_id"), how
        )
    else:
        known = items.where(F.col("item_id") == wanted).select("item_id")
        others = F.col("item_id") > wanted if direction == "stored" else F.col("item_id") != wanted
        found = (
            items.select(*columns)
            .where(others & known.exists())
            .join(near, F.col("item_id") == F.col("other_id"), "left")
            .withColumn("similarity", F.coalesce("similarity", F.lit(0.0)))
            .withColumn("other_id", F.col("item_id"))
        )
    ordered = found.select("similarity", "other_id", *columns).orderBy(
        F.desc("similarity"), "other_id"
    )
    return ordered if k is None else ordered.limit(k)


def found_similar(items: DataFrame, edges: DataFrame | None, item_id: int, **options) -> DataFrame:
    """``similar_items`` of an item that must be known and have similar items.

    Raises UnknownItem or NothingSimilar otherwise; each costs a look at one row.
    """
    if items.where(F.col("item_id") == F.lit(item_id)).isEmpty():
        raise UnknownItem(f"there is no item {item_id}")
    found = similar_items(items, edges, item_id, **options)
    if found.isEmpty():
        raise NothingSimilar(f"nothing is similar enough to item {item_id}: lower the threshold")
    return found


def top_k_of_edges(
    edges: DataFrame, k: int = BEST, *, threshold: float = THRESHOLD
) -> DataFrame:
    """(item_id, position, other_id, similarity): the k best of every item, from an edge table.

    A threshold below the one the edges were found with raises an error.
    """
    _check_threshold(threshold, least_similarity(edges))
    once = forward_only(edges)
    links = once.where(F.col("similarity") >= F.lit(float(threshold))).toDF(
        *[{"item_id": "vector_id", "other_id": "other_vector"}.get(c, c) for c in edges.columns]
    )
    return best_links(links, k).select(
        F.col("vector_id").alias("item_id"),
        "position",
        F.col("other_vector").alias("other_id"),
        "similarity",
    )


def top_k_neighbours(
    index: SimilarityIndex, k: int = BEST, *, threshold: float = THRESHOLD
) -> DataFrame:
    """The k best of every item, from the index, without writing out pairs of copies.

    Vectors are ranked by score and then by their lowest item, so the first k + 1
    vectors, each with its k + 1 lowest items, hold the k best items of each item
    even after it has dropped itself. A threshold below that of the index raises.
    """
    _check_threshold(threshold, index.threshold)
    links = index.links.where(F.col("similarity") >= F.lit(float(threshold)))
    if index.members is None:
        return top_k_of_edges(
            links.select(
                F.col("vector_id").alias("item_id"), F.col("other_vector").alias("other_id"),
                "similarity",
            ),
            k,
            threshold=threshold,
        )
    return items_of_best(best_links(links, k + 1), index.members, k)


def items_of_best(ranked: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """The k best items of every item from the k + 1 best vectors of every vector.

    ``ranked`` is (vector_id, other_vector, similarity); a vector with copies is among
    its own best.
    """
    lowest = Window.partitionBy("vector_id").orderBy("item_id")
    heads = (
        members.withColumn("nth", F.row_number().over(lowest))
        .where(F.col("nth") <= F.lit(k + 1))
        .select(F.col("vector_id").alias("other_vector"), F.col("item_id").alias("other_id"))
    )
    best = Window.partitionBy("vector_id").orderBy(F.desc("similarity"), "other_id")
    candidates = (
        ranked.join(heads, "other_vector")
        .withColumn("nth", F.row_number().over(best))
        .where(F.col("nth") <= F.lit(k + 1))
        .groupBy("vector_id")
        .agg(
            F.sort_array(F.collect_list(F.struct("nth", "other_id", "similarity"))).alias("best")
        )
    )
    # At most k + 1 entries per vector are repeated for each slot of its copies.
    slots = F.ceil(F.col("copies") / F.lit(COPIES_PER_SLOT)).cast("int")
    spread = candidates.join(
        members.where("item_id = vector_id").select("vector_id", "copies"), "vector_id"
    ).select("vector_id", "best", F.explode(F.sequence(F.lit(0), slots - 1)).alias("slot"))
    placed = members.select(
        "item_id", "vector_id", F.pmod(F.xxhash64("item_id"), slots).cast("int").alias("slot")
    )
    others = F.slice(
        F.filter("best", lambda entry: entry["other_id"] != F.col("item_id")), 1, k
    )
    return (
        placed.join(spread, ["vector_id", "slot"])
        .select("item_id", F.posexplode(others).alias("at", "entry"))
        .select(
            "item_id",
            (F.col("at") + 1).alias("position"),
            F.col("entry.other_id").alias("other_id"),
            F.col("entry.similarity").alias("similarity"),
        )
    )



def dense_neighbours(
    vectors: DataFrame,
    query: Sequence[float],
    *,
    id_column: str = "item_id",
    vector_column: str = "vector",
    k: int | None = BEST,
    threshold: float | None = None,
    digits: int | None = None,
) -> DataFrame:
    """(id, similarity) of the dense vectors closest to one query vector.

    The query is one constant in the plan; the table is scanned once.
    """
    score = dense_cosine(F.col(vector_column), dense_literal(query))
    scored = vectors.select(
        id_column, (score if digits is None else F.round(score, digits)).alias("similarity")
    )
    if threshold is not None:
        scored = scored.where(F.col("similarity") >= F.lit(float(threshold)))
    ordered = scored.orderBy(F.desc("similarity"), id_column)
    return ordered if k is None else ordered.limit(k)
