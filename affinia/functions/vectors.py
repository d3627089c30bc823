"""Vector expressions on array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sparse_dot(
    left_tokens: Column, left_weights: Column, right_tokens: Column, right_weights: Column
) -> Column:
    """Dot product of two sparse vectors held as parallel token and weight arrays.

    The shared tokens come from a hash intersection, so only they are looked up.
    Terms are added in the order of the left vector: the same on every run.
    """

    def weight(tokens: Column, weights: Column, token: Column) -> Column:
        return F.element_at(weights, F.array_position(tokens, token).cast("int"))

    return F.aggregate(
        F.array_intersect(left_tokens, right_tokens),
        F.lit(0.0),
        lambda total, token: total
        + weight(left_tokens, left_weights, token) * weight(right_tokens, right_weights, token),
    )


def dense_dot(left: Column, right: Column) -> Column:
    """Dot product of two dense arrays, in double precision."""
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, product: total + product)


def dense_cosine(left: Column, right: Column) -> Column:
    """Cosine of two dense arrays; 0 where either has no length."""
    scale = F.sqrt(dense_dot(left, left)) * F.sqrt(dense_dot(right, right))
    return F.coalesce(F.try_divide(dense_dot(left, right), scale), F.lit(0.0))


def dense_literal(values: Sequence[float]) -> Column:
    """A dense vector as a constant column."""
    return F.array(*[F.lit(float(value)) for value in values])
