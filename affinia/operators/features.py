"""Weighted, unit-length token vectors of items.

A vector stands for all items with the same bag of tokens. Items that copy each
other are folded together before anything is compared, so a group of copies,
however large, costs one vector.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.functions.tokens import feature_tokens
from affinia.operators.skew import count_total, join_counted
from affinia.sources.workspace import staged

FEATURE_COLUMNS = ("title", "genres", "rating", "persons")


@dataclass(frozen=True)
class Vectors:
    """Unit vectors in the work area.

    frame       vector_id, copies, entries array<struct<rows, token_id, weight, head>>, from
                the rarest token to the most frequent; ``rows`` is how many vectors hold
                the token, ``head`` the length of the vector from this token on
    vocabulary  token_id, rows and more
    members     item_id, vector_id, copies; None where no two items are copies
    items       number of items
    folded      vector_id, copies of every vector, those without weights too
    """

    frame: DataFrame
    vocabulary: DataFrame
    members: DataFrame | None
    items: int
    folded: DataFrame

    @property
    def known(self) -> DataFrame:
        """(item_id, vector_id) of every item the vectors were built from."""
        if self.members is not None:
            return self.members.select("item_id", "vector_id")
        return self.folded.select(F.col("vector_id").alias("item_id"), "vector_id")


def item_tokens(
    items: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS, *, item_column: str = "item_id"
) -> DataFrame:
    """(item_id, features): the token array of each item."""
    return items.select(
        F.col(item_column).alias("item_id"), feature_tokens(items, columns).alias("features")
    )


def _bags(tokens: DataFrame) -> DataFrame:
    """(item_id, bag): the sorted tokens as one text. No token holds a comma."""
    return tokens.select("item_id", F.array_join(F.array_sort("features"), ",").alias("bag"))


def fold_copies(tokens: DataFrame) -> DataFrame:
    """(vector_id, copies, bag): one row per distinct bag, named after its lowest item."""
    return (
        _bags(tokens)
        .groupBy("bag")
        .agg(F.min("item_id").alias("vector_id"), F.count("*").alias("copies"))
        .select("vector_id", "copies", "bag")
    )


def copy_members(tokens: DataFrame, folded: DataFrame, items: int) -> DataFrame:
    """(item_id, vector_id, copies) of every item. Only items with copies are joined."""
    digest = F.sha2("bag", 256)
    repeated = folded.where("copies > 1").select(
        digest.alias("digest"), "vector_id", F.col("copies").alias("copies")
    )
    signed = _bags(tokens).select("item_id", digest.alias("digest"))
    shared = join_counted(signed, repeated, "digest", "copies", items)
    single = folded.where("copies = 1")
    return shared.select("item_id", "vector_id", "copies").unionByName(
        single.select(F.col("vector_id").alias("item_id"), "vector_id", "copies")
    )


def term_frequency(folded: DataFrame) -> DataFrame:
    """(vector_id, copies, token, tf): how often a vector holds each token."""
    exploded = folded.select("vector_id", "copies", F.explode(F.split("bag", ",")).alias("token"))
    return exploded.groupBy("vector_id", "copies", "token").agg(F.count("*").alias("tf"))


def document_frequency(frequencies: DataFrame) -> DataFrame:
    """(token, df, rows): items, and vectors, that hold each token."""
    return frequencies.groupBy("token").agg(
        F.sum("copies").alias("df"), F.count("*").alias("rows")
    )


def inverse_document_frequency(vocabulary: DataFrame, items: int) -> DataFrame:
    """Adds ``idf``, the logarithm of (items + 1) / (df + 1)."""
    ratio = F.lit(items + 1.0) / (F.col("df") + F.lit(1.0))
    return vocabulary.withColumn("idf", F.ln(ratio))


def numbered(vocabulary: DataFrame) -> DataFrame:
    """The vocabulary in the work area, with a number per token.

    Numbers are given while the table is written, so all later reads agree on
    them. Joins and shuffles then carry eight bytes instead of a whole text.
    """
    return staged(vocabulary.withColumn("token_id", F.monotonically_increasing_id()), "vocabulary")


def unit_vectors(weighted: DataFrame) -> DataFrame:
    """Vectors of length 1 from (vector_id, copies, token_id, rows, w): see Vectors.frame.

    Running sums from the most frequent token down give the remaining lengths and
    the full length in one sort per vector, added in the same order on every run.
    Zero weights go; a vector with nothing else has no row, and scores 0 with all.
    """
    down = Window.partitionBy("vector_id").orderBy(F.desc("rows"), F.desc("token_id"))
    square = F.sum(F.col("w") * F.col("w"))
    measured = weighted.where("w > 0").select(
        "*",
        square.over(down.rowsBetween(Window.unboundedPreceding, 0)).alias("from_here"),
        square.over(
            down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ).alias("whole"),
    )
    entry = F.struct(
        "rows",
        "token_id",
        (F.col("w") / F.sqrt("whole")).alias("weight"),
        F.sqrt(F.col("from_here") / F.col("whole")).alias("head"),
    )
    return measured.groupBy("vector_id", "copies").agg(
        F.sort_array(F.collect_list(entry)).alias("entries")
    )


def build_vectors(
    items: DataFrame,
    columns: Sequence[str] = FEATURE_COLUMNS,
    *,
    item_column: str = "item_id",
) -> Vectors:
    """TF-IDF vectors of length 1 from the feature columns.

    ``items`` is read twice (folding, members): pass a table, not a long plan.
    Stages are written to the work area, because each is read several times.
    """
    tokens = item_tokens(items, columns, item_column=item_column)
    folded = staged(fold_copies(tokens), "folded")
    size = folded.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("items"), F.count("*").alias("vectors")
    ).first()
    frequencies = staged(term_frequency(folded), "frequencies")
    vocabulary = numbered(
        inverse_document_frequency(document_frequency(frequencies), size["items"])
    )
    weighted = join_counted(
        frequencies, vocabulary, "token", "rows", count_total(vocabulary, "rows")
    ).select(
        "vector_id", "copies", "token_id", "rows", (F.col("tf") * F.col("idf")).alias("w")
    )
    members = None
    if size["items"] > size["vectors"]:
        members = staged(copy_members(tokens, folded, size["items"]), "members")
    return Vectors(
        staged(unit_vectors(weighted), "vectors"), vocabulary, members, size["items"], folded
    )


def item_weights(vectors: Vectors) -> DataFrame:
    """(item_id, token_id, weight) of every item."""
    weights = vectors.frame.select("vector_id", F.inline("entries")).drop("rows", "head")
    if vectors.members is None:
        return weights.withColumnRenamed("vector_id", "item_id")
    members = vectors.members.select("item_id", "vector_id")
    return members.join(weights, "vector_id").drop("vector_id")


def hashed_norms(
    items: DataFrame,
    columns: Sequence[str] = FEATURE_COLUMNS,
    *,
    buckets: int = 1 << 18,
    item_column: str = "item_id",
) -> DataFrame:
    """(item_id, norm): TF-IDF over hashed tokens as ML vectors of length 1."""
    tokens = staged(item_tokens(items, columns, item_column=item_column), "tokens")
    return _normed(tokens, tokens, buckets)


def _normed(fitted: DataFrame, transformed: DataFrame, buckets: int) -> DataFrame:
    """``transformed`` with its unit vectors; document frequencies come from ``fitted``.

    The fit brings one number per bucket to the driver, whatever the size of the data.
    """
    hashing = HashingTF(numFeatures=buckets, inputCol="features", outputCol="tf")
    model = IDF(inputCol="tf", outputCol="tfidf").fit(hashing.transform(fitted))
    weighted = model.transform(hashing.transform(transformed))
    return (
        Normalizer(inputCol="tfidf", outputCol="norm")
        .transform(weighted)
        .drop("features", "tf", "tfidf")
    )


def build_hashed_vectors(
    items: DataFrame,
    columns: Sequence[str] = FEATURE_COLUMNS,
    *,
    buckets: int = 1 << 18,
    item_column: str = "item_id",
) -> Vectors:
    """Like ``build_vectors`` with hashed tokens through the ML stages.

    Tokens that share a bucket count as one token.
    """
    tokens = staged(item_tokens(items, columns, item_column=item_column), "tokens")
    folded = staged(fold_copies(tokens), "folded")
    count = tokens.count()
    members = None
    if count > folded.count():
        members = staged(copy_members(tokens, folded, count), "members")
    bags = folded.select("vector_id", "copies", F.split("bag", ",").alias("features"))
    sparse = _normed(tokens, bags, buckets).select(
        "vector_id", "copies", F.unwrap_udt("norm").alias("v")
    )
    weights = staged(
        sparse.select(
            "vector_id",
            "copies",
            F.inline(
                F.arrays_zip(
                    F.col("v.indices").cast("array<bigint>").alias("token_id"),
                    F.col("v.values").alias("w"),
                )
            ).alias("token_id", "w"),
        ),
        "hashed",
    )
    vocabulary = staged(weights.groupBy("token_id").agg(F.count("*").alias("rows")), "buckets")
    weighted = join_counted(
        weights, vocabulary, "token_id", "rows", count_total(vocabulary, "rows")
    )
    return Vectors(staged(unit_vectors(weighted), "vectors"), vocabulary, members, count, folded)
