"""Registered queries: features, similar pairs and neighbours."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.functions.tokens import joined
from affinia.functions.vectors import dense_cosine
from affinia.operators.best import best_neighbours
from affinia.operators.edge_store import mirrored, stored_positions, write_edge_store
from affinia.operators.features import (
    build_hashed_vectors,
    build_vectors,
    document_frequency,
    fold_copies,
    hashed_norms,
    inverse_document_frequency,
    item_tokens,
    item_weights,
    term_frequency,
)
from affinia.operators.nearest import nearest_of_all
from affinia.operators.neighbours import (
    dense_neighbours,
    similar_items,
    top_k_neighbours,
    top_k_of_edges,
)
from affinia.operators.pairs import (
    SimilarityIndex,
    build_index,
    pairs_by_score,
    score_pairs,
    similar_pairs,
)
from affinia.operators.postings import write_postings
from affinia.plans import bindings
from affinia.plans.bindings import ITEMS_SQL, flat, stored_items, table
from affinia.plans.jobs import prepare_similarity, publish
from affinia.sources.sinks import write_parquet
from affinia.sources.workspace import fresh_path, staged

THRESHOLD = 0.3
DIGITS = 6
ASKED = 42
COPY_COLUMNS = ("title", "genres")
COPY_THRESHOLD = 0.1

WEIGHTS_SQL = f"""
{ITEMS_SQL},
tokens AS (
    SELECT item_id, unnest(string_split(concat_ws(', ', title, array_to_string(genres, ', '),
           CAST(rating AS VARCHAR), array_to_string(persons, ', ')), ',')) AS token
    FROM items
),
tf AS (SELECT item_id, token, count(*) AS tf FROM tokens GROUP BY ALL),
df AS (
    SELECT token, count(*) AS df,
           ln(((SELECT count(*) FROM items) + 1.0) / (count(*) + 1.0)) AS idf
    FROM tf GROUP BY token
),
raw AS (SELECT item_id, token, tf * idf AS w FROM tf JOIN df USING (token)),
units AS (
    SELECT item_id, token, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS u
    FROM raw WHERE w > 0
)
"""
PAIRS_SQL = f"""
{WEIGHTS_SQL},
scores AS (
    SELECT a.item_id, b.item_id AS other_id, sum(a.u * b.u) AS score
    FROM units a JOIN units b ON a.token = b.token AND a.item_id < b.item_id
    GROUP BY ALL
),
edges AS (
    SELECT item_id, other_id, round(score, {DIGITS}) AS similarity
    FROM scores WHERE round(score, {DIGITS}) >= {THRESHOLD}
),
both_ways AS (
    SELECT * FROM edges UNION ALL SELECT other_id, item_id, similarity FROM edges
)
"""


def _scores_of_one(spark: SparkSession, folder: str) -> DataFrame:
    """Item 42 against every other item, from the vectors: true scores at threshold 0."""
    items = stored_items(spark, folder)
    found = similar_items(
        items, None, ASKED, threshold=0, k=None, vectors=build_vectors(items), digits=DIGITS
    )
    return flat(found)


def _index(spark: SparkSession, folder: str) -> tuple[DataFrame, SimilarityIndex]:
    items = stored_items(spark, folder)
    return items, build_index(build_vectors(items), THRESHOLD, digits=DIGITS)


def feature_tokens_query(spark: SparkSession, folder: str) -> DataFrame:
    tokens = item_tokens(stored_items(spark, folder))
    return tokens.select("item_id", joined("features", "|").alias("features"))


FEATURE_TOKENS_SQL = f"""
WITH {ITEMS_SQL}
SELECT item_id, array_to_string(string_split(concat_ws(', ', title,
       array_to_string(genres, ', '), CAST(rating AS VARCHAR), array_to_string(persons, ', ')),
       ','), '|') AS features
FROM items
"""


def token_idf(spark: SparkSession, folder: str) -> DataFrame:
    items = stored_items(spark, folder)
    folded = staged(fold_copies(item_tokens(items)), "folded")
    frequencies = document_frequency(term_frequency(folded))
    weights = inverse_document_frequency(frequencies, items.count())
    return weights.select("token", "df", F.round("idf", DIGITS).alias("idf"))


TOKEN_IDF_SQL = f"WITH {WEIGHTS_SQL} SELECT token, df, round(idf, {DIGITS}) AS idf FROM df"


def token_unit_weights(spark: SparkSession, folder: str) -> DataFrame:
    vectors = build_vectors(stored_items(spark, folder))
    return (
        item_weights(vectors)
        .join(vectors.vocabulary.select("token_id", "token"), "token_id")
        .select("item_id", "token", F.round("weight", DIGITS).alias("weight"))
    )


TOKEN_UNIT_WEIGHTS_SQL = (
    f"WITH {WEIGHTS_SQL} SELECT item_id, token, round(u, {DIGITS}) AS weight FROM units"
)


def pairs_query(spark: SparkSession, folder: str) -> DataFrame:
    return similar_pairs(stored_items(spark, folder), THRESHOLD, digits=DIGITS)


PAIRS_QUERY_SQL = f"WITH {PAIRS_SQL} SELECT * FROM edges"


def pairs_by_frequent_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The same pairs with most tokens treated as frequent."""
    items = stored_items(spark, folder)
    return similar_pairs(items, THRESHOLD, digits=DIGITS, frequent_rows=64)


def pair_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The score of each item with the next two numbers: zeros included, null where no item is."""
    items = stored_items(spark, folder)
    asked = items.select(
        "item_id",
        F.explode(F.array(F.col("item_id") + 1, F.col("item_id") + 2)).alias("other_id"),
    )
    return score_pairs(build_vectors(items), asked, digits=DIGITS)


PAIR_SCORES_SQL = f"""
WITH {WEIGHTS_SQL},
asked AS (SELECT item_id, unnest([item_id + 1, item_id + 2]) AS other_id FROM items)
SELECT asked.item_id, asked.other_id,
       CASE WHEN count(known.item_id) > 0
            THEN round(coalesce(sum(a.u * b.u), 0), {DIGITS}) END AS similarity
FROM asked
LEFT JOIN items known ON known.item_id = asked.other_id
LEFT JOIN units a ON a.item_id = asked.item_id
LEFT JOIN units b ON b.item_id = asked.other_id AND b.token = a.token
GROUP BY ALL
"""


def _similar(**options):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        items, index = _index(spark, folder)
        return flat(similar_items(items, index.edges(), ASKED, **options))

    return run


def similar_items_left(spark: SparkSession, folder: str) -> DataFrame:
    """A neighbour that is missing from the items keeps its row."""
    items, index = _index(spark, folder)
    some = items.where("item_id % 3 <> 0")
    return flat(similar_items(some, index.edges(), ASKED, threshold=THRESHOLD, how="left"))


SIMILAR_LEFT_SQL = f"""
WITH {PAIRS_SQL},
near AS (
    SELECT other_id, similarity FROM both_ways WHERE item_id = {ASKED}
    ORDER BY similarity DESC, other_id LIMIT 10
)
SELECT similarity, other_id, kept.*
FROM near LEFT JOIN (SELECT * FROM flat_items WHERE item_id % 3 <> 0) kept
     ON kept.item_id = other_id
"""


def _similar_sql(source: str, limit: str) -> str:
    return f"""
WITH {PAIRS_SQL}
SELECT similarity, other_id, flat_items.*
FROM (SELECT other_id, similarity FROM {source} WHERE item_id = {ASKED}) near
JOIN flat_items ON flat_items.item_id = other_id
ORDER BY similarity DESC, other_id {limit}
"""


SIMILAR_ZERO_SQL = f"""
WITH {WEIGHTS_SQL}
SELECT coalesce(near.score, 0) AS similarity, flat_items.item_id AS other_id, flat_items.*
FROM flat_items
LEFT JOIN (SELECT b.item_id AS other_id, round(sum(a.u * b.u), {DIGITS}) AS score
           FROM units a JOIN units b USING (token) WHERE a.item_id = {ASKED} GROUP BY ALL) near
     ON near.other_id = flat_items.item_id
WHERE flat_items.item_id <> {ASKED}
"""


def top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k_neighbours(_index(spark, folder)[1], 10, threshold=THRESHOLD)


TOP_K_SQL = f"""
WITH {PAIRS_SQL},
ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id
           ORDER BY similarity DESC, other_id) AS INTEGER) AS position, other_id, similarity
    FROM both_ways
)
SELECT * FROM ranked WHERE position <= 10
"""


def top_k_among_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Few distinct titles, so each vector stands for a large group of copies."""
    vectors = build_vectors(stored_items(spark, folder), COPY_COLUMNS)
    index = build_index(vectors, COPY_THRESHOLD, digits=DIGITS)
    return top_k_neighbours(index, 40, threshold=COPY_THRESHOLD)


def pairs_among_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs per score where items are mostly copies; only the counts are written out."""
    vectors = build_vectors(stored_items(spark, folder), COPY_COLUMNS)
    return pairs_by_score(build_index(vectors, COPY_THRESHOLD, digits=DIGITS))


COPIES_SQL = PAIRS_SQL.replace(
    """array_to_string(genres, ', '),
           CAST(rating AS VARCHAR), array_to_string(persons, ', '))""",
    "array_to_string(genres, ', '))",
).replace(f">= {THRESHOLD}", f">= {COPY_THRESHOLD}")
TOP_K_COPIES_SQL = TOP_K_SQL.replace(PAIRS_SQL, COPIES_SQL).replace(
    "position <= 10", "position <= 40"
)
PAIRS_COPIES_SQL = f"""
WITH {COPIES_SQL}
SELECT similarity, count(*) AS n, min(item_id) AS first_item, max(other_id) AS last_other
FROM edges GROUP BY similarity
"""


def top_k_stored_edges(spark: SparkSession, folder: str) -> DataFrame:
    """The same ranking from a plain edge table: co-ordered parts, weighted by discount."""
    lines = table(spark, folder, "lineitem")
    edges = lines.groupBy(
        F.col("l_partkey").alias("item_id"), (F.col("l_suppkey") + 1_000_000_000).alias("other_id")
    ).agg(F.max("l_discount").alias("similarity"))
    return top_k_of_edges(edges, 3, threshold=0.05)


TOP_K_STORED_EDGES_SQL = """
WITH edges AS (
    SELECT l_partkey AS item_id, l_suppkey + 1000000000 AS other_id, max(l_discount) AS similarity
    FROM lineitem GROUP BY ALL HAVING max(l_discount) >= 0.05
),
both_ways AS (SELECT * FROM edges UNION ALL SELECT other_id, item_id, similarity FROM edges),
ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id
           ORDER BY similarity DESC, other_id) AS INTEGER) AS position, other_id, similarity
    FROM both_ways
)
SELECT * FROM ranked WHERE position <= 3
"""


def mirrored_edges(spark: SparkSession, folder: str) -> DataFrame:
    return mirrored(_index(spark, folder)[1].edges())


def hashed_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Hashed tokens through the ML stages; may differ where two tokens share a bucket."""
    vectors = build_hashed_vectors(stored_items(spark, folder))
    return build_index(vectors, THRESHOLD, digits=DIGITS).edges()


def hashed_vector_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Every hashed vector has length 1: the check of the ML stages in numbers."""
    values = F.unwrap_udt("norm")["values"]
    square = F.aggregate(values, F.lit(0.0), lambda total, value: total + value * value)
    return hashed_norms(stored_items(spark, folder)).select(
        "item_id", F.round(F.sqrt(square), DIGITS).alias("length")
    )


HASHED_LENGTHS_SQL = f"WITH {ITEMS_SQL} SELECT item_id, CAST(1.0 AS DOUBLE) AS length FROM items"


def dense_pair_cosine(spark: SparkSession, folder: str) -> DataFrame:
    """Cosine of each embedding with the next one."""
    vectors = table(spark, folder, "embeddings")
    following = vectors.select(
        (F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other")
    )
    return vectors.join(following, "vec_id").select(
        "vec_id", F.round(dense_cosine(F.col("embedding"), F.col("other")), 4).alias("similarity")
    )


DENSE_PAIR_SQL = """
SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]),
       CAST(b.embedding AS DOUBLE[])), 4) AS similarity
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
"""


def dense_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings ranked against embedding 0."""
    vectors = table(spark, folder, "embeddings")
    query = vectors.where("vec_id = 0").select("embedding").first()["embedding"]
    return dense_neighbours(
        vectors, query, id_column="vec_id", vector_column="embedding", k=None, digits=4
    )


DENSE_NEAREST_SQL = """
SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]),
       (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)), 4) AS similarity
FROM embeddings
"""

def _edge_store(spark: SparkSession, folder: str) -> tuple[DataFrame, str]:
    items, index = _index(spark, folder)
    path = fresh_path(spark, "edge-store")
    write_edge_store(staged(index.edges(), "edges"), path)
    return items, path


def edge_store_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """One item from a store with both directions: one scan, by id."""
    items, path = _edge_store(spark, folder)
    return flat(similar_items(items, spark.read.parquet(path), ASKED, threshold=THRESHOLD))


def edge_store_order(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair in both directions with its place in the stored files."""
    return stored_positions(spark, _edge_store(spark, folder)[1])


EDGE_STORE_ORDER_SQL = f"""
WITH {PAIRS_SQL}
SELECT *, row_number() OVER (ORDER BY item_id, similarity DESC, other_id) AS position FROM both_ways
"""


def published_similar(spark: SparkSession, folder: str) -> DataFrame:
    """Items to pairs to catalog names, published twice, and a lookup by those names."""
    names = {"items_table": f"items_{uuid4().hex}", "edges_table": f"edges_{uuid4().hex}"}
    for rating in ("5", "0"):
        items_path, edges_path = fresh_path(spark, "items"), fresh_path(spark, "edges")
        write_parquet(bindings.items(spark, folder, min_rating=rating), items_path)
        prepare_similarity(spark, items_path, edges_path, threshold=THRESHOLD)
        publish(spark, items_path, edges_path, **names)
    found = similar_items(
        spark.table(names["items_table"]), spark.table(names["edges_table"]), ASKED, threshold=THRESHOLD, k=None
    )
    return flat(found).withColumn("similarity", F.round("similarity", DIGITS))


def score_from_postings(spark: SparkSession, folder: str) -> DataFrame:
    """Item 42 against every other item, from the stored postings of its tokens."""
    items = stored_items(spark, folder)
    store = write_postings(build_vectors(items), fresh_path(spark, "postings"))
    return flat(similar_items(items, None, ASKED, threshold=0, k=None, vectors=store, digits=DIGITS))


def best_of_every_item(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best of every item, whatever their scores."""
    return best_neighbours(build_vectors(stored_items(spark, folder)), 10, digits=DIGITS)


BEST_SQL = TOP_K_SQL.replace(f">= {THRESHOLD}", "> 0")


def best_among_copies(spark: SparkSession, folder: str) -> DataFrame:
    """The same where each vector stands for a large group of copies."""
    vectors = build_vectors(stored_items(spark, folder), COPY_COLUMNS)
    return best_neighbours(vectors, 40, digits=DIGITS)


BEST_COPIES_SQL = TOP_K_COPIES_SQL.replace(f">= {COPY_THRESHOLD}", "> 0")


def nearest_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest embeddings of every embedding."""
    found = nearest_of_all(
        table(spark, folder, "embeddings"), 5, id_column="vec_id", vector_column="embedding", digits=6
    )
    return found.withColumnsRenamed({"item_id": "vec_id"})


NEAREST_SQL = """
WITH pairs AS (
    SELECT a.vec_id, b.vec_id AS other_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]),
           CAST(b.embedding AS DOUBLE[])), 6) AS similarity
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
),
ranked AS (
    SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id
           ORDER BY similarity DESC, other_id) AS INTEGER) AS position, other_id, similarity
    FROM pairs
)
SELECT * FROM ranked WHERE position <= 5
"""

QUERIES = {
    "edge_store_lookup": (edge_store_lookup, _similar_sql("both_ways", "LIMIT 10")),
    "edge_store_order": (edge_store_order, EDGE_STORE_ORDER_SQL),
    "published_similar": (published_similar, _similar_sql("both_ways", "")),
    "score_from_postings": (score_from_postings, SIMILAR_ZERO_SQL),
    "best_of_every_item": (best_of_every_item, BEST_SQL),
    "best_among_copies": (best_among_copies, BEST_COPIES_SQL),
    "nearest_embeddings": (nearest_embeddings, NEAREST_SQL),
    "feature_tokens": (feature_tokens_query, FEATURE_TOKENS_SQL),
    "token_idf": (token_idf, TOKEN_IDF_SQL),
    "token_unit_weights": (token_unit_weights, TOKEN_UNIT_WEIGHTS_SQL),
    "similar_pairs": (pairs_query, PAIRS_QUERY_SQL),
    "pairs_by_frequent_tokens": (pairs_by_frequent_tokens, PAIRS_QUERY_SQL),
    "pair_scores": (pair_scores, PAIR_SCORES_SQL),
    "similar_items_both": (
        _similar(threshold=THRESHOLD),
        _similar_sql("both_ways", "LIMIT 10"),
    ),
    "similar_items_stored": (
        _similar(threshold=THRESHOLD, direction="stored"),
        _similar_sql("edges", "LIMIT 10"),
    ),
    "similar_items_left": (similar_items_left, SIMILAR_LEFT_SQL),
    "similar_items_all": (
        _similar(threshold=THRESHOLD, k=None),
        _similar_sql("both_ways", ""),
    ),
    "similar_items_zero": (_scores_of_one, SIMILAR_ZERO_SQL),
    "top_k_neighbours": (top_k, TOP_K_SQL),
    "top_k_among_copies": (top_k_among_copies, TOP_K_COPIES_SQL),
    "pairs_among_copies": (pairs_among_copies, PAIRS_COPIES_SQL),
    "top_k_stored_edges": (top_k_stored_edges, TOP_K_STORED_EDGES_SQL),
    "mirrored_edges": (mirrored_edges, f"WITH {PAIRS_SQL} SELECT * FROM both_ways"),
    "hashed_pairs": (hashed_pairs, PAIRS_QUERY_SQL),
    "hashed_vector_lengths": (hashed_vector_lengths, HASHED_LENGTHS_SQL),
    "dense_pair_cosine": (dense_pair_cosine, DENSE_PAIR_SQL),
    "dense_nearest": (dense_nearest, DENSE_NEAREST_SQL),
}
