"""All registered queries by name."""

from __future__ import annotations

from affinia.plans import item_queries, similarity_queries, source_queries

QUERIES = {
    **source_queries.QUERIES,
    **item_queries.QUERIES,
    **similarity_queries.QUERIES,
}
