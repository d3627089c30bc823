"""Stored layouts for lookups, the best k of every item, and nearest dense vectors."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_pairs import SCHEMA, brute_force, catalogue

from affinia.operators import pairs
from affinia.operators.best import best_neighbours, best_vectors, floors_of
from affinia.operators.edge_store import (
    forward_only,
    holds_both_ways,
    mirrored,
    stored_positions,
    write_edge_store,
)
from affinia.operators.features import build_vectors
from affinia.operators.nearest import nearest_of_all
from affinia.operators.neighbours import (
    NothingSimilar,
    UnknownItem,
    edges_of,
    found_similar,
    similar_items,
    top_k_of_edges,
)
from affinia.operators.pairs import build_index, score_item
from affinia.operators.postings import one_of, read_postings, score_stored_item, write_postings
from affinia.sources.workspace import fresh_path, staged

THRESHOLD = 0.2


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows():
    return catalogue(seed=11, size=70)


@pytest.fixture(scope="module")
def truth(rows):
    return brute_force(rows)


@pytest.fixture(scope="module")
def items(spark, rows):
    return staged(spark.createDataFrame(rows, SCHEMA), "items")


@pytest.fixture(scope="module")
def vectors(items):
    return build_vectors(items)


@pytest.fixture(scope="module")
def edges(vectors):
    return staged(build_index(vectors, THRESHOLD).edges(), "edges")


@pytest.fixture(scope="module")
def store(spark, edges):
    path = fresh_path(spark, "store")
    write_edge_store(edges, path, row_group=1024)
    return path


# Pairs in both directions


def test_store_holds_each_pair_twice(spark, edges, store):
    stored = spark.read.parquet(store)
    assert holds_both_ways(stored) and not holds_both_ways(edges)
    once = {(r.item_id, r.other_id, r.similarity) for r in edges.collect()}
    assert {tuple(r) for r in stored.collect()} == once | {(b, a, s) for a, b, s in once}
    assert {tuple(r) for r in forward_only(stored).collect()} == once
    assert mirrored(stored) is stored


def test_store_is_in_order_on_disk(spark, store):
    found = stored_positions(spark, store).orderBy("position").collect()
    assert [r.position for r in found] == list(range(1, len(found) + 1))
    order = [(r.item_id, -r.similarity, r.other_id) for r in found]
    assert order == sorted(order)


def test_lookup_reads_one_pruned_scan(spark, edges, store):
    stored = spark.read.parquet(store)
    text = plan(edges_of(stored, 5))
    assert text.count("FileScan") == 1
    assert "EqualTo(item_id,5)" in text
    for direction in ("both", "stored"):
        expected = {tuple(r) for r in edges_of(edges, 5, direction=direction).collect()}
        assert {tuple(r) for r in edges_of(stored, 5, direction=direction).collect()} == expected


def test_best_of_a_store_are_those_of_its_pairs(spark, edges, store):
    expected = {tuple(r) for r in top_k_of_edges(edges, 4, threshold=THRESHOLD).collect()}
    assert {tuple(r) for r in top_k_of_edges(spark.read.parquet(store), 4, threshold=THRESHOLD).collect()} == expected
    with pytest.raises(ValueError, match="stored from"):
        top_k_of_edges(spark.read.parquet(store), 4, threshold=0.01)


def test_unknown_and_lonely_items_differ(spark, items, store):
    stored = spark.read.parquet(store)
    assert found_similar(items, stored, 3, threshold=THRESHOLD).count() > 0
    with pytest.raises(UnknownItem):
        found_similar(items, stored, 999, threshold=THRESHOLD)
    with pytest.raises(NothingSimilar):
        found_similar(items.where("item_id = 1"), stored, 1, threshold=0.999_999)


# Postings


@pytest.fixture(scope="module")
def postings(spark, vectors):
    path = fresh_path(spark, "postings")
    write_postings(vectors, path, row_group=1024)
    return read_postings(spark, path)


@pytest.mark.parametrize("item", [1, 3, 50, 999])
def test_postings_score_as_vectors_do(vectors, postings, item):
    expected = {tuple(r) for r in score_item(vectors, item).collect()}
    assert {tuple(r) for r in score_stored_item(postings, item).collect()} == expected
    assert bool(expected) == (item != 999)


def test_tokens_reach_the_scan_of_postings(postings):
    text = plan(score_stored_item(postings, 1))
    pushed = [line for line in text.splitlines() if "PushedFilters" in line and "token_id" in line]
    assert pushed and ("In(token_id" in pushed[0] or "EqualTo(token_id" in pushed[0])
    many = plan(postings.postings.where(one_of("token_id", list(range(0, 100, 3)))))
    assert many.count("In(token_id") >= 2 and "INSET" not in many  # the plan shortens the rest


def test_similar_items_from_postings(items, vectors, postings):
    for threshold, k in ((0, None), (0.05, 5)):
        options = {"threshold": threshold, "k": k}
        expected = similar_items(items, None, 7, vectors=vectors, **options).collect()
        assert similar_items(items, None, 7, vectors=postings, **options).collect() == expected


def test_postings_without_copies(spark):
    rows = [(i, f"T{i}", ["G"] if i % 2 else ["H", "K"], None, [f"P{i}"]) for i in range(6)]
    vectors = build_vectors(spark.createDataFrame(rows, SCHEMA))
    made = write_postings(vectors, fresh_path(spark, "postings"))
    assert made.members is None
    assert score_stored_item(made, 1).count() == score_item(vectors, 1).count() == 2


# The best k of every item


def best_by_force(truth, k):
    others = defaultdict(list)
    for (a, b), score in truth.items():
        if round(score, 9) > 0:
            others[a].append((-round(score, 9), b))
            others[b].append((-round(score, 9), a))
    return {(i, n + 1): found for i, ranked in others.items() for n, found in enumerate(sorted(ranked)[:k])}


@pytest.mark.parametrize(("k", "frequent_rows"), [(1, 8192), (3, 8192), (10, 5), (3, 2), (200, 8)])
def test_best_neighbours_are_those_of_all_scores(vectors, truth, k, frequent_rows):
    found = best_neighbours(vectors, k, frequent_rows=frequent_rows).collect()
    expected = best_by_force(truth, k)
    assert {(r.item_id, r.position) for r in found} == set(expected)
    for r in found:
        score, other = expected[(r.item_id, r.position)]
        assert (r.other_id, round(r.similarity, 8)) == (other, round(-score, 8))


def test_best_vectors_from_any_seed(vectors):
    expected = {tuple(r) for r in best_vectors(vectors, 4, frequent_rows=6).collect()}
    for seed in (2, 4, 6):
        assert {tuple(r) for r in best_vectors(vectors, 4, frequent_rows=6, seed_rows=seed).collect()} == expected


def test_floors_need_k_pairs(spark):
    parts = spark.createDataFrame([(1, 2, 0.5), (1, 3, 0.25)], "vector_id long, other_vector long, part double")
    assert {tuple(r) for r in floors_of(parts, 2, 6).collect()} == {(1, 0.25 - 1e-6)}


def test_tails_sum_across_batches():
    schema = ["vector_id", "vector_ids", "weight", "weights", "length", "lengths", "floor", "floors"]
    data = [(1, [2, 3], 0.5), (1, [3], 1.0), (1, [2], 0.25), (4, [5], 1.0), (4, [5, 6], 1.0)]

    def batch(rows):
        columns = [[r[0] for r in rows], [r[1] for r in rows]]
        columns += [[r[2] for r in rows], [[1.0] * len(r[1]) for r in rows]]
        columns += [[0.5 for _ in rows], [[0.25] * len(r[1]) for r in rows]]
        columns += [[0.9 for _ in rows], [[2.0] * len(r[1]) for r in rows]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema)

    for cuts in ([5], [1, 4], [2, 3], [1, 1, 1, 1, 1]):
        parts, at = [], 0
        for size in cuts:
            parts.append(batch(data[at : at + size]))
            at += size
        got = [r for b in pairs.summing(0.0)(iter(parts)) for r in b.to_pylist()]
        # (1, 2) has 0.75 + 0.125, below both floors; (1, 3) and (4, 5) reach one.
        assert [tuple(r.values()) for r in got] == [(1, 3, 1.5), (4, 5, 2.0), (4, 6, 1.0)]


# Nearest dense vectors


def nearest_by_force(rows, k, digits):
    ranked = {}
    units = {i: np.array(v, float) / np.linalg.norm(v) for i, v in rows if np.linalg.norm(v) > 0}
    for i, u in units.items():
        others = sorted((-round(float(u @ v), digits) + 0.0, j) for j, v in units.items() if j != i)
        for n, (score, j) in enumerate(others[:k]):
            ranked[(i, n + 1)] = (j, -score)
    return ranked


@pytest.mark.parametrize(("k", "pivots"), [(1, 1), (3, 4), (7, 16), (250, 3)])
def test_nearest_are_those_of_all_pairs(spark, k, pivots):
    draw = np.random.default_rng(k)
    centres = draw.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.3 * draw.normal(size=8)).tolist()) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(40)]  # copies
    rows += [(300, [0.0] * 8), (301, (-np.array(rows[1][1])).tolist())]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "item_id long, vector array<double>").withColumn("position", F.lit("x"))
    found = nearest_of_all(frame, k, digits=5, pivots=pivots).collect()
    expected = nearest_by_force(rows, k, 5)
    assert {(r.item_id, r.position) for r in found} == set(expected)
    scores = {(r.item_id, r.position): r.similarity for r in found}
    assert all(abs(scores[key] - score) <= 2e-5 for key, (_, score) in expected.items())
    others = {(r.item_id, r.position): r.other_id for r in found}
    wrong = [key for key, (other, _) in expected.items() if others[key] != other]
    # Only cosines on the edge of rounding may change places.
    assert len(wrong) <= len(expected) // 500


def test_nearest_of_few(spark):
    schema = "item_id long, vector array<double>"
    assert nearest_of_all(spark.createDataFrame([], schema), 3).collect() == []
    assert nearest_of_all(spark.createDataFrame([(1, [1.0, 0.0])], schema), 3).collect() == []
    two = nearest_of_all(spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, None)], schema), 3).collect()
    assert sorted(map(tuple, two)) == [(1, 1, 2, 0.0), (2, 1, 1, 0.0)]


def test_nearest_join_is_no_cross_join(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    text = nearest_of_all(frame, 2, id_column="vec_id", vector_column="embedding")._jdf.queryExecution().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert word not in text


def test_nearest_without_clusters_are_compared_as_matrices(spark):
    """No row per compared pair and no interpreted products, where pivots part nothing."""
    draw = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(draw.normal(size=(3000, 16)))]
    frame = spark.createDataFrame(rows, "item_id long, vector array<float>")
    result = nearest_of_all(frame, 4, digits=5, block_rows=700)
    text = result._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" not in text
    singles = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows]
    units = np.array([v for _, v in singles])
    units /= np.linalg.norm(units, axis=1)[:, None]
    cosines = units @ units.T
    np.fill_diagonal(cosines, -2)
    best = -np.sort(-cosines, axis=1)[:, :4]
    found = result.collect()
    assert len(found) == 4 * len(rows)
    assert all(abs(r.similarity - best[r.item_id, r.position - 1]) <= 1e-5 for r in found)
    assert all(abs(r.similarity - cosines[r.item_id, r.other_id]) <= 1e-5 for r in found)
    assert len({(r.item_id, r.other_id) for r in found}) == len(found)


def test_nearest_in_blocks_are_those_of_one_block(spark):
    draw = np.random.default_rng(6)
    rows = [(i, (draw.normal(size=4) + 3 * (i % 5)).round(1).tolist()) for i in range(400)]
    rows += [(500, [float("nan"), 1.0, 0.0, 0.0]), (501, [1.0, None, 0.0, 0.0]), (None, [1.0, 0.5, 0.0, 0.0])]
    rows += rows[:30]  # rows that come twice
    frame = spark.createDataFrame(rows, "item_id long, vector array<double>")
    once, cut = (
        [tuple(map(repr, r)) for r in nearest_of_all(frame, 3, pivots=5, block_rows=n).collect()] for n in (1000, 60)
    )
    assert sorted(once) == sorted(cut)
    # A cosine that is no number is the first in descending order, as in SQL.
    assert {r[2] for r in once if r[1] == "1" and r[0] not in ("500", "None")} == {"500"}
