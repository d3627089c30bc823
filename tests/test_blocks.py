"""The join of vectors over blocks, and counts of pairs without writing them out."""

from __future__ import annotations

import glob
import math
import os
import random
import re
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from affinia.operators import pairs
from affinia.operators.best import best_neighbours
from affinia.operators.features import build_vectors, item_weights
from affinia.operators.pairs import build_index, pairs_by_score
from affinia.sources.workspace import work_root

SCHEMA = "item_id BIGINT, title STRING, genres ARRAY<STRING>, rating DECIMAL(4,2), persons ARRAY<STRING>"


def rows_of(seed: int, size: int) -> list[tuple]:
    draw = random.Random(seed)
    return [(i, None, [], None, draw.sample([f"P{n}" for n in range(12)], 4)) for i in range(size)]


def scores_of(vectors) -> dict[tuple[int, int], float]:
    units = {}
    for r in item_weights(vectors).collect():
        units.setdefault(r.item_id, {})[r.token_id] = r.weight
    return {
        (a, b): round(sum(w * units[b].get(t, 0.0) for t, w in units[a].items()), 9)
        for a in units for b in units if a < b
    }


def test_every_two_blocks_meet_once(spark, monkeypatch):
    rows = rows_of(5, 70)
    vectors = build_vectors(spark.createDataFrame(rows, SCHEMA))
    truth = scores_of(vectors)
    monkeypatch.setattr(pairs, "CELL_ROWS", 20)
    monkeypatch.setattr(pairs, "SUMS", 50)
    for frequent_rows in (1, 22, 4096):
        found = build_index(vectors, 0.5, frequent_rows=frequent_rows).edges().collect()
        assert len(found) == len({(r.item_id, r.other_id) for r in found})
        expected = {pair: s for pair, s in truth.items() if s >= 0.5}
        assert {(r.item_id, r.other_id): round(r.similarity, 7) for r in found} == {
            pair: round(s, 7) for pair, s in expected.items()
        }
    best = best_neighbours(vectors, 3, frequent_rows=22).collect()
    for r in best:
        ranked = sorted(
            (-s, b if a == r.item_id else a) for (a, b), s in truth.items() if r.item_id in (a, b) and s > 0
        )
        assert round(-ranked[r.position - 1][0], 7) == round(r.similarity, 7)
    assert len(best) == 3 * len(rows)


def test_meetings_are_not_written(spark):
    """Vectors that all share a token, and no pair of them that reaches the threshold."""
    size = 300
    rows = [(i, None, [], None, ["All", f"A{i // 2}", f"B{i}", f"C{i}"]) for i in range(size)]
    rows += [(size + i, None, [], None, [f"Z{i}"]) for i in range(size)]
    vectors = build_vectors(spark.createDataFrame(rows, SCHEMA))
    text = pairs.similar_vectors(vectors, 0.9, frequent_rows=1)._jdf.queryExecution().toString()
    assert "hashpartitioning(token_id" not in text
    before = set(glob.glob(f"{work_root(spark)}/*"))
    index = build_index(vectors, 0.9, frequent_rows=1)
    assert index.edges().count() == 0
    made = set(glob.glob(f"{work_root(spark)}/*")) - before
    assert not [path for path in made if os.path.basename(path).startswith(("cells", "rests"))]


def test_pairs_by_score_counts_what_edges_hold(spark, monkeypatch):
    draw = random.Random(2)
    rows = [
        (i, draw.choice(["T", "U", "V"]), draw.sample(["A", "B", "C"], 2), None, []) for i in range(60)
    ]
    rows += rows[:7] + rows[:2]  # ids may repeat
    frame = spark.createDataFrame(rows, SCHEMA)
    index = build_index(build_vectors(frame, ("title", "genres")), 0.1, digits=6)
    expected = index.edges().groupBy("similarity").agg(
        F.count("*").alias("n"), F.min("item_id").alias("first_item"), F.max("other_id").alias("last_other")
    ).collect()
    counted = pairs_by_score(index)
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, expected))
    monkeypatch.setattr(pairs, "_write_out_copies", None)
    assert pairs_by_score(index).count() == len(expected) > 1


def test_a_vector_is_sent_no_more_often_than_cores_and_memory_ask_for(spark, monkeypatch):
    """Every block more is one more copy of all vectors on disk."""
    vectors = build_vectors(spark.createDataFrame(rows_of(3, 300), SCHEMA))
    monkeypatch.setattr(pairs, "LEAST_CELL_ROWS", 1)
    cores = spark.sparkContext.defaultParallelism
    text = pairs.score_in_blocks(vectors, 0.5, 4096)._jdf.queryExecution().analyzed().toString()
    blocks = int(re.search(r"xxhash64\(vector_id#\d+L?, 42\), cast\((\d+) as bigint", text).group(1))
    assert blocks <= math.ceil((4 * cores) ** 0.5)


def test_sums_that_are_not_met_cost_nothing():
    """5,000 rows and 200,000 vectors of an index that meet once a row, not 10^9 times."""
    rows, width = 5_000, 200_000

    def side(number: int, count: int, first_id: int) -> list[pa.RecordBatch]:
        made = {
            "cell": pa.array(np.ones(count, np.int32)), "side": pa.array(np.full(count, number, np.int32)),
            "own": pa.array(np.zeros(count, bool)), "vector_id": pa.array(np.arange(count) + first_id),
            "floor": pa.array(np.full(count, 0.9)), "tokens": pa.array([[i] for i in range(count)], pa.list_(pa.int64())),
            "weights": pa.array([[1.0]] * count, pa.list_(pa.float64())),
        }
        made |= {name: pa.array(np.ones(count, np.int32)) for name in ("first", "rare", "usual")}
        return [pa.RecordBatch.from_pydict(made)]

    score = pairs.multiplying(None, 6, pairs.SUMS, pairs.CELL_ROWS, pairs.CELL_ENTRIES)
    batches = side(0, width, 10**6) + side(1, rows, 0)
    begun = time.process_time()
    found = sum(batch.num_rows for batch in score(iter(batches)))
    assert found == rows
    assert time.process_time() - begun < rows * width * 4e-9


def test_frequent_tokens_are_added_pair_by_pair(spark, monkeypatch):
    """Lists that are too long to be gone over still count in every score."""
    draw = random.Random(11)
    rows = [
        (i, None, draw.sample(["G1", "G2", "G3", "G4", "G5"], 3), None, draw.sample([f"P{n}" for n in range(25)], 3))
        for i in range(90)
    ]
    vectors = build_vectors(spark.createDataFrame(rows, SCHEMA))
    truth = scores_of(vectors)
    monkeypatch.setattr(pairs, "CELL_ROWS", 40)
    for listed, sums in ((4, 1 << 21), (12, 1 << 21), (12, 100)):
        monkeypatch.setattr(pairs, "FREQUENT_ROWS", listed)
        monkeypatch.setattr(pairs, "SUMS", sums)
        found = {(r.item_id, r.other_id): r.similarity for r in build_index(vectors, 0.4).edges().collect()}
        assert {k: round(s, 7) for k, s in found.items()} == {k: round(s, 7) for k, s in truth.items() if s >= 0.4}
        ranked = {(r.item_id, r.position): r.similarity for r in best_neighbours(vectors, 4, frequent_rows=listed).collect()}
        for (item, position), score in ranked.items():
            scores = sorted((-s for pair, s in truth.items() if item in pair and s > 0))
            assert round(-scores[position - 1], 7) == round(score, 7)
        assert len(ranked) == 4 * len(rows)


def test_only_the_best_of_all_blocks_leave_a_task(spark, monkeypatch):
    vectors = build_vectors(spark.createDataFrame(rows_of(5, 70), SCHEMA))
    monkeypatch.setattr(pairs, "CELL_ROWS", 20)
    left = pairs.score_in_blocks(vectors, 1e-9, 4096, best=3).groupBy("vector_id").count()
    assert left.where("count > 3").isEmpty()
