"""Similar pairs and neighbours against brute force on small catalogues."""

from __future__ import annotations

import math
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from affinia.operators import neighbours, pairs
from affinia.operators.features import build_hashed_vectors, build_vectors
from affinia.operators.neighbours import similar_items, top_k_neighbours, top_k_of_edges
from affinia.operators.pairs import (
    build_index,
    score_pairs,
    similar_pairs,
    write_similar_pairs,
)
from affinia.sources.workspace import fresh_path

SCHEMA = "item_id BIGINT, title STRING, genres ARRAY<STRING>, rating DECIMAL(4,2), persons ARRAY<STRING>"


def catalogue(seed: int = 7, size: int = 60) -> list[tuple]:
    """A third of the items are copies; one genre is in most items, one in all."""
    draw = random.Random(seed)
    rows = []
    for item in range(1, size + 1):
        if item % 3 == 0:
            rows.append((item, "Copied", ["All", "Most"], Decimal("7.00"), ["Ann", "Bob"]))
            continue
        genres = ["All"] + (["Most"] if draw.random() < 0.7 else []) + draw.sample(
            ["Drama", "War", "Noir"], draw.randint(0, 2)
        )
        rows.append(
            (
                item,
                draw.choice(["One", "Two, too", "Three", None]),
                genres,
                Decimal(draw.choice(["6.00", "7.00", "8.50"])),
                draw.sample(["Ann", "Bob", "Cy", "Di", "Ed", "Flo", "Gus"], draw.randint(1, 4)),
            )
        )
    return rows


def tokens_of(row) -> list[str]:
    parts = [p for p in (row[1], *row[2], str(row[3]), *row[4]) if p is not None]
    return ", ".join(parts).split(",")


def brute_force(rows) -> dict[tuple[int, int], float]:
    bags = {row[0]: Counter(tokens_of(row)) for row in rows}
    df = Counter(token for bag in bags.values() for token in bag)
    count = len(rows)
    units = {}
    for item, bag in bags.items():
        raw = {t: n * math.log((count + 1) / (df[t] + 1)) for t, n in bag.items()}
        length = math.sqrt(sum(w * w for w in raw.values()))
        units[item] = {t: w / length if length else 0.0 for t, w in raw.items()}
    return {
        (a, b): sum(w * units[b].get(t, 0.0) for t, w in units[a].items())
        for a in units
        for b in units
        if a < b
    }


def table(frame) -> dict[tuple[int, int], float]:
    found = frame.collect()
    result = {(r["item_id"], r["other_id"]): r["similarity"] for r in found}
    assert len(result) == len(found)
    return result


def same(left: dict, right: dict) -> None:
    assert set(left) == set(right)
    assert all(math.isclose(left[k], right[k], abs_tol=1e-8) for k in left)


@pytest.fixture(scope="module")
def rows():
    return catalogue()


@pytest.fixture(scope="module")
def truth(rows):
    return brute_force(rows)


@pytest.fixture(scope="module")
def items(spark, rows):
    from affinia.sources.workspace import staged

    return staged(spark.createDataFrame(rows, SCHEMA), "items")


@pytest.fixture(scope="module")
def vectors(items):
    return build_vectors(items)


def test_copies_are_folded(vectors):
    assert vectors.items == 60
    assert vectors.frame.where("copies >= 20").count() == 1


@pytest.mark.parametrize("frequent_rows", [1, 4, 12, 4096])
@pytest.mark.parametrize("threshold", [0.05, 0.4, 0.9])
def test_pairs_are_exact(vectors, truth, threshold, frequent_rows):
    index = build_index(vectors, threshold, frequent_rows=frequent_rows)
    same(table(index.edges()), {k: s for k, s in truth.items() if s >= threshold})


def test_copies_spread_over_slots(vectors, truth, monkeypatch):
    monkeypatch.setattr(pairs, "COPIES_PER_SLOT", 4)
    monkeypatch.setattr(neighbours, "COPIES_PER_SLOT", 4)
    index = build_index(vectors, 0.3)
    same(table(index.edges()), {k: s for k, s in truth.items() if s >= 0.3})
    check_top_k(top_k_neighbours(index, 5, threshold=0.3), truth, 5, 0.3)


def test_frequent_tokens_only(spark):
    """Vectors made of frequent tokens alone still find each other."""
    draw = random.Random(3)
    made = [
        (i, None, draw.sample(["A", "B", "C", "D"], draw.randint(1, 3)), None, [])
        for i in range(1, 41)
    ]
    frame = spark.createDataFrame(made, SCHEMA)
    bags = [(r[0], None, r[2], None, r[4]) for r in made]
    truth = brute_force_without_rating(bags)
    index = build_index(build_vectors(frame), 0.5, frequent_rows=2)
    same(table(index.edges()), {k: s for k, s in truth.items() if s >= 0.5 - 1e-12})


def brute_force_without_rating(rows):
    bags = {r[0]: Counter(", ".join([*r[2], *r[4]]).split(",")) for r in rows}
    df = Counter(t for bag in bags.values() for t in bag)
    units = {}
    for item, bag in bags.items():
        raw = {t: n * math.log((len(rows) + 1) / (df[t] + 1)) for t, n in bag.items()}
        length = math.sqrt(sum(w * w for w in raw.values()))
        units[item] = {t: w / length for t, w in raw.items()}
    return {
        (a, b): round(sum(w * units[b].get(t, 0.0) for t, w in units[a].items()), 9)
        for a in units for b in units if a < b
    }


def check_top_k(found, truth, k, threshold):
    near = {}
    for (a, b), score in truth.items():
        if score >= threshold:
            near.setdefault(a, []).append((-round(score, 9), b))
            near.setdefault(b, []).append((-round(score, 9), a))
    expected = {
        (item, position): other
        for item, others in near.items()
        for position, (_, other) in enumerate(sorted(others)[:k], start=1)
    }
    got = {(r["item_id"], r["position"]): r["other_id"] for r in found.collect()}
    assert got == expected


def test_top_k_with_and_without_the_index(vectors, truth):
    index = build_index(vectors, 0.1)
    check_top_k(top_k_neighbours(index, 3, threshold=0.2), truth, 3, 0.2)
    check_top_k(top_k_neighbours(index, 30, threshold=0.1), truth, 30, 0.1)
    check_top_k(top_k_of_edges(index.edges(), 3, threshold=0.2), truth, 3, 0.2)


def test_threshold_equal_to_a_score_is_kept(vectors, truth):
    score = sorted({round(s, 9) for s in truth.values() if 0 < s < 0.999})[10]
    found = table(build_index(vectors, score).edges())
    assert any(math.isclose(s, score, abs_tol=1e-9) for s in found.values())
    same(found, {k: s for k, s in truth.items() if round(s, 9) >= score})


def test_threshold_must_be_positive(vectors):
    for bad in (0, -0.5, 1.5):
        with pytest.raises(ValueError):
            build_index(vectors, bad)


def test_scores_are_between_zero_and_one(vectors):
    low, high = (
        build_index(vectors, 1e-6).links.agg(F.min("similarity"), F.max("similarity")).first()
    )
    assert low >= 0 and high <= 1 + 1e-9


def test_score_pairs_gives_zeros_and_any_order(spark, vectors, truth):
    asked = [(a, b) for a, b in list(truth)[:200]] + [(50, 2)]
    frame = spark.createDataFrame(asked, "item_id BIGINT, other_id BIGINT")
    expected = {pair: truth[pair] for pair in asked[:200]}
    expected[(50, 2)] = truth[(2, 50)]
    same(table(score_pairs(vectors, frame)), expected)


def test_score_of_an_unknown_item_is_null(spark, vectors):
    frame = spark.createDataFrame([(1, 999), (999, 1), (998, 999)], "item_id BIGINT, other_id BIGINT")
    assert [r["similarity"] for r in score_pairs(vectors, frame).collect()] == [None] * 3


def test_token_in_every_item_weighs_nothing(spark):
    rows = [(1, "X", [], None, []), (2, "X", [], None, []), (3, "X", ["Y"], None, [])]
    frame = spark.createDataFrame(rows, SCHEMA)
    vectors = build_vectors(frame)
    assert similar_pairs(frame, 0.01).count() == 0
    asked = spark.createDataFrame([(1, 2), (1, 3)], "item_id BIGINT, other_id BIGINT")
    assert {r["similarity"] for r in score_pairs(vectors, asked).collect()} == {0.0}


def test_hashed_tokens_give_the_same_pairs(items, truth):
    found = table(build_index(build_hashed_vectors(items), 0.3).edges())
    same(found, {k: s for k, s in truth.items() if s >= 0.3})


@pytest.fixture(scope="module")
def edges(vectors):
    return build_index(vectors, 0.05).edges()


def test_directions(items, edges, truth):
    wanted = 60
    both = {b if a == wanted else a for (a, b), s in truth.items() if wanted in (a, b) and s >= 0.3}
    found = similar_items(items, edges, wanted, threshold=0.3, k=None)
    assert {r["other_id"] for r in found.collect()} == both
    assert similar_items(items, edges, wanted, threshold=0.3, direction="stored").isEmpty()
    with pytest.raises(ValueError):
        similar_items(items, edges, wanted, direction="up")


def test_best_ten_with_ties_by_id(items, edges, truth):
    near = sorted(
        (-round(s, 9), b if a == 3 else a) for (a, b), s in truth.items() if 3 in (a, b)
    )[:10]
    found = similar_items(items, edges, 3)
    assert [r["other_id"] for r in found.collect()] == [other for _, other in near]


def test_threshold_zero_lists_every_other_item(items, edges, vectors, truth):
    found = similar_items(items, edges, 1, threshold=0, k=None, vectors=vectors).collect()
    scores = {b if a == 1 else a: s for (a, b), s in truth.items() if 1 in (a, b)}
    assert len(found) == 59
    assert all(abs(r["similarity"] - scores.get(r["other_id"], 0.0)) < 1e-6 for r in found)
    assert similar_items(items, edges, 999, threshold=0, vectors=vectors).isEmpty()
    with pytest.raises(ValueError):
        similar_items(items, edges, 1, threshold=0)
    assert similar_items(items, edges, 999).isEmpty()


def test_lower_thresholds_than_stored_are_refused_or_scored(spark, vectors, items, truth):
    index = build_index(vectors, 0.5)
    path = fresh_path(spark, "edges")
    index.edges().write.parquet(path)
    stored = spark.read.parquet(path)
    for call in (
        lambda: similar_items(items, stored, 3, threshold=0.2),
        lambda: top_k_of_edges(stored, 3, threshold=0.2),
        lambda: top_k_neighbours(index, 3, threshold=0.2),
    ):
        with pytest.raises(ValueError):
            call()
    found = similar_items(items, stored, 3, threshold=0.2, k=None, vectors=vectors).collect()
    near = {b if a == 3 else a for (a, b), s in truth.items() if 3 in (a, b) and s >= 0.2}
    assert {r["other_id"] for r in found} == near


def test_left_join_keeps_unknown_neighbours(items, edges):
    some = items.where("item_id % 2 = 1")
    inner = similar_items(some, edges, 3, k=None).count()
    left = similar_items(some, edges, 3, k=None, how="left")
    assert left.count() > inner
    assert left.where("item_id IS NULL").count() == left.count() - inner


def test_pair_table_is_written_once(spark, items):
    path = fresh_path(spark, "edges")
    assert write_similar_pairs(items, path, 0.3) is True
    assert write_similar_pairs(items, path, 0.3) is False
    first = spark.read.parquet(path)
    assert first.columns == ["item_id", "other_id", "similarity"]
    assert first.count() > 0


def test_limit_of_usual_tokens_follows_the_cost(vectors, truth, monkeypatch):
    """The dearer scoring is, the more tokens are summed; results stay the same."""
    monkeypatch.setattr(pairs, "CELL_ROWS", 3)
    chosen = []
    for cost in (0, 1, 1_000_000):
        monkeypatch.setattr(pairs, "SCORING_COST", cost)
        reach = pairs._reach(vectors, 0.25)
        chosen.append(pairs._plan_effort(vectors.vocabulary, reach, None))
        index = build_index(vectors, 0.25)
        same(table(index.edges()), {k: s for k, s in truth.items() if s >= 0.25})
    assert chosen[0].meetings <= chosen[1].meetings < chosen[2].meetings
    assert chosen[0].any_frequent and not chosen[2].any_frequent


def test_bands_never_part_a_pair_that_reaches_the_threshold(spark):
    for floor in (0.05, 0.3, 0.5, 0.98, 0.995):
        last = pairs._last_band(floor)
        heads = spark.range(1, 1001).select((F.col("id") / 1000).alias("head")).where(
            F.col("head") >= floor
        )
        banded = [(r[0], r[1]) for r in heads.select("head", pairs._band(floor)).collect()]
        for head, band in banded:
            for other, other_band in banded:
                assert head * other < floor or band + other_band <= last
