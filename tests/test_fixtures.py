"""Hand-made edge rows."""

from __future__ import annotations

import gzip
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from affinia.functions import predicates as P
from affinia.functions.tokens import comma_list, first_element, joined, numeric_id
from affinia.operators.features import item_tokens
from affinia.operators.layout import partition_by_category, with_category
from affinia.operators.profiles import build_profiles
from affinia.operators.quality import split_valid
from affinia.operators.search import (
    SearchSpec,
    lookup,
    lookup_many,
    lookup_missing,
    search_items,
)
from affinia.operators.summary import bernoulli_sample, count_present, keyed_sample
from affinia.plans.jobs import prepare_categories, prepare_items, prepare_similarity, publish
from affinia.sources.columnar import read_category, read_parquet
from affinia.sources.delimited import read_catalogue_files
from affinia.sources.workspace import fresh_path

ITEM_SCHEMA = (
    "item_id INT, title STRING, year DATE, duration INT, genres ARRAY<STRING>, "
    "rating DECIMAL(4,2), vote_count INT, persons ARRAY<STRING>"
)


def item(item_id=1, title="Some Title", year=date(1990, 1, 1), duration=100, genres=("Drama",),
         rating="7.00", votes=600, persons=("Ann",)):
    return (
        item_id, title, year, duration, None if genres is None else list(genres),
        None if rating is None else Decimal(rating), votes,
        None if persons is None else list(persons),
    )


@pytest.fixture(scope="module")
def items(spark):
    rows = [
        item(1, "Home, Alone", genres=("Comedy", "Family"), persons=("Macaulay C", "O'Brien")),
        item(2, "Home Again", date(1992, 1, 1), 90, ("Comedy",), "6.10", 500, ("ab", "cd")),
        item(3, "Far Away", date(1979, 1, 1), 140, ("Drama", "War"), "8.00", 9000, ("Ann",)),
        item(4, "Far Away", date(2000, 1, 1), 60, ("War",), "6.00", 700, ("Ann", "Bob")),
        item(5, "Zero", date(2001, 1, 1), 80, (), "0.00", 0, ()),
    ]
    return spark.createDataFrame(rows, ITEM_SCHEMA)


def ids(frame):
    return [r["item_id"] for r in frame.collect()]


# Files and profiles


def write_gz(path, header, rows):
    with gzip.open(path, "wt") as out:
        out.write("\t".join(header) + "\n")
        for row in rows:
            out.write("\t".join(row) + "\n")


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    none = "\\N"
    title_row = lambda t, kind, name, year, minutes, genres: (
        t, kind, name, name, "0", year, none, minutes, genres
    )
    write_gz(
        folder / "title.basics.tsv.gz",
        "tconst titleType primaryTitle originalTitle isAdult startYear endYear runtimeMinutes "
        "genres".split(),
        [
            title_row("tt0000001", "movie", '"Open quote', "1990", "100", "A , B,C"),
            title_row("tt0000002", "movie", "At the bound", "1991", "90", "A"),
            title_row("tt0000003", "movie", "Rating below", "1991", "90", "A"),
            title_row("tt0000004", "movie", "Votes below", "1991", "90", "A"),
            title_row("tt0000005", "movie", "No genres", "1991", "90", none),
            title_row("tt0000006", "movie", "No duration", "1991", none, "A"),
            title_row("tt0000007", "short", "A short", "1991", "9", "A"),
            title_row("tt0000008", "movie", "No credits", "1991", "90", "A"),
            title_row("tt0000009", "movie", "No rating", "1991", "90", "A"),
            title_row("tt0000010", "movie", "Year missing", none, "90", "A"),
        ],
    )
    write_gz(
        folder / "title.ratings.tsv.gz",
        ["tconst", "averageRating", "numVotes"],
        [
            (f"tt{i:07d}", "5.99" if i == 3 else "6.00", "499" if i == 4 else "500")
            for i in (1, 2, 3, 4, 5, 6, 7, 8, 10)
        ],
    )
    credited = [i for i in range(1, 11) if i != 8]
    write_gz(
        folder / "title.principals.tsv.gz",
        "tconst ordering nconst category job characters".split(),
        [
            (f"tt{i:07d}", str(n), person, none, none, none)
            for i in credited
            for n, person in enumerate(("nm2", "nm1", "nm2", "nm9"))
        ],
    )
    write_gz(
        folder / "name.basics.tsv.gz",
        "nconst primaryName birthYear deathYear primaryProfession knownForTitles".split(),
        [("nm1", "Ann", "1950", none, none, none), ("nm2", "Bob", none, none, none, none)],
    )
    return str(folder)


def test_profiles_from_compressed_files(spark, files):
    found = build_profiles(read_catalogue_files(spark, files)).orderBy("item_id").collect()
    assert [r["item_id"] for r in found] == [1, 2, 10]
    first = found[0]
    assert first["title"] == '"Open quote'
    assert first["year"] == date(1990, 1, 1)
    assert first["genres"] == ["A", "B", "C"]
    assert first["rating"] == Decimal("6.00")
    assert first["persons"] == ["Ann", "Bob"]
    assert found[2]["year"] is None


def test_jobs_end_to_end(spark, files):
    items_path, parts, edges = (fresh_path(spark, n) for n in ("items", "genres", "edges"))
    prepare_items(spark, files, items_path)
    prepare_categories(spark, items_path, parts)
    assert prepare_similarity(spark, items_path, edges) is True
    assert prepare_similarity(spark, items_path, edges) is False
    assert sorted(ids(read_category(spark, parts, "A"))) == [1, 2, 10]
    assert ids(read_category(spark, parts, "C")) == [1]
    assert read_category(spark, parts, "C").columns == read_parquet(spark, items_path).columns
    items_table, edges_table = publish(spark, items_path, edges)
    assert items_table.count() == 3
    assert edges_table.columns == ["item_id", "other_id", "similarity"]


# Expressions


def test_numeric_id(spark):
    frame = spark.createDataFrame([("tt0000001",), ("ttx",), (None,)], "id STRING")
    assert [r[0] for r in frame.select(numeric_id("id", "tt")).collect()] == [1, None, None]


def test_lists(spark):
    frame = spark.createDataFrame([("A , B,C", []), (None, ["x", None, "y"])], "t STRING, a ARRAY<STRING>")
    found = frame.select(
        comma_list("t").alias("list"), first_element("a").alias("first"), joined("a", ",").alias("j")
    ).collect()
    assert found[0]["list"] == ["A", "B", "C"] and found[0]["first"] is None
    assert found[1]["list"] is None and found[1]["first"] == "x" and found[1]["j"] == "x,y"


def test_feature_tokens(spark):
    rows = [item(1, "Home, Alone", persons=("P Q",)), item(2, None), item(3, "A", rating=None)]
    found = item_tokens(spark.createDataFrame(rows, ITEM_SCHEMA)).orderBy("item_id").collect()
    assert found[0]["features"] == ["Home", " Alone", " Drama", " 7.00", " P Q"]
    assert found[1]["features"] == ["Drama", " 7.00", " Ann"]
    assert found[2]["features"] == ["A", " Drama", " Ann"]


def test_array_predicates(items):
    assert ids(items.where(P.any_element_matches("persons", "b.*C"))) == [2]
    assert ids(items.where(P.has_all("persons", ["Ann", "Bob"]))) == [4]
    assert ids(items.where(P.has_any("persons", ["Ann", "Bob"]))) == [3, 4]
    assert ids(items.where(~P.has_value("genres", "War"))) == [1, 2, 5]
    assert ids(items.where(P.element_equals("persons", "O'Brien"))) == [1]
    assert ids(items.where(P.match_count("persons", "(?i)an|bo") >= 2)) == [4]
    assert ids(items.where(P.has_all("genres", []))) == [1, 2, 3, 4, 5]
    assert ids(items.where(P.has_any("genres", []))) == []


# Search and lookup


def test_search_by_each_criterion(items):
    cases = [
        (SearchSpec(title="^far"), [3, 4]),
        (SearchSpec(earliest_date="1990-01-01", latest_date=date(1992, 1, 1)), [2, 1]),
        (SearchSpec(min_duration=90, max_duration=100), [2, 1]),
        (SearchSpec(genre="fam"), [1]),
        (SearchSpec(genres=["Drama", "War"]), [3]),
        (SearchSpec(min_rating="6.00", max_rating="6.10"), [4, 2]),
        (SearchSpec(max_rating=0), [5]),
        (SearchSpec(min_rating=0), [3, 4, 2, 1, 5]),
        (SearchSpec(vote_count=700), [3, 4]),
        (SearchSpec(person="o'b"), [1]),
        (SearchSpec(persons=["Ann"]), [3, 4]),
        (SearchSpec(), [3, 4, 2, 1, 5]),
        (SearchSpec(title="far", genres=["War"], vote_count=1000), [3]),
    ]
    for spec, expected in cases:
        assert ids(search_items(items, spec)) == expected, spec


def test_search_limit_and_score(items):
    found = search_items(items, SearchSpec(), limit=2)
    assert ids(found) == [3, 4]
    assert {r["similarity"] for r in found.collect()} == {1.0}
    assert search_items(items, SearchSpec(), limit=None).count() == 5


@pytest.mark.parametrize(
    "bad",
    [
        {"title": "x" * 129},
        {"earliest_date": date(1879, 12, 31)},
        {"latest_date": date(2030, 1, 2)},
        {"min_duration": 0},
        {"min_duration": 240},
        {"max_duration": 9},
        {"max_duration": 300},
        {"genre": "x" * 25},
        {"genres": ["a"] * 6},
        {"min_rating": "-0.1"},
        {"min_rating": "10.01"},
        {"max_rating": "9.999"},
        {"vote_count": -1},
        {"person": "x" * 33},
        {"persons": ["a"] * 6},
    ],
)
def test_search_bounds(bad):
    with pytest.raises(ValueError, match=next(iter(bad))):
        SearchSpec(**bad)


def test_lookup(spark, items):
    assert ids(lookup(items, 3)) == [3]
    assert ids(lookup(items, 33)) == []
    wanted = spark.createDataFrame([(1,), (4,), (4,), (77,)], "item_id INT")
    assert sorted(ids(lookup_many(items, wanted))) == [1, 4]
    assert ids(lookup_missing(items, wanted)) == [77]


# Layout, quality, summaries


def test_empty_category_list(spark, items):
    path = fresh_path(spark, "genres")
    partition_by_category(items, path, mode="first")
    assert ids(read_category(spark, path, None)) == [5]
    assert with_category(items, mode="all").where("genre IS NULL").count() == 1
    with pytest.raises(ValueError):
        with_category(items, mode="last")


def test_rows_are_sorted_inside_a_category(spark):
    rows = [item(i, persons=(name,)) for i, name in enumerate("dbeca")]
    path = fresh_path(spark, "sorted")
    partition_by_category(spark.createDataFrame(rows, ITEM_SCHEMA).repartition(5), path)
    names = [r["persons"][0] for r in spark.read.parquet(path).collect()]
    assert names == sorted(names)


def test_constraints(spark):
    wide = ITEM_SCHEMA.replace("DECIMAL(4,2)", "DECIMAL(6,3)")
    rows = [
        item(1),
        item(2, title="Up"),
        item(3, title="x" * 129),
        item(4, duration=300),
        item(5, duration=0),
        item(6, genres="abcdef"),
        item(7, rating="10.01"),
        item(8, rating="7.123"),
        item(9, votes=-1),
        item(10, persons=["p"] * 51),
        item(11, year=None),
        item(12, title="Up", year=None),
        item(13, title="Abc", duration=299, genres="abcde", rating="10", votes=0, persons=["p"] * 50),
    ]
    valid, rejected = split_valid(spark.createDataFrame(rows, wide))
    assert ids(valid) == [1, 13]
    assert {r["item_id"]: r["violations"] for r in rejected.collect()} == {
        2: ["title_length"],
        3: ["title_length"],
        4: ["duration_range"],
        5: ["duration_range"],
        6: ["too_many_genres"],
        7: ["rating_range"],
        8: ["rating_range"],
        9: ["negative_votes"],
        10: ["too_many_persons"],
        11: ["year_missing"],
        12: ["year_missing", "title_length"],
    }


def test_null_group_counts_nothing(spark):
    frame = spark.createDataFrame([("a",), ("a",), (None,)], "genre STRING")
    assert {r["genre"]: r["n"] for r in count_present(frame, "genre").collect()} == {"a": 2, None: 0}


def test_samples(spark):
    frame = spark.range(20_000).withColumnRenamed("id", "item_id")
    assert bernoulli_sample(frame, 0.1, 2).count() == bernoulli_sample(frame, 0.1, 2).count()
    keyed = keyed_sample(frame, "item_id", 0.1, 2)
    again = keyed_sample(frame.repartition(3), "item_id", 0.1, 2)
    assert 1_700 < keyed.count() < 2_300
    assert keyed.exceptAll(again).isEmpty()
    assert keyed.select(F.countDistinct("item_id")).first()[0] == keyed.count()
