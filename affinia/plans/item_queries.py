"""Registered queries: predicates, search, lookup, summaries and row constraints."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.functions import predicates as P
from affinia.functions.tokens import first_element, joined
from affinia.operators.profiles import keep_item
from affinia.operators.quality import split_valid, with_violations
from affinia.operators.search import (
    SearchSpec,
    lookup,
    lookup_many,
    lookup_missing,
    search_items,
)
from affinia.operators.summary import (
    average_by,
    bernoulli_sample,
    count_by,
    count_present,
    distinct_values,
    keyed_sample,
    row_count,
    top_rated,
)
from affinia.plans.bindings import ITEMS_SQL, credits, flat, items, ratings, table, titles

Query = Callable[[SparkSession, str], DataFrame]


def _where(*conditions: Callable[[], Column]) -> Query:
    """Columns need a running session, so each condition is built inside the query."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return flat(items(spark, folder).where(P.all_of(build() for build in conditions)))

    return run


def _where_sql(condition: str) -> str:
    return f"""
WITH {ITEMS_SQL}
SELECT flat_items.* FROM flat_items JOIN items USING (item_id) WHERE {condition}
"""


def _search(spec: SearchSpec) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return flat(search_items(items(spark, folder), spec))

    return run


def _search_sql(condition: str) -> str:
    return f"""
WITH {ITEMS_SQL}
SELECT flat_items.*, CAST(1.0 AS DOUBLE) AS similarity
FROM flat_items JOIN items USING (item_id) WHERE {condition}
ORDER BY flat_items.title, item_id LIMIT 100
"""


FULL_SPEC = SearchSpec(
    title="^(red|old|small).*g",
    earliest_date=date(1995, 1, 1),
    latest_date=date(1996, 12, 31),
    min_duration=5,
    max_duration=48,
    genre="RING|GE.R",
    genres=("red",),
    min_rating=Decimal("3.2"),
    max_rating=Decimal("9.99"),
    vote_count=20,
    person="supplier#0+1",
    persons=("Supplier#000000003",),
)
FULL_SPEC_SQL = """
regexp_matches(items.title, '(?i)^(red|old|small).*g')
AND items.year >= DATE '1995-01-01' AND items.year <= DATE '1996-12-31'
AND items.duration >= 5 AND items.duration <= 48
AND regexp_matches(array_to_string(items.genres, ','), '(?i)RING|GE.R')
AND list_has_all(items.genres, ['red'])
AND items.rating >= 3.2 AND items.rating <= 9.99 AND items.vote_count >= 20
AND regexp_matches(array_to_string(items.persons, ','), '(?i)supplier#0+1')
AND list_has_all(items.persons, ['Supplier#000000003'])
"""


def item_filter(spark: SparkSession, folder: str) -> DataFrame:
    rated = titles(spark, folder).join(ratings(spark, folder), "title_id")
    return flat(rated.where(keep_item("PROMO", "5", 30)))


ITEM_FILTER_SQL = f"""
WITH {ITEMS_SQL}
SELECT item_id AS title_id, p_type AS kind, title, duration, genres, year, rating, vote_count
FROM flat_items JOIN part ON p_partkey = item_id
WHERE p_type = 'PROMO' AND genres IS NOT NULL AND rating >= 5 AND vote_count >= 30
  AND duration IS NOT NULL
"""


def credits_in_set(spark: SparkSession, folder: str) -> DataFrame:
    return credits(spark, folder).where(P.one_of("job", ["A", "R"]))


def early_credits(spark: SparkSession, folder: str) -> DataFrame:
    return credits(spark, folder).where(P.early_credit("N", 3))


CREDITS_SQL = """
SELECT l_partkey AS title_id, l_linenumber AS ordering, l_suppkey AS person_id,
       l_returnflag AS job
FROM lineitem WHERE {condition}
"""


def match_counts(spark: SparkSession, folder: str) -> DataFrame:
    return items(spark, folder).select(
        "item_id",
        joined("persons", ",").alias("persons"),
        P.match_count("persons", "(?i)supplier#0*[12]").cast("bigint").alias("hits"),
    )


MATCH_COUNTS_SQL = f"""
WITH {ITEMS_SQL}
SELECT item_id, array_to_string(persons, ',') AS persons,
       len(regexp_extract_all(array_to_string(persons, ','), '(?i)supplier#0*[12]')) AS hits
FROM items
"""


def lookup_item(spark: SparkSession, folder: str) -> DataFrame:
    return flat(lookup(items(spark, folder), 42))


def lookup_unknown(spark: SparkSession, folder: str) -> DataFrame:
    return flat(lookup(items(spark, folder), -1))


def _lookup_sql(item_id: int) -> str:
    return f"""
WITH {ITEMS_SQL}
SELECT *, CAST(1.0 AS DOUBLE) AS similarity FROM flat_items WHERE item_id = {item_id}
"""


def _asked(spark: SparkSession, folder: str) -> DataFrame:
    """Ids taken from the customer table; those past the last part are unknown items."""
    return table(spark, folder, "customer").select(
        (F.col("c_custkey") + F.col("c_nationkey") * 100).alias("item_id")
    )


ASKED_SQL = "asked AS (SELECT DISTINCT c_custkey + c_nationkey * 100 AS item_id FROM customer)"


def lookup_many_items(spark: SparkSession, folder: str) -> DataFrame:
    return flat(lookup_many(items(spark, folder), _asked(spark, folder)))


def lookup_missing_items(spark: SparkSession, folder: str) -> DataFrame:
    return lookup_missing(items(spark, folder), _asked(spark, folder))


LOOKUP_MANY_SQL = f"""
WITH {ITEMS_SQL}, {ASKED_SQL}
SELECT flat_items.*, CAST(1.0 AS DOUBLE) AS similarity FROM flat_items JOIN asked USING (item_id)
"""
LOOKUP_MISSING_SQL = f"""
WITH {ITEMS_SQL}, {ASKED_SQL}
SELECT item_id FROM asked WHERE item_id NOT IN (SELECT item_id FROM items)
"""


def count_by_array(spark: SparkSession, folder: str) -> DataFrame:
    return flat(count_by(items(spark, folder), "genres"))


def count_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return count_by(items(spark, folder).withColumn("genre", first_element("genres")), "genre")


def count_present_by_category(spark: SparkSession, folder: str) -> DataFrame:
    """The word ``small`` is turned into a missing category, which counts 0."""
    genre = F.when(first_element("genres") != "small", first_element("genres"))
    return count_present(items(spark, folder).select(genre.alias("genre")), "genre")


COUNT_PRESENT_SQL = f"""
WITH {ITEMS_SQL}, g AS (SELECT nullif(genres[1], 'small') AS genre FROM items)
SELECT genre, count(genre) AS n FROM g GROUP BY genre
"""


def average_ordering(spark: SparkSession, folder: str) -> DataFrame:
    return average_by(credits(spark, folder), "ordering", "job")


def count_job_ordering(spark: SparkSession, folder: str) -> DataFrame:
    return count_by(credits(spark, folder), "job", "ordering")


def items_row_count(spark: SparkSession, folder: str) -> DataFrame:
    return row_count(items(spark, folder))


def distinct_jobs(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_values(credits(spark, folder), "job")


def top_rated_items(spark: SparkSession, folder: str) -> DataFrame:
    found = items(spark, folder).where(P.has_any("genres", ["red", "rod"]))
    return flat(top_rated(found, 20))


TOP_RATED_SQL = f"""
WITH {ITEMS_SQL}
SELECT flat_items.* FROM flat_items JOIN items USING (item_id)
WHERE list_has_any(items.genres, ['red', 'rod'])
ORDER BY flat_items.rating DESC, item_id LIMIT 20
"""


def seeded_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Facts of a sample of a tenth: drawn twice alike, part of the table, of the right size.

    The size may be off by six standard deviations of as many draws.
    """
    lines = table(spark, folder, "lineitem")
    first, again = (bernoulli_sample(lines, 0.10, seed=2) for _ in range(2))
    other = bernoulli_sample(lines, 0.10, seed=3)

    def size(frame: DataFrame) -> Column:
        return frame.agg(F.count("*")).scalar()

    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    strangers = first.select(*key).exceptAll(lines.select(*key))
    changed = first.select(*key).exceptAll(again.select(*key))
    redrawn = first.select(*key).exceptAll(other.select(*key))
    rows = F.count("*")
    return lines.agg(
        rows.alias("n"),
        (size(strangers) == 0).alias("all_from_table"),
        (size(changed) == 0).alias("repeatable"),
        (size(redrawn) > 0).alias("seed_matters"),
        (F.abs(size(first) - rows * 0.1) <= 6 * F.sqrt(rows * 0.09)).alias("a_tenth"),
    )


SEEDED_SAMPLE_SQL = """
SELECT count(*) AS n, TRUE AS all_from_table, TRUE AS repeatable, TRUE AS seed_matters, TRUE AS a_tenth
FROM lineitem
"""


def seeded_key_sample(spark: SparkSession, folder: str) -> DataFrame:
    sample = keyed_sample(table(spark, folder, "lineitem"), "l_partkey", 0.10, seed=2)
    return sample.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


KEYED_SAMPLE_SQL = """
SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM lineitem
WHERE substr(md5('2:' || l_partkey), 1, 8) < printf('%08x', CAST(round(0.10 * 4294967296) AS BIGINT))
"""


def quality_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Parts and suppliers are all fine items, so faults are put in from other columns."""
    return flat(_reject_frame(spark, folder))


def _faulty(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("duration")
    return items(spark, folder).withColumns(
        {
            "title": F.when(size == 1, F.lit("Up")).otherwise(F.col("title")),
            "duration": F.when(size == 50, F.lit(300)).when(size == 49, F.lit(0)).otherwise(size),
            "genres": F.when(
                size == 2, F.flatten(F.array(F.col("genres"), F.col("genres"), F.col("genres")))
            ).otherwise(F.col("genres")),
            "year": F.when(size != 3, F.col("year")),
            "rating": F.when(size == 4, F.lit(Decimal("10.01"))).otherwise(F.col("rating")),
            "vote_count": F.when(size == 5, F.lit(-1)).otherwise(F.col("vote_count")),
            "persons": F.when(
                size == 6, F.flatten(F.array_repeat(F.col("persons"), 60))
            ).otherwise(F.col("persons")),
        }
    )


def _reject_frame(spark: SparkSession, folder: str) -> DataFrame:
    return split_valid(_faulty(spark, folder))[1].select("item_id", "violations")


def quality_valid(spark: SparkSession, folder: str) -> DataFrame:
    return split_valid(_faulty(spark, folder))[0].select("item_id")


def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    """Items per broken constraint."""
    broken = with_violations(_faulty(spark, folder)).select(
        F.explode("violations").alias("violation")
    )
    return count_by(broken, "violation")


FAULTS_SQL = f"""
WITH {ITEMS_SQL},
faults AS (
    SELECT item_id, CASE duration
        WHEN 1 THEN 'title_length' WHEN 50 THEN 'duration_range' WHEN 49 THEN 'duration_range'
        WHEN 2 THEN 'too_many_genres' WHEN 3 THEN 'year_missing' WHEN 4 THEN 'rating_range'
        WHEN 5 THEN 'negative_votes' WHEN 6 THEN 'too_many_persons' END AS violation
    FROM items
)
"""

QUERIES = {
    "item_filter": (item_filter, ITEM_FILTER_SQL),
    "search_items": (_search(FULL_SPEC), _search_sql(FULL_SPEC_SQL)),
    "search_title": (
        _search(SearchSpec(title="WIDGET$")),
        _search_sql("regexp_matches(items.title, '(?i)WIDGET$')"),
    ),
    "search_ranges": (
        _search(SearchSpec(min_duration=10, max_duration=20, min_rating=0, vote_count=0)),
        _search_sql(
            "items.duration BETWEEN 10 AND 20 AND items.rating >= 0 AND items.vote_count >= 0"
        ),
    ),
    "search_everything": (_search(SearchSpec()), _search_sql("TRUE")),
    "regex_title": (
        _where(lambda: P.matches("title", "(hot|cold).*R")),
        _where_sql("regexp_matches(items.title, '(?i)(hot|cold).*R')"),
    ),
    "regex_title_exact_case": (
        _where(lambda: P.matches("title", ".*new.gear.*", ignore_case=False)),
        _where_sql("regexp_matches(items.title, '.*new.gear.*')"),
    ),
    "date_range": (
        _where(lambda: P.within("year", date(1995, 2, 1), date(1995, 6, 30))),
        _where_sql("items.year BETWEEN DATE '1995-02-01' AND DATE '1995-06-30'"),
    ),
    "date_equal": (
        _where(lambda: F.col("year") == F.lit(date(1995, 1, 3))),
        _where_sql("items.year = DATE '1995-01-03'"),
    ),
    "date_from": (
        _where(lambda: P.within("year", low=date(1995, 4, 1))),
        _where_sql("items.year >= DATE '1995-04-01'"),
    ),
    "decimal_range": (
        _where(lambda: P.within("rating", Decimal("4.90"), Decimal("5.25"))),
        _where_sql("items.rating >= 4.90 AND items.rating <= 5.25"),
    ),
    "int_ranges": (
        _where(lambda: P.within("duration", 10, 40), lambda: P.within("vote_count", low=33)),
        _where_sql("items.duration BETWEEN 10 AND 40 AND items.vote_count >= 33"),
    ),
    "regex_array": (
        _where(lambda: P.any_element_matches("persons", "0+7,supplier#0+[1-9]")),
        _where_sql(
            "regexp_matches(array_to_string(items.persons, ','), '(?i)0+7,supplier#0+[1-9]')"
        ),
    ),
    "has_all": (
        _where(lambda: P.has_all("persons", ["Supplier#000000007", "Supplier#000000011"])),
        _where_sql(
            "list_has_all(items.persons, ['Supplier#000000007', 'Supplier#000000011'])"
        ),
    ),
    "has_any": (
        _where(lambda: P.has_any("genres", ["cold", "anvil"])),
        _where_sql("list_has_any(items.genres, ['cold', 'anvil'])"),
    ),
    "contains": (
        _where(lambda: P.has_value("genres", "gizmo")),
        _where_sql("list_contains(items.genres, 'gizmo')"),
    ),
    "contains_not": (
        _where(lambda: ~P.has_value("genres", "gizmo"), lambda: P.has_value("genres", "new")),
        _where_sql(
            "NOT list_contains(items.genres, 'gizmo') AND list_contains(items.genres, 'new')"
        ),
    ),
    "exists_element": (
        _where(lambda: P.element_equals("persons", "Supplier#000000005")),
        _where_sql("list_contains(items.persons, 'Supplier#000000005')"),
    ),
    "like_title": (
        _where(lambda: P.like("title", "%ol%g%")),
        _where_sql("items.title LIKE '%ol%g%'"),
    ),
    "in_set": (credits_in_set, CREDITS_SQL.format(condition="l_returnflag IN ('A', 'R')")),
    "early_credits": (
        early_credits,
        CREDITS_SQL.format(condition="l_returnflag = 'N' AND l_linenumber <= 3"),
    ),
    "match_counts": (match_counts, MATCH_COUNTS_SQL),
    "lookup_item": (lookup_item, _lookup_sql(42)),
    "lookup_unknown": (lookup_unknown, _lookup_sql(-1)),
    "lookup_many": (lookup_many_items, LOOKUP_MANY_SQL),
    "lookup_missing": (lookup_missing_items, LOOKUP_MISSING_SQL),
    "count_by_array": (
        count_by_array,
        f"WITH {ITEMS_SQL} SELECT genres, count(*) AS n FROM flat_items GROUP BY genres",
    ),
    "count_by_category": (
        count_by_category,
        f"WITH {ITEMS_SQL} SELECT genres[1] AS genre, count(*) AS n FROM items GROUP BY 1",
    ),
    "count_present_by_category": (count_present_by_category, COUNT_PRESENT_SQL),
    "average_by_group": (
        average_ordering,
        "SELECT l_returnflag AS job, avg(l_linenumber) AS avg_ordering FROM lineitem GROUP BY 1",
    ),
    "count_two_keys": (
        count_job_ordering,
        "SELECT l_returnflag AS job, l_linenumber AS ordering, count(*) AS n "
        "FROM lineitem GROUP BY 1, 2",
    ),
    "row_count": (items_row_count, f"WITH {ITEMS_SQL} SELECT count(*) AS n FROM items"),
    "distinct_values": (
        distinct_jobs,
        "SELECT DISTINCT l_returnflag AS job FROM lineitem",
    ),
    "top_rated": (top_rated_items, TOP_RATED_SQL),
    "seeded_sample": (seeded_sample, SEEDED_SAMPLE_SQL),
    "keyed_sample": (seeded_key_sample, KEYED_SAMPLE_SQL),
    "quality_rejects": (
        quality_rejects,
        FAULTS_SQL
        + "SELECT item_id, violation AS violations FROM faults WHERE violation IS NOT NULL",
    ),
    "quality_valid": (
        quality_valid,
        FAULTS_SQL + "SELECT item_id FROM faults WHERE violation IS NULL",
    ),
    "quality_report": (
        quality_report,
        FAULTS_SQL
        + "SELECT violation, count(*) AS n FROM faults WHERE violation IS NOT NULL GROUP BY 1",
    ),
}
