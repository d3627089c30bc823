"""Registered queries: sources, sinks, tables and the profile job."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinia.functions.tokens import numeric_id
from affinia.operators.edge_store import stored_positions
from affinia.operators.layout import (
    order_edges,
    partition_by_category,
    range_partitioned,
    with_category,
)
from affinia.operators.profiles import build_profiles
from affinia.operators.summary import count_by
from affinia.plans.bindings import ITEMS_SQL, flat, frames, items, table
from affinia.sources.columnar import (
    column_names,
    distinct_column_names,
    read_category,
    read_parquet,
    sql_over_parquet,
)
from affinia.sources.delimited import read_catalogue_files, read_delimited
from affinia.sources.sinks import (
    create_or_replace_table,
    create_table,
    path_exists,
    write_new,
    write_parquet,
    write_partitioned,
)
from affinia.sources.workspace import fresh_path


def _table_name(stem: str) -> str:
    return f"{stem}_{uuid4().hex}"


def _write_tsv(frame: DataFrame, path: str) -> None:
    (
        frame.write.option("sep", "\t")
        .option("header", True)
        .option("nullValue", "\\N")
        .option("emptyValue", "")
        .option("quote", "")
        .option("compression", "gzip")
        .csv(path)
    )


def typed_tsv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "part-tsv")
    known = F.col("p_size") != 7
    _write_tsv(
        table(spark, folder, "part").select(
            "p_partkey",
            "p_name",
            "p_brand",
            "p_type",
            F.when(known, F.col("p_size")).alias("p_size"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("p_retailprice"),
            F.when(known, (F.col("p_size") + 1900).cast("string")).alias("p_year"),
        ),
        path,
    )
    schema = (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DECIMAL(10,2), p_year DATE"
    )
    read = read_delimited(spark, path, schema)
    return flat(read.withColumn("p_size", F.coalesce("p_size", F.lit(-1))))


TYPED_TSV_SQL = """
SELECT p_partkey, p_name, p_brand, p_type, CASE WHEN p_size <> 7 THEN p_size ELSE -1 END AS p_size,
       CAST(CAST(p_retailprice AS DECIMAL(10, 2)) AS DOUBLE) AS p_retailprice,
       CASE WHEN p_size <> 7 THEN CAST(make_date(1900 + p_size, 1, 1) AS VARCHAR) END AS p_year
FROM part
"""


def profiles_from_files(spark: SparkSession, folder: str) -> DataFrame:
    """The whole job from four compressed files with prefixed ids."""
    base = fresh_path(spark, "catalogue")
    source = frames(spark, folder)
    title_id = F.concat(F.lit("tt"), F.lpad(F.col("title_id").cast("string"), 9, "0"))
    person_id = F.concat(F.lit("nm"), F.col("person_id").cast("string"))
    missing = F.lit(None).cast("string")
    _write_tsv(
        source.titles.select(
            title_id.alias("tconst"),
            F.col("kind").alias("titleType"),
            F.col("title").alias("primaryTitle"),
            F.col("title").alias("originalTitle"),
            F.lit("0").alias("isAdult"),
            F.year("year").cast("string").alias("startYear"),
            missing.alias("endYear"),
            F.col("duration").alias("runtimeMinutes"),
            F.array_join("genres", " , ").alias("genres"),
        ),
        f"{base}/title.basics.tsv.gz",
    )
    _write_tsv(
        source.ratings.select(
            title_id.alias("tconst"),
            F.col("rating").alias("averageRating"),
            F.col("vote_count").alias("numVotes"),
        ),
        f"{base}/title.ratings.tsv.gz",
    )
    _write_tsv(
        source.credits.select(
            title_id.alias("tconst"),
            "ordering",
            person_id.alias("nconst"),
            missing.alias("category"),
            "job",
            missing.alias("characters"),
        ),
        f"{base}/title.principals.tsv.gz",
    )
    _write_tsv(
        source.names.select(
            person_id.alias("nconst"),
            F.col("name").alias("primaryName"),
            missing.alias("birthYear"),
            missing.alias("deathYear"),
            missing.alias("primaryProfession"),
            missing.alias("knownForTitles"),
        ),
        f"{base}/name.basics.tsv.gz",
    )
    read = read_catalogue_files(spark, base)
    return flat(build_profiles(read, kind="STANDARD", min_rating="4.5", min_votes=20))


PROFILES_FROM_FILES_SQL = f"""
WITH {ITEMS_SQL}
SELECT CAST(item_id AS INTEGER) AS item_id, title,
       year[:4] || '-01-01' AS year, duration, genres, rating, vote_count,
       persons
FROM flat_items JOIN part ON p_partkey = item_id
WHERE p_type = 'STANDARD' AND rating >= 4.5 AND vote_count >= 20
"""


def profiles(spark: SparkSession, folder: str) -> DataFrame:
    return flat(items(spark, folder, kind="STANDARD", min_rating="5", min_votes=30))


PROFILES_SQL = f"""
WITH {ITEMS_SQL}
SELECT flat_items.* FROM flat_items JOIN part ON p_partkey = item_id
WHERE p_type = 'STANDARD' AND rating >= 5 AND vote_count >= 30
"""


def all_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return flat(items(spark, folder))


ALL_PROFILES_SQL = f"WITH {ITEMS_SQL} SELECT * FROM flat_items"


def profiles_store(spark: SparkSession, folder: str) -> DataFrame:
    """Written twice to the same path: the second write replaces the first."""
    path = fresh_path(spark, "profiles")
    for _ in range(2):
        write_parquet(items(spark, folder, min_rating="5"), path)
    return flat(read_parquet(spark, path))


PROFILES_STORE_SQL = f"WITH {ITEMS_SQL} SELECT * FROM flat_items WHERE rating >= 5"


def parquet_partition_read(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "kinds")
    write_partitioned(table(spark, folder, "part").withColumnRenamed("p_type", "kind"), path, "kind")
    return read_category(spark, path, "ECONOMY", "kind")


PARTITION_READ_SQL = """
SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part WHERE p_type = 'ECONOMY'
"""


def _category_store(mode: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        path = fresh_path(spark, f"genres-{mode}")
        partition_by_category(items(spark, folder), path, mode=mode)
        return flat(read_parquet(spark, path))

    return run


CATEGORY_FIRST_SQL = f"""
WITH {ITEMS_SQL}
SELECT flat_items.*, items.genres[1] AS genre FROM flat_items JOIN items USING (item_id)
"""
CATEGORY_ALL_SQL = f"""
WITH {ITEMS_SQL},
spread AS (SELECT item_id, unnest(list_distinct(genres)) AS genre FROM items)
SELECT flat_items.*, genre FROM flat_items JOIN spread USING (item_id)
"""


def category_partition_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per discovered partition value of a partitioned scan."""
    path = fresh_path(spark, "genres-scan")
    parts = table(spark, folder, "part").select("p_partkey", F.split("p_name", r"\s+").alias("genres"))
    write_partitioned(with_category(parts), path, "genre", only_given_partitions=True)
    return count_by(sql_over_parquet(spark, path), "genre")


CATEGORY_PARTITION_ROWS_SQL = r"""
SELECT string_split_regex(p_name, '\s+')[1] AS genre, count(*) AS n FROM part GROUP BY 1
"""


def partitioned_table(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    name = _table_name("parts_by_type")
    path = fresh_path(spark, name)
    return create_or_replace_table(parts, name, path=path, partition_by="p_type")


def create_table_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    name = _table_name("suppliers")
    path = fresh_path(spark, name)
    for _ in range(2):
        published = create_or_replace_table(table(spark, folder, "supplier"), name, path=path)
    return published


def create_table_once(spark: SparkSession, folder: str) -> DataFrame:
    name = _table_name("customers")
    return create_table(table(spark, folder, "customer"), name, path=fresh_path(spark, name))


def sql_parquet_scan(spark: SparkSession, folder: str) -> DataFrame:
    lines = sql_over_parquet(spark, f"{folder}/lineitem.parquet")
    return lines.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


def write_once_guard(spark: SparkSession, folder: str) -> DataFrame:
    """The second write finds the path taken and does nothing."""
    path = fresh_path(spark, "once")
    nations = table(spark, folder, "nation")
    first = write_new(nations, path)
    again = write_new(nations.limit(0), path)
    return read_parquet(spark, path).withColumns(
        {
            "first_written": F.lit(first),
            "second_written": F.lit(again),
            "present": F.lit(path_exists(spark, path)),
        }
    )


WRITE_ONCE_SQL = """
SELECT *, TRUE AS first_written, FALSE AS second_written, TRUE AS present FROM nation
"""


def schema_columns(spark: SparkSession, folder: str) -> DataFrame:
    name = _table_name("lines")
    table(spark, folder, "lineitem").createOrReplaceTempView(name)
    return column_names(spark, name).select("column_name")


def schema_distinct_columns(spark: SparkSession, folder: str) -> DataFrame:
    name = _table_name("parts")
    table(spark, folder, "part").createOrReplaceTempView(name)
    return distinct_column_names(spark, name)


def id_from_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        "c_name",
        numeric_id("c_name", "Customer#").alias("customer_id"),
        F.coalesce(numeric_id("c_mktsegment", "Customer#"), F.lit(-1)).alias("no_number"),
    )


ID_FROM_PREFIX_SQL = """
SELECT c_name, TRY_CAST(replace(c_name, 'Customer#', '') AS INTEGER) AS customer_id,
       coalesce(TRY_CAST(replace(c_mktsegment, 'Customer#', '') AS INTEGER), -1) AS no_number
FROM customer
"""


def range_layout(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and partitions of a range layout, and how many ranges reach into the one before."""
    lines = range_partitioned(table(spark, folder, "lineitem"), 8, "l_partkey", "l_orderkey")
    key = F.struct("l_partkey", "l_orderkey")
    ranges = lines.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")
    )
    # One row per partition.
    before = F.lag("high").over(Window.orderBy("partition_id"))
    return ranges.withColumn("reaches", F.col("low") <= before).agg(
        F.sum("n").alias("n"), F.count("*").alias("partitions"), F.count_if("reaches").alias("overlaps")
    )


RANGE_LAYOUT_SQL = """
SELECT count(*) AS n, CAST(8 AS BIGINT) AS partitions, CAST(0 AS BIGINT) AS overlaps FROM lineitem
"""


def edge_order(spark: SparkSession, folder: str) -> DataFrame:
    """Edges from parts to orders with their place in the stored files: id, then best first."""
    edges = table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("item_id"),
        F.col("l_orderkey").alias("other_id"),
        F.col("l_discount").alias("similarity"),
    )
    path = fresh_path(spark, "edges")
    write_new(order_edges(edges), path)
    return stored_positions(spark, path)


EDGE_ORDER_SQL = """
SELECT l_partkey AS item_id, l_orderkey AS other_id, l_discount AS similarity,
       row_number() OVER (ORDER BY l_partkey, l_discount DESC, l_orderkey) AS position
FROM lineitem
"""

QUERIES = {
    "typed_tsv_roundtrip": (typed_tsv_roundtrip, TYPED_TSV_SQL),
    "profiles_from_files": (profiles_from_files, PROFILES_FROM_FILES_SQL),
    "build_profiles": (profiles, PROFILES_SQL),
    "build_profiles_all": (all_profiles, ALL_PROFILES_SQL),
    "profiles_store": (profiles_store, PROFILES_STORE_SQL),
    "parquet_partition_read": (parquet_partition_read, PARTITION_READ_SQL),
    "category_first": (_category_store("first"), CATEGORY_FIRST_SQL),
    "category_fanout": (_category_store("all"), CATEGORY_ALL_SQL),
    "category_partition_rows": (category_partition_rows, CATEGORY_PARTITION_ROWS_SQL),
    "partitioned_table": (partitioned_table, "SELECT * FROM part"),
    "create_table_roundtrip": (create_table_roundtrip, "SELECT * FROM supplier"),
    "create_table_once": (create_table_once, "SELECT * FROM customer"),
    "sql_parquet_scan": (
        sql_parquet_scan,
        "SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM lineitem",
    ),
    "write_once_guard": (write_once_guard, WRITE_ONCE_SQL),
    "schema_columns": (schema_columns, "SELECT column_name FROM (DESCRIBE lineitem)"),
    "schema_distinct_columns": (
        schema_distinct_columns,
        "SELECT DISTINCT column_name FROM (DESCRIBE part)",
    ),
    "id_from_prefix": (id_from_prefix, ID_FROM_PREFIX_SQL),
    "range_layout": (range_layout, RANGE_LAYOUT_SQL),
    "edge_order": (edge_order, EDGE_ORDER_SQL),
}
