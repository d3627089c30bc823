"""Tab-separated catalogue files with declared schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of the public catalogue files, in file order.
TITLES = (
    "tconst STRING, titleType STRING, primaryTitle STRING, originalTitle STRING, "
    "isAdult BOOLEAN, startYear DATE, endYear DATE, runtimeMinutes INT, genres STRING"
)
RATINGS = "tconst STRING, averageRating DECIMAL(4,2), numVotes INT"
CREDITS = (
    "tconst STRING, ordering INT, nconst STRING, category STRING, job STRING, characters STRING"
)
NAMES = (
    "nconst STRING, primaryName STRING, birthYear DATE, deathYear DATE, "
    "primaryProfession STRING, knownForTitles STRING"
)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    *,
    sep: str = "\t",
    header: bool = True,
    date_format: str = "yyyy",
    null_value: str = "\\N",
) -> DataFrame:
    """Read delimited text (plain or compressed) with a declared schema.

    The schema is never inferred, so the files are read once. Malformed values
    become null. Quoting is off: the files do not quote, and a field that starts
    with a lone ``"`` would otherwise swallow the rest of its row.

    A gzip file is one scan task whatever its size; give large inputs as many
    files, or convert them to parquet once.
    """
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", header)
        .option("dateFormat", date_format)
        .option("nullValue", null_value)
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


@dataclass(frozen=True)
class CatalogueFrames:
    """The four inputs of :func:`affinia.operators.profiles.build_profiles`.

    titles   title_id, kind, title, year date, duration int, genres string
    ratings  title_id, rating decimal(4,2), vote_count int
    credits  title_id, ordering int, person_id, job
    names    person_id, name
    """

    titles: DataFrame
    ratings: DataFrame
    credits: DataFrame
    names: DataFrame


def read_catalogue_files(
    spark: SparkSession,
    folder: str,
    *,
    titles: str = "title.basics.tsv.gz",
    ratings: str = "title.ratings.tsv.gz",
    credits: str = "title.principals.tsv.gz",
    names: str = "name.basics.tsv.gz",
) -> CatalogueFrames:
    """Read the four catalogue files of one folder and give the columns neutral names."""
    base = folder.rstrip("/")
    return CatalogueFrames(
        titles=read_delimited(spark, f"{base}/{titles}", TITLES).select(
            F.col("tconst").alias("title_id"),
            F.col("titleType").alias("kind"),
            F.col("primaryTitle").alias("title"),
            F.col("startYear").alias("year"),
            F.col("runtimeMinutes").alias("duration"),
            "genres",
        ),
        ratings=read_delimited(spark, f"{base}/{ratings}", RATINGS).select(
            F.col("tconst").alias("title_id"),
            F.col("averageRating").alias("rating"),
            F.col("numVotes").alias("vote_count"),
        ),
        credits=read_delimited(spark, f"{base}/{credits}", CREDITS).select(
            F.col("tconst").alias("title_id"),
            "ordering",
            F.col("nconst").alias("person_id"),
            "job",
        ),
        names=read_delimited(spark, f"{base}/{names}", NAMES).select(
            F.col("nconst").alias("person_id"), F.col("primaryName").alias("name")
        ),
    )
