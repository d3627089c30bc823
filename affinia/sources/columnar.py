"""Parquet scans and schema introspection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Scan a parquet folder or glob; partition columns are discovered."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_category(
    spark: SparkSession, root: str, category: str | None, column: str = "genre"
) -> DataFrame:
    """Rows of one partition value, without the partition column.

    Same rows as naming the ``column=value`` folder, but the name needs no
    escaping and only that folder is listed and read (partition pruning).
    """
    table = spark.read.parquet(root)
    return table.where(F.col(column).eqNullSafe(F.lit(category))).drop(column)


def sql_over_parquet(spark: SparkSession, path: str) -> DataFrame:
    """The same scan through SQL, for callers that hold a path or glob only."""
    escaped = path.replace("`", "``")
    return spark.sql(f"SELECT * FROM parquet.`{escaped}`")


def column_names(spark: SparkSession, table: str) -> DataFrame:
    """Name and type of each column of a catalog table or view, in order."""
    return spark.sql("DESCRIBE TABLE IDENTIFIER(:t)", args={"t": table}).select(
        F.col("col_name").alias("column_name"), F.col("data_type").alias("column_type")
    )


def distinct_column_names(spark: SparkSession, table: str) -> DataFrame:
    """The distinct column names of a catalog table or view."""
    return column_names(spark, table).select("column_name").distinct()


def column_types(frame: DataFrame) -> str:
    """Schema of a frame as JSON, for logging and for declaring the next read."""
    return frame.schema.json()
