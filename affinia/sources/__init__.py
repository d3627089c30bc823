"""Readers, sinks, catalog tables and the shared work area."""

from affinia.sources.columnar import (
    column_names,
    column_types,
    distinct_column_names,
    read_category,
    read_parquet,
    sql_over_parquet,
)
from affinia.sources.delimited import (
    CREDITS,
    NAMES,
    RATINGS,
    TITLES,
    CatalogueFrames,
    read_catalogue_files,
    read_delimited,
)
from affinia.sources.sinks import (
    create_or_replace_table,
    create_table,
    path_exists,
    write_new,
    write_parquet,
    write_partitioned,
)
from affinia.sources.workspace import fresh_path, staged, work_root

__all__ = [
    "CREDITS",
    "CatalogueFrames",
    "NAMES",
    "RATINGS",
    "TITLES",
    "column_names",
    "column_types",
    "create_or_replace_table",
    "create_table",
    "distinct_column_names",
    "fresh_path",
    "path_exists",
    "read_catalogue_files",
    "read_category",
    "read_delimited",
    "read_parquet",
    "sql_over_parquet",
    "staged",
    "work_root",
    "write_new",
    "write_parquet",
    "write_partitioned",
]
