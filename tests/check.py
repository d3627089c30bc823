"""Compare a Spark result with a DuckDB result: columns, types, rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


def _key(row):
    return tuple((value is None, str(value)) for value in row)


def _rows(records, names, order):
    places = [names.index(name) for name in order]
    return sorted((tuple(_plain(r[i]) for i in places) for r in records), key=_key)


DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
              "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


def differences(frame, relation) -> list[str]:
    """What differs, as text; empty where the two agree."""
    left_names, right_names = frame.columns, relation.columns
    found = []
    if sorted(left_names) != sorted(right_names):
        return [f"columns {sorted(left_names)} and {sorted(right_names)}"]
    left_types = dict(frame.dtypes)
    right_types = {n: DUCK_TYPES.get(str(t), str(t)) for n, t in zip(right_names, relation.types)}
    if left_types != right_types:
        found.append(f"types {left_types} and {right_types}")
    order = sorted(left_names)
    left = _rows([tuple(r) for r in frame.collect()], left_names, order)
    right = _rows(relation.fetchall(), right_names, order)
    if len(left) != len(right):
        found.append(f"{len(left)} rows and {len(right)} rows")
    if left != right:
        only_left = [r for r in left if r not in set(right)][:3]
        only_right = [r for r in right if r not in set(left)][:3]
        found.append(f"only in Spark {only_left}; only in SQL {only_right}")
    return found
