"""Running a registered query and its SQL twin, and comparing them as multisets."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def compare(result, con, sql: str):
    """(columns, columns of the twin, rows, rows of the twin)"""
    twin_columns = [(name, str(kind)) for name, kind, *_ in con.execute(f"DESCRIBE {sql}").fetchall()]
    own_columns = [(name, TYPES[kind]) for name, kind in result.dtypes]
    twin = _rows([name for name, _ in twin_columns], con.execute(sql).fetchall())
    own = _rows(result.columns, [tuple(row) for row in result.collect()])
    return own_columns, twin_columns, own, twin
