"""Rows and types of a Spark result and of the same query in DuckDB."""

import math
from pathlib import Path

import duckdb


def connect(sf_dir):
    db = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


SAME = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def difference(df, db, sql):
    """None when both agree, else what is different."""
    cursor = db.execute(sql)
    names = [c[0] for c in cursor.description]
    types = {c[0]: str(c[1]) for c in cursor.description}
    expected = _rows(names, cursor.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if got[0] != expected[0]:
        return f"columns {got[0]} != {expected[0]}"
    kinds = {n: (SAME.get(k, k), types[n]) for n, k in df.dtypes}
    wrong = {n: k for n, k in kinds.items() if k[0] != k[1]}
    if got[1] != expected[1]:
        only = set(got[1]) - set(expected[1]), set(expected[1]) - set(got[1])
        return (f"{len(got[1])} rows != {len(expected[1])}; only here {sorted(only[0])[:3]}; "
                f"only there {sorted(only[1])[:3]}")[:3000]
    return f"types {wrong}" if wrong else None
