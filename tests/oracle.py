"""Compare a query with its SQL twin: names, row count, and values without regard to order."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

from oreworks.workload.registry import TABLES


def connect(folder: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, db, sql: str) -> None:
    names, rows = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(sql)
    sql_columns = [d[0] for d in cursor.description]
    sql_names, sql_rows = table(sql_columns, cursor.fetchall())
    assert names == sql_names
    assert len(rows) == len(sql_rows), (len(rows), len(sql_rows))
    for mine, theirs in zip(rows, sql_rows):
        assert mine == theirs, f"\nspark {dict(zip(names, mine))}\nsql   {dict(zip(names, theirs))}"
