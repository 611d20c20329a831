"""Rows of a Spark query and of its SQL counterpart in one comparable shape."""

import datetime
import decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def cell(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def shape(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(cell(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(cells, key=repr)


def from_spark(df):
    return shape(df.columns, [tuple(r) for r in df.collect()])


def from_duckdb(sql, sf_dir):
    with duckdb.connect() as con:
        for table in TABLES:
            path = Path(sf_dir) / f"{table}.parquet"
            if path.exists():
                con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
        result = con.execute(sql)
        return shape([d[0] for d in result.description], result.fetchall())
