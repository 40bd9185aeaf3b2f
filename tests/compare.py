"""Compare a Spark result with SQL run by DuckDB, as bags of rows."""

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, Decimal)):
        value = float(value)
        return None if math.isnan(value) else value
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_bag(df):
    return sorted(df.columns), _bag(df.columns, [tuple(r) for r in df.collect()])


def duck_bag(connection, sql):
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    return sorted(columns), _bag(columns, result.fetchall())


_SPARK_TYPE = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
}


def spark_types(df):
    return {name: kind.removesuffix("_ntz") for name, kind in df.dtypes}


def duck_types(connection, sql):
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    return {name: _SPARK_TYPE.get(kind, kind) for name, kind, *_ in described}
