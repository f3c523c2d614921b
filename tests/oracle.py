"""Comparing a query with its SQL text run by DuckDB on the same files."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb

INTEGERS = {"TINYINT": "int8", "SMALLINT": "int16", "INTEGER": "int32", "BIGINT": "int64"}
SPARK_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def differences(df, sql: str, folder: str) -> list[str]:
    """What differs between a Spark result and the SQL result: columns, types, rows."""
    con = connect(folder)
    result = con.execute(sql)
    described = {d[0]: str(d[1]) for d in result.description}
    rows = result.fetchall()
    order = list(described)
    names = sorted(described)
    problems = []
    if sorted(df.columns) != names:
        return [f"columns {sorted(df.columns)} != {names}"]
    for name, dtype in df.dtypes:
        expected = SPARK_TYPES.get(dtype, dtype)
        if expected != described[name]:
            problems.append(f"type of {name}: {dtype} != {described[name]}")
    got = sorted(
        (tuple(plain(r[n]) for n in names) for r in df.select(*names).collect()), key=sort_key
    )
    wanted = sorted(
        (tuple(plain(r[order.index(n)]) for n in names) for r in rows), key=sort_key
    )
    if len(got) != len(wanted):
        problems.append(f"{len(got)} rows != {len(wanted)}")
    different = [(a, b) for a, b in zip(got, wanted) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ, first: {different[0][0]} != {different[0][1]}")
    return problems


def plan_of(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)
