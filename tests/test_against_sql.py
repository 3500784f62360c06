"""Every registered query with a SQL counterpart gives the same rows as that SQL in DuckDB."""

import os
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
NUMBERS = ("int", "long", "bigint", "integer", "double", "decimal", "float", "short")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in sorted(Path(FOLDER).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    return repr(value)


def lines(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = df.collect()
    assert got, "no rows"
    if name not in ORACLES:
        return
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    kinds = [str(c[1]) for c in cursor.description]
    want = cursor.fetchall()
    assert sorted(df.columns) == sorted(columns)
    ours, theirs = lines(df.columns, got), lines(columns, want)
    differing = [p for p in zip(ours, theirs) if p[0] != p[1]][:3]
    assert len(ours) == len(theirs), f"{len(ours)} rows, SQL has {len(theirs)}; first differences {str(differing)[:1500]}"
    assert not differing, str(differing)[:3000]
    spark_kinds = dict(df.dtypes)
    for column, kind in zip(columns, kinds):
        expected = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean", "DOUBLE": "double", "DATE": "date"}.get(kind)
        if expected:
            assert spark_kinds[column] == expected, f"{column}: {spark_kinds[column]} but SQL has {kind}"
        else:
            assert "DECIMAL" not in kind and "HUGEINT" not in kind, f"{column} is {kind} in SQL"
