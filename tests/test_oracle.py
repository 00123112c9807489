"""Every registered query against its SQL, on the given tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = driver.QUERIES, driver.ORACLE


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    fixed = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(fixed, key=repr)


def _plain(value):
    return round(value, 6) if isinstance(value, float) and math.isfinite(value) else value


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, tables, name):
    df = QUERIES[name](spark, FOLDER)
    expected = tables.execute(ORACLE[name])
    names = [column[0] for column in expected.description]
    types = {c[0]: str(c[1]) for c in expected.description}
    assert sorted(df.columns) == sorted(names)
    kinds = {"bigint": ("BIGINT", "NUMBER"), "string": ("VARCHAR", "STRING")}
    for column, kind in df.dtypes:
        if kind in kinds:
            assert types[column] in kinds[kind], (column, kind, types[column])
    got = _rows(df.columns, [tuple(row) for row in df.collect()])
    want = _rows(names, expected.fetchall())
    assert len(got) > 0
    assert len(got) == len(want)
    assert got == want
