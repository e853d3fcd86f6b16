"""Every catalogued query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from siftrail.plans import catalog_files as catalog


def rounded(value):
    return round(value, 8) if isinstance(value, float) else value


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(map(rounded, r))) for r in df.select(*columns).collect())
    listed = ", ".join(f'"{c}"' for c in columns)
    want = sorted(repr(tuple(map(rounded, r))) for r in duck.execute(f"SELECT {listed} FROM ({catalog.ORACLE_SQL[name]})").fetchall())
    assert got == want


def test_entry(spark, sf_dir):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
