"""Every registered query against its SQL in DuckDB on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pandas as pd
import pytest

from eventloom.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        return round(float(v), 5) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) or hasattr(v, "dtype") and v.dtype.kind in "iuf" else v

    return sorted((tuple(plain(x) for x in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    found, wanted = QUERIES[name](spark, SF).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows(found) == rows(wanted)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_and_names(spark):
    import __spark_entry__ as entries

    assert entries.entry(spark).count() > 0
    assert set(entries.oracle_sql()) <= set(entries.queries())
