"""Every SQL-checkable query against its DuckDB oracle (the driver's correctness gate)."""

import os

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SF_CHECK

TABLES = sorted(f.removesuffix(".parquet") for f in os.listdir(SF_CHECK) if f.endswith(".parquet"))


def _rows(pdf):
    import math

    import pandas as pd

    def norm(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        if hasattr(v, "item"):
            return v.item()
        return v

    cols = sorted(pdf.columns)
    return cols, sorted((tuple(norm(x) for x in rec) for rec in pdf[cols].itertuples(index=False, name=None)),
                        key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_CHECK).toPandas()
    want = con.sql(E.oracle_sql()[name]).df()
    assert _rows(got) == _rows(want)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns


def test_every_query_is_registered_with_spark_code():
    assert set(E.oracle_sql()) <= set(E.queries())
