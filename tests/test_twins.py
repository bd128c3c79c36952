"""Every retail query with an SQL twin gives the twin's rows on the smallest tables."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from stallwatch import catalog


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return "NULL"
    if isinstance(value, (list, np.ndarray)):
        return str([str(x) for x in value])
    if isinstance(value, (bool, np.bool_)):
        return str(bool(value))
    if isinstance(value, (float, np.floating)):
        return "NULL" if np.isnan(value) else repr(round(float(value), 6))
    if isinstance(value, (int, np.integer)):
        return repr(float(value))
    return str(value).removesuffix(" 00:00:00")


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple(plain(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_twin(spark, sf, duck, name):
    got = rows(catalog.queries()[name](spark, sf).toPandas())
    want = rows(duck.sql(catalog.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_every_query_has_a_twin():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
