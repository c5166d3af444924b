"""Every registered query against its SQL on the small tables."""

import math

import duckdb
import pandas as pd
import pytest

from rowwarden.plans.catalog import FLAGSHIP, ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    yield con
    con.close()


def text(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if type(v).__name__ in ("bool", "bool_"):
        return str(bool(v))
    return repr(float(v)) if isinstance(v, float) else str(v)


def rows(frame):
    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(text(v) for v in r) for r in ordered.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, duck, name):
    found = QUERIES[name](spark, folder).toPandas()
    assert len(found.columns) == len(set(found.columns))
    if name not in ORACLES:
        assert len(found)
        return
    expected = duck.sql(ORACLES[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows(found) == rows(expected)


def test_registry():
    assert FLAGSHIP in ORACLES
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)
