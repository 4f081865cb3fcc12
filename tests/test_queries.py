"""Every registered query with a SQL twin against DuckDB on the small tables."""

import math
from collections import Counter
from decimal import Decimal

import duckdb
import pandas as pd
import pytest

from parcelwright.plans.registry import ORACLES, QUERIES
import parcelwright.plans  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (bool,)) or type(v).__name__ == "bool_":
        return bool(v)
    if isinstance(v, (int, float, Decimal)) or type(v).__name__.startswith(("int", "float")):
        return float(f"{float(v):.9g}")
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return str(v)


def rows(frame):
    names = sorted(frame.columns)
    return Counter(tuple(plain(v) for v in r) for r in frame[names].astype(object).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, duck, name):
    got, want = QUERIES[name](spark, sf_dir).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
