"""Every registered query against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from tickloom.plans.catalog import QUERIES
from tickloom.plans.oracles import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(frame: pd.DataFrame):
    def text(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return "~"
        return str(pd.Timestamp(v)) if hasattr(v, "isoformat") else repr(v) if isinstance(v, float) else str(v)

    names = sorted(frame.columns)
    return names, sorted(tuple(map(text, row)) for row in frame[names].itertuples(index=False))


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"forecast_seasonal"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert len(got) > 0
    if name in ORACLES:
        assert plain(got) == plain(tables.sql(ORACLES[name]).df())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
