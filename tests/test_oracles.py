"""Every catalog query against its SQL counterpart, value by value."""

import os

import duckdb
import pandas as pd
import pytest

from wakeline.plans.catalog import QUERIES
from wakeline.plans.oracles import ORACLES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    return con


def _normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if pd.api.types.is_datetime64_any_dtype(frame[name]):
            frame[name] = frame[name].astype("datetime64[us]").astype(str)
        elif pd.api.types.is_float_dtype(frame[name]):
            frame[name] = frame[name].map(repr)
        frame[name] = frame[name].astype(object).where(frame[name].notna(), "NULL").astype(str)
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


# Steps that pair every row with every other, or leave the JVM row by row.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonUDF")


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, duck, name):
    query = QUERIES[name](spark, SF_DIR)
    got = query.toPandas()
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert not [step for step in UNWANTED if step in plan]
    want = duck.sql(ORACLES[name]).df()
    assert len(got) == len(want) > 0
    pd.testing.assert_frame_equal(_normal(got), _normal(want))
