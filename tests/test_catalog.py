"""Every named query against its SQL on the smallest shared tables."""

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from growthlab.catalog.oracles import all_oracles
from growthlab.catalog.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "labels"]

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="shared tables not mounted")

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    yield con
    con.close()


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def order(row):
    return tuple("~" if x is None else f"{x:.4f}" if isinstance(x, float) else str(x) for x in row)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=order)
    rel = duck.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=order)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        for c, x, y in zip(cols, g, w):
            if isinstance(x, float) and isinstance(y, float):
                assert math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9), (c, g, w)
            else:
                assert x == y, (c, g, w)


# these train 500 boosting rounds for minutes
SLOW = {"model_threshold_sweep", "feature_importance"}


def test_slow_queries_with_few_rounds(spark):
    sweep = QUERIES["model_threshold_sweep"](spark, FOLDER, rounds=4).toPandas()
    assert set(sweep["model"]) == {"newton", "boosted", "logistic"} and len(sweep) == 3 * 51
    assert sweep.groupby("model")["f1"].max().min() > 0.5
    table = QUERIES["feature_importance"](spark, FOLDER, rounds=3).toPandas()
    assert table["importance"].sum() == pytest.approx(100) and len(table) == 4


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
