"""Registered queries beside their SQL on the smallest tables; the untested rest must return rows."""

import glob
import os
import re

import duckdb
import pytest
from helpers import plan

from compare import difference
from shelfrank.plans import oracles, registry
from shelfrank.sources.retail import Retail

FOLDER = "/root/testdata/sf0.001"
SQL = oracles.oracle_sql()
# Long trainings have their own tests.
SLOW = {"bpr_train", "bpr_recommendations", "als_candidates", "als_recommendations"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(registry.QUERIES)
    assert set(registry.QUERIES) - set(SQL) == SLOW


def test_entry_takes_all_registered_queries():
    import __spark_entry__ as contract

    assert set(registry.QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", ["eval_period", "ground_truth", "train_sales"])
def test_dates_and_status_reach_the_scans(spark, name):
    t = Retail(spark, FOLDER)
    frames = {
        "eval_period": lambda: registry.QUERIES[name](spark, FOLDER),
        "ground_truth": lambda: registry.truth(t),
        "train_sales": lambda: registry.train_facts(t)[0],
    }
    pushed = re.findall(r"PushedFilters: \[(.*?)\]", plan(frames[name]()))
    dates = "".join(f for f in pushed if "o_orderdate" in f)
    assert "LessThan(o_orderdate" in dates
    if name != "train_sales":
        assert "GreaterThanOrEqual(o_orderdate" in dates
        assert any("EqualTo(l_linestatus,F)" in f for f in pushed)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - SLOW))
def test_query(spark, con, name):
    df = registry.QUERIES[name](spark, FOLDER)
    text = plan(df)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    got = df.toPandas()
    if name not in SQL:
        assert len(got)
        return
    assert difference(got, con.execute(SQL[name]).df()) is None
