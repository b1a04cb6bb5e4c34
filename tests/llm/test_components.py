"""Components of links against union-find, and the size of the plans their rounds give the driver."""

import random

import pytest

from shelfrank.llm import tables
from shelfrank.llm.tables import Scratch, components


def brute(links):
    above = {}

    def top(k):
        while above.setdefault(k, k) != k:
            k = above[k]
        return k

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = top(a), top(b)
            above[max(x, y)] = min(x, y)
    return {k: top(k) for k in above}


def found(spark, links):
    rows = components(spark.createDataFrame(links, "a long, b long"), "test").collect()
    assert len(rows) == len({r.node for r in rows})
    return {r.node: r.component for r in rows}


CASES = {
    "none": [],
    "one row with itself": [(3, 3), (None, 3), (None, None)],
    "chain": [(k + 1, k) for k in range(70)],
    "chain out of order": [(k * 37 % 71, (k + 1) * 37 % 71) for k in range(70)],
    "star of the largest": [(99, k) for k in range(60)],
    "star of the smallest, repeated": [(-5, k) for k in range(60)] * 2,
    "two stars with a bridge": [(0, k) for k in range(10, 30)] + [(9, k) for k in range(40, 60)] + [(29, 59), (3, 4)],
}


@pytest.mark.parametrize("case", CASES)
def test_components_of_odd_links(spark, case):
    assert found(spark, CASES[case]) == brute(CASES[case])


def test_components_of_random_links(spark):
    r = random.Random(8)
    links = [(r.randrange(-200, 200), r.randrange(-200, 200)) for _ in range(170)]
    assert found(spark, links) == brute(links)


def test_no_step_of_a_round_has_a_large_plan(spark, monkeypatch):
    exchanges, keep = [], Scratch.keep

    def counted(self, df):
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        exchanges.append(plan.count("Exchange hash"))
        return keep(self, df)

    monkeypatch.setattr(tables.Scratch, "keep", counted)
    assert found(spark, CASES["chain"]) == brute(CASES["chain"])
    assert len(exchanges) > 3 and max(exchanges) <= 3
