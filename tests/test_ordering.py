import datetime as dt

import numpy as np
import pandas as pd
import pytest
from helpers import plan
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfrank.functions import ordering


def skewed(n=3000, seed=1):
    """A third of the rows share one value."""
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 500, n)
    x[: n // 3] = 77
    return [int(v) for v in x]


def test_percent_rank_equals_the_definition(spark):
    x = skewed()
    df = spark.createDataFrame([(v,) for v in x], "x long")
    (bounds,) = ordering.slice_bounds(df, ["x"])
    got = {r["x"]: r["pr"] for r in ordering.percent_rank_table(df, "x", "pr", bounds).collect()}
    want = (pd.Series(x).rank(method="min") - 1) / (len(x) - 1)
    assert got == pytest.approx(dict(zip(x, want)))


def test_percent_rank_of_one_row_and_none(spark):
    one = spark.createDataFrame([(5,)], "x long")
    for df, want in ((one, [(5, 0.0)]), (one.limit(0), [])):
        (bounds,) = ordering.slice_bounds(df, ["x"])
        assert [tuple(r) for r in ordering.percent_rank_table(df, "x", "pr", bounds).collect()] == want


@pytest.mark.parametrize("n", [1, 2, 5, 1000])
def test_quantiles_interpolate_like_numpy(spark, n):
    x = np.random.default_rng(n).normal(size=n).round(2)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["prob"]: r["value"] for r in ordering.exact_quantiles(df, "x", probs).collect()}
    assert got == pytest.approx(dict(zip(probs, np.quantile(x, probs))))


def test_quantiles_of_nothing(spark):
    assert ordering.exact_quantiles(spark.createDataFrame([], "x double"), "x", [0.5]).count() == 0


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_running_number_of_a_hot_group(spark, kind):
    rng = np.random.default_rng(2)
    start = dt.datetime(2024, 1, 1)
    data = [
        (n, 0 if n % 3 == 0 else int(rng.integers(1, 40)), start + dt.timedelta(seconds=int(rng.integers(0, 4000))))
        for n in range(2000)
    ]
    df = spark.createDataFrame(data, f"id long, g long, ts {kind}")
    got = ordering.running_number(df, ["g"], "ts", ["id"], "nth")
    frame = pd.DataFrame(data, columns=["id", "g", "ts"]).sort_values(["g", "ts", "id"])
    frame["nth"] = frame.groupby("g").cumcount() + 1
    assert {r["id"]: r["nth"] for r in got.collect()} == dict(zip(frame["id"], frame["nth"]))


def test_running_number_of_one_group_with_one_time(spark):
    """All rows agree in group and time; the ties alone cut them, and no task has more than a slice."""
    at = dt.datetime(2024, 1, 1)
    df = spark.range(4000).selectExpr("7L AS g", f"timestamp_ntz'{at}' AS ts", "pmod(id * 37, 4000) AS id")
    got = ordering.running_number(df, ["g"], "ts", ["id"], "nth", slices=16)
    assert [(r["id"], r["nth"]) for r in got.orderBy("id").collect()] == [(n, n + 1) for n in range(4000)]
    sizes = [r["count"] for r in df.repartitionByRange(16, "g", "ts", "id").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 600
    text = plan(got)
    assert "Window" in text and "BroadcastHashJoin" in text


@pytest.mark.parametrize("parts", [None, 1, 7, 64])
def test_prefix_scan_equals_the_window(spark, parts):
    rng = np.random.default_rng(4)
    rows = [
        (
            None if n % 11 == 0 else "hot" if n % 3 else f"g{rng.integers(20)}",
            None if n % 13 == 0 else int(rng.integers(5)),
            n,
            int(rng.integers(-3, 9)),
        )
        for n in range(1500)
    ]
    df = spark.createDataFrame(rows, "g string, t long, id long, v long")
    window = Window.partitionBy("g").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("total", F.sum("v").over(window)).collect()
    got = ordering.prefix_scan(df, ["g"], ["t", "id"], "total", "v", parts).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    none = ordering.prefix_scan(df.where("false"), ["g"], ["t", "id"], "total", "v", parts)
    assert none.count() == 0 and none.columns == [*df.columns, "total"]


def test_dense_keys_number_distinct_values_once(spark):
    df = spark.createDataFrame([(f"name{n % 700}",) for n in range(1500)], "name string")
    got = ordering.dense_keys(df, "name", "key").collect()
    assert sorted(r["key"] for r in got) == list(range(1, 701))
    again = ordering.dense_keys(df.repartition(7), "name", "key").collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in again}


def test_top_per_group_is_pruned_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as g", "id as v")
    top = ordering.top_per_group(df, ["g"], [df["v"].desc()], 2)
    assert sorted((r["g"], r["v"], r["rank"]) for r in top.collect()) == [
        (0, 996, 2), (0, 999, 1), (1, 994, 2), (1, 997, 1), (2, 995, 2), (2, 998, 1),
    ]
    text = plan(top)
    assert text.count("Arguments: [g") >= 2 and "row_number(), 2, Partial" in text
