import datetime as dt
import math

import numpy as np
import pytest
from helpers import AS_OF, at, carts, plan, reviews, rows, sales, scores

from shelfrank.operators import interactions as ia


def test_same_pair_in_all_sources_adds_up(spark):
    got = ia.interaction_scores(
        sales(spark, [(1, 7, at(1, 0, 2), "completed"), (1, 7, at(2), "pending")]),
        carts(spark, [(1, 7, at(31, 23))]),
        reviews(spark, [(1, 7, 4.0, at(2)), (1, 7, 3.9, at(2))]),
        AS_OF,
    ).first()
    # Bought on the day itself, carted one calendar day before, reviewed 30 days before.
    want = 10 + 3 * math.exp(-0.05 / 30) + 5 * math.exp(-0.05)
    assert got["interaction_score"] == pytest.approx(want, abs=1e-12)


def test_future_events_are_left_out_unless_asked_for(spark):
    facts = sales(spark, [(1, 7, at(3, 1, 2), "completed")]), carts(spark), reviews(spark)
    assert ia.interaction_scores(*facts, AS_OF).count() == 0
    raw = ia.interaction_scores(*facts, AS_OF, clip_future=False).first()
    assert raw["interaction_score"] > 10


def test_decay_halves_at_its_half_life(spark):
    months = math.log(2) / 0.05
    day = AS_OF - dt.timedelta(days=round(months * 30))
    got = ia.interaction_scores(
        sales(spark, [(1, 1, dt.datetime.combine(day, dt.time()), "completed")]),
        carts(spark), reviews(spark), AS_OF,
    ).first()
    assert got["interaction_score"] == pytest.approx(5.0, abs=0.01)


def test_validation_and_quality_counts(spark):
    df = scores(spark, [(1, 1, 2.0), (1, 2, None), (2, 1, 0.0), (2, 2, -1.0)])
    assert rows(ia.validated(df)) == [(1, 1, 2.0)]
    assert tuple(ia.quality_counts(df).first()) == (4, 1, 2)
    stored, counts = ia.stored_with_counts(df)
    assert counts == {"row_count": 4, "null_scores": 1, "non_positive_scores": 2} and rows(stored) == rows(df)
    assert tuple(ia.quality_counts(df.where("false")).first()) == (0, 0, 0)
    with pytest.raises(ValueError):
        ia.validated(df.drop("interaction_score"))


def test_month_period_wraps_the_year():
    assert ia.month_period(2024, 12) == (dt.date(2024, 12, 1), dt.date(2025, 1, 1))
    assert ia.month_period(2024, 1) == (dt.date(2024, 1, 1), dt.date(2024, 2, 1))


def test_stats_describe_and_distribution(spark):
    rng = np.random.default_rng(3)
    values = [(int(u), b, float(s)) for b, (u, s) in enumerate(zip(rng.integers(0, 9, 200), rng.random(200)))]
    df = scores(spark, values)
    assert tuple(ia.stats(df).first()) == (200, len({v[0] for v in values}), 200)
    assert ia.approximate_stats(df).first()["row_count"] == 200
    got = {r["statistic"]: r["value"] for r in ia.describe(df).collect()}
    x = np.array([v[2] for v in values])
    want = dict(zip(["25%", "50%", "75%"], np.quantile(x, [0.25, 0.5, 0.75])))
    want |= {"count": 200, "mean": x.mean(), "std": x.std(ddof=1), "min": x.min(), "max": x.max()}
    assert got == pytest.approx(want)
    counts = ia.user_counts(df)
    n = np.unique([v[0] for v in values], return_counts=True)[1]
    assert tuple(ia.count_distribution(counts).first()) == (n.min(), n.max(), np.median(n))
    assert tuple(ia.count_distribution(counts.limit(0)).first()) == (0, 0, 0.0)


def test_empty_sources_flow_through(spark):
    empty = ia.interaction_scores(sales(spark, []), carts(spark), reviews(spark), AS_OF)
    assert empty.count() == 0
    assert ia.stats(empty).first()["row_count"] == 0


def test_of_users_keeps_only_the_asked(spark):
    df = scores(spark, [(u, b, 1.0) for u in range(4) for b in range(3)])
    asked = spark.createDataFrame([(1,), (1,), (9,)], "user_id long")
    assert rows(ia.of_users(df, asked), "user_id", "book_id") == [(1, 0), (1, 1), (1, 2)]


def test_range_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "s")
    sales(spark, [(1, 1, at(1), "completed")]).write.parquet(path)
    df = ia.between(ia.completed(spark.read.parquet(path)), "order_date", end=AS_OF)
    text = plan(df.select("buyer_id"))
    assert "LessThan(order_date" in text and "EqualTo(item_status,completed)" in text
    assert "book_id" not in text
