"""Routing, freshness, sources and the session folder."""

import dataclasses
import datetime as dt
import json
import uuid

import numpy as np
import pytest
from helpers import AS_OF, at, books, carts, factors, plan, reviews, rows, sales, scores

from shelfrank import session
from shelfrank.config import ColdStartConfig
from shelfrank.operators import gold
from shelfrank.operators import interactions as ia
from shelfrank.plans.recommend import Inputs, recommend
from shelfrank.sources import tables
from shelfrank.session import fresh_path
from shelfrank.streaming import freshness

RNG = np.random.default_rng(4)
ALL_BOOKS = ColdStartConfig(min_book_interactions=1)


@pytest.fixture(scope="module")
def shop(spark):
    """Users 0..5: user 0 has no pairs, user 1 two, the others eight of 13 known books; 20 books."""
    pairs = [(1, b) for b in (0, 1)] + [(u, (u + b) % 14) for u in range(2, 6) for b in range(8)]
    shelf = books(
        spark,
        [(b, f"title {b}", f"author {b % 3}", f"cat {b % 4}", 3.0 + b / 10, b) for b in range(20)],
    )
    return Inputs(
        interactions=scores(spark, [(u, b, 1.0 + b) for u, b in pairs]),
        sales=sales(spark, [(u, b, at(1 + b), "completed") for u, b in pairs]),
        reviews=reviews(spark, [(u, b, 4.0, at(1 + b)) for u, b in pairs]),
        books=shelf,
        dim_users=spark.createDataFrame([(u,) for u in range(6)], "user_id long"),
        user_factors=factors(spark, RNG.normal(size=(6, 4))),
        item_factors=factors(spark, RNG.normal(size=(20, 4))),
    )


def test_every_user_has_one_source_and_ranks_without_gaps(shop):
    got = recommend(shop, cold_cfg=ALL_BOOKS).toPandas()
    sources = got.groupby("user_id").source.unique()
    assert {u: list(s) for u, s in sources.items()} == {
        0: ["cold"], 1: ["hybrid"], 2: ["warm"], 3: ["warm"], 4: ["warm"], 5: ["warm"],
    }
    for _, part in got.groupby("user_id"):
        assert sorted(part["rank"]) == list(range(1, len(part) + 1)) and len(part) <= 5
        assert part.book_id.is_unique
    seen = {(r["user_id"], r["book_id"]) for r in shop.interactions.collect()}
    warm = got[got.source == "warm"]
    assert not set(zip(warm.user_id, warm.book_id)) & seen
    assert warm.semantic_score.notna().all() and got[got.source == "cold"].popularity_score.notna().all()


def test_requests_honour_length_and_unknown_users(spark, shop):
    asked = spark.createDataFrame([(2, 3), (2, 1), (1, None), (99, 2)], "user_id long, top_k int")
    got = recommend(shop, asked, ALL_BOOKS).toPandas()
    sizes = got.groupby(["user_id", "top_k", "source"]).size().to_dict()
    assert sizes == {(2, 3, "warm"): 3, (2, 1, "warm"): 1, (1, 5, "hybrid"): 5, (99, 2, "cold"): 2}
    whole = recommend(shop, cold_cfg=ALL_BOOKS).toPandas()
    full = whole[whole.user_id == 2].sort_values("rank").book_id.tolist()
    assert got[(got.user_id == 2) & (got.top_k == 3)].sort_values("rank").book_id.tolist() == full[:3]


def test_bought_cold_books_and_books_nobody_knows_are_not_recommended(spark, shop):
    """Book 13 is one user's alone: too few users know it, and its owner must not get it either."""
    more = shop.interactions.unionByName(scores(spark, [(2, 13, 50.0)]))
    shifted = [(u, [1.0]) for u in range(6)], [(b, [100.0 if b in (13, 19) else 1.0 - b / 99]) for b in range(20)]
    sides = [spark.createDataFrame(rows_, "id long, features array<float>") for rows_ in shifted]
    shop = dataclasses.replace(shop, interactions=more, user_factors=sides[0], item_factors=sides[1])
    got = recommend(shop, cold_cfg=ColdStartConfig(min_book_interactions=2)).toPandas()
    warm = got[got.source == "warm"]
    assert len(warm) and not set(warm.book_id) & {13, 19}
    got = recommend(shop, cold_cfg=ALL_BOOKS).toPandas()
    assert 13 not in set(got[(got.user_id == 2) & (got.source == "warm")].book_id)


def test_warm_users_without_vectors_get_popular_books(shop):
    some = dataclasses.replace(shop, user_factors=shop.user_factors.where("id <> 3"))
    got = recommend(some, cold_cfg=ALL_BOOKS).toPandas()
    assert set(got.user_id) == set(range(6))
    assert set(got[got.user_id == 3].source) == {"cold"} and (got.user_id == 3).sum() == 5


def test_long_requests_are_answered_in_full(spark, shop):
    asked = spark.createDataFrame([(0, 14), (2, 2)], "user_id long, top_k int")
    got = recommend(shop, asked, ALL_BOOKS).toPandas()
    # 15 of the 20 books are rated well enough to be popular
    assert got.groupby("user_id").size().to_dict() == {0: 14, 2: 2}


def test_a_pluggable_scorer_replaces_the_native_one(shop):
    def load():
        return lambda profile, description: np.zeros(len(profile))

    got = recommend(shop, scorer=load, cold_cfg=ALL_BOOKS).toPandas()
    assert set(got[got.source == "warm"].semantic_score) == {0.5}


def test_missing_user_dimension_is_tolerated(shop):
    import dataclasses

    got = recommend(dataclasses.replace(shop, dim_users=None), cold_cfg=ALL_BOOKS).toPandas()
    assert sorted(got.user_id.unique()) == [1, 2, 3, 4, 5]


# ---- freshness -------------------------------------------------------------------------------


def event_files(spark, folder, batches):
    for batch in batches:
        spark.createDataFrame(
            batch,
            "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
        ).coalesce(1).write.mode("append").parquet(folder)


EVENTS = [
    (n, at(1 + n % 20, n % 24), n % 7, ["click", "view", "purchase"][n % 3], float(n % 90), f'{{"k": {n % 5}}}')
    for n in range(200)
]


def test_replayed_files_add_nothing(spark, tmp_path):
    folder = str(tmp_path / "in")
    event_files(spark, folder, [EVENTS[:120], EVENTS[:120], EVENTS[100:]])
    stream = freshness.event_stream(spark, folder, files_per_batch=1)
    got = freshness.deduplicated(stream, "60 days")
    assert sorted(r["event_id"] for r in got.collect()) == list(range(200))


def test_running_scores_equal_the_batch_formula(spark, tmp_path):
    folder = str(tmp_path / "in")
    event_files(spark, folder, [EVENTS[:50], EVENTS[50:130], EVENTS[130:]])
    stream = freshness.event_stream(spark, folder, files_per_batch=1)
    everything = spark.read.schema(freshness.EVENT_SCHEMA).parquet(folder)
    for day in (AS_OF, dt.date(2024, 1, 9)):
        feeds = [freshness.scored_events(stream), freshness.scored_events(stream)]
        got = freshness.running_scores(feeds, day)
        batch = ia.decay(freshness.scored_events(everything), day).groupBy("user_id", "book_id")
        want = {tuple(r)[:2]: 2 * r[2] for r in batch.sum("decayed_score").collect()}
        assert {tuple(r)[:2]: r[2] for r in got.collect()} == pytest.approx(want)


def test_volume_and_changed_users(spark, tmp_path):
    folder = str(tmp_path / "in")
    event_files(spark, folder, [EVENTS[:90], EVENTS[90:]])
    volume = freshness.daily_volume(freshness.event_stream(spark, folder, files_per_batch=1), "60 days")
    assert sorted(r["n_events"] for r in volume.collect()) == [10] * 20
    assert freshness.refresh_days(volume, 11).count() == 0
    marks = freshness.changed_users(freshness.event_stream(spark, folder), ("purchase",))
    want = {}
    for _, ts, user, kind, _, _ in EVENTS:
        if kind == "purchase":
            want[user] = max(ts, want.get(user, ts))
    assert {r["user_id"]: r["last_event"] for r in marks.collect()} == want


def test_empty_stream_gives_an_empty_table(spark, tmp_path):
    folder = str(tmp_path / "in")
    event_files(spark, folder, [[]])
    assert freshness.deduplicated(freshness.event_stream(spark, folder)).count() == 0


def test_snapshot_expiry_version_and_invalidation(spark):
    from pyspark.sql import functions as F

    recs = spark.createDataFrame([(1, 10), (2, 10)], "user_id long, book_id long")
    made = F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")
    snap = freshness.build_snapshot(recs, made, 3)
    assert freshness.valid_rows(snap, dt.datetime(2024, 1, 11, 11, 59), 3).count() == 2
    assert freshness.valid_rows(snap, dt.datetime(2024, 1, 11, 12), 3).count() == 0
    assert freshness.valid_rows(snap, dt.datetime(2024, 1, 10, 13), 4).count() == 0
    happened = freshness.invalidating_events(
        sales(spark, [(1, 5, at(11), "pending"), (2, 5, at(9), "completed")]),
        reviews(spark, [(1, 5, 1.0, at(12)), (3, 5, 5.0, at(12))]),
    )
    assert rows(freshness.stale_users(snap, happened), "user_id") == [(1,)]


# ---- sources ---------------------------------------------------------------------------------


def test_csv_and_manifest(spark, tmp_path):
    df = spark.sql(
        "SELECT 1L cart_id, 2L buyer_id, 3L book_id, 1 quantity, timestamp'2024-01-02 03:04:05' added_at"
    )
    tables.write_csv(df, str(tmp_path), "fact_cart")
    again = tables.read_csv(spark, str(tmp_path), "fact_cart")
    assert rows(again) == [(1, 2, 3, 1, dt.datetime(2024, 1, 2, 3, 4, 5))]
    absent = tables.optional_source(tables.read_parquet, spark, str(tmp_path), "nothing")
    assert absent is None
    got = rows(tables.manifest(spark, {"fact_cart": again, "dim_books": None}))
    assert got == [("dim_books", False, 0, 0), ("fact_cart", True, 1, 5)]
    with pytest.raises(FileNotFoundError, match="dim_books"):
        tables.require_sources({"fact_cart": again, "dim_books": None})
    tables.publish(again, "carts_view")
    assert tables.query(spark, "SELECT quantity + :n FROM carts_view", {"n": 2}).first()[0] == 3
    assert tables.qualified("dim_books") == "main.gold.dim_books"


def test_seed_object_with_missing_arrays(spark, tmp_path):
    path = tmp_path / "seed.json"
    path.write_text(json.dumps({"buyers": [{"username": "u1"}, {"username": None, "is_active": False}]}, indent=2))
    parts = tables.read_seed(spark, str(path))
    assert parts["sellers"].count() == 0 and parts["products"].count() == 0
    people = parts["buyers"].selectExpr("row_number() over (order by username) user_id", "*").selectExpr(
        "user_id", "username", "full_name", "email", "cast(null as string) role", "is_active"
    )
    assert rows(gold.dim_users(people)) == [
        (1, "user", "Unknown", "unknown@example.com", "buyer", False),
        (2, "u1", "Unknown", "unknown@example.com", "buyer", True),
    ]


def test_sales_keys_take_the_last_title_and_default_seller(spark):
    products = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "book_id long, title string")
    shops = spark.createDataFrame([(7, "s")], "seller_id long, seller_username string")
    lines = spark.createDataFrame(
        [("a", "s", 1.5, 3), ("b", "x", 2.0, 1), ("gone", "s", 1.0, 1)],
        "title string, seller_username string, unit_price double, quantity int",
    )
    got = rows(gold.sales_with_keys(lines, products, shops), "book_id", "seller_id", "line_total")
    assert got == [(2, 1, 2.0), (3, 7, 4.5)]


def test_books_without_sales_or_reviews_get_zeros(spark):
    products = spark.createDataFrame(
        [(1, " a  b ", None, "c", 2.0, None), (2, "x", "y", "", None, "s")],
        "book_id long, title string, author string, category_name string, price double, seller_username string",
    )
    sold = spark.createDataFrame([(1,), (1,)], "book_id long")
    got = gold.dim_books(products, sold, reviews(spark, [(9, 1, 4.0, at(1)), (9, 1, 5.0, at(1)), (8, 1, 5.0, at(1))]))
    assert rows(got, "book_id", "title", "author", "category_name", "price", "seller_username", "purchase_count", "rating_avg") == [
        (1, "a b", "Unknown", "c", 2.0, "unknown", 2, 4.67),
        (2, "x", "y", "Unknown", 0.0, "s", 0, 0.0),
    ]


def test_dim_date(spark):
    dates = gold.calendar_dates(
        sales(spark, [(1, 1, at(6), "completed"), (1, 1, at(6, 20), "completed")]),
        carts(spark, [(1, 1, at(8))]),
        reviews(spark),
    )
    assert rows(gold.dim_date(dates)) == [
        (dt.date(2024, 1, 6), 2024, 1, 6, "Saturday", 1, True),
        (dt.date(2024, 1, 8), 2024, 1, 8, "Monday", 1, False),
    ]


class FakeSession:
    """Just what the folder lookup asks of a session."""

    def __init__(self, setting, master):
        self.conf = {"spark.checkpoint.dir": setting}
        self.sparkContext, self.master, self.made = self, master, None

    def getCheckpointDir(self):
        return self.made

    def setCheckpointDir(self, folder):
        self.made = folder


def test_shared_folder_is_the_cluster_setting():
    assert session.shared_folder(FakeSession("hdfs://shared/x/", "yarn")) == "hdfs://shared/x"
    with pytest.raises(ValueError):
        session.shared_folder(FakeSession(None, "yarn"))
    local = FakeSession(None, "local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)


def test_published_tables_are_joined_without_a_shuffle(spark):
    left = spark.range(500).selectExpr("id % 50 AS user_id", "id AS book_id")
    right = spark.range(300).selectExpr("id % 60 AS user_id", "id * 2 AS total")
    names = [f"published_{uuid.uuid4().hex[:8]}" for _ in range(2)]
    for name, df in zip(names, (left, right), strict=True):
        tables.publish(df, name, True, 4, path=fresh_path(spark, name))
    a, b = (tables.warehouse_table(spark, n, "spark_catalog", "default") for n in names)
    joined = a.groupBy("user_id").count().hint("merge").join(b.groupBy("user_id").agg({"total": "sum"}), "user_id")
    text = plan(joined)
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert joined.count() == 50 and joined.agg({"count": "sum"}).first()[0] == 500
    plain = a.groupBy("book_id").count()
    assert "Exchange" in plan(plain) and plain.count() == 500
    for name in names:
        spark.sql(f"DROP TABLE {name}")
