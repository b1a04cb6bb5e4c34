import hashlib
import re

import numpy as np
import pytest
from helpers import books, rows, scores

from shelfrank.config import ColdStartConfig
from shelfrank.operators import coldstart


def interactions_with(spark, sizes):
    return scores(spark, [(u, b, 1.0) for u, n in sizes.items() for b in range(n)])


def test_user_groups_at_their_limits(spark):
    df = interactions_with(spark, {1: 1, 4: 4, 5: 5, 9: 9})
    people = spark.createDataFrame([(0,), (1,), (5,)], "user_id long")
    got = rows(coldstart.classify_users(df, people), "user_id", "n_books", "user_group")
    assert got == [(0, 0, "cold"), (1, 1, "hybrid"), (4, 4, "hybrid"), (5, 5, "warm"), (9, 9, "warm")]
    assert rows(coldstart.group_sizes(coldstart.classify_users(df, people))) == [
        ("cold", 1), ("hybrid", 2), ("warm", 2),
    ]
    assert rows(coldstart.user_universe(df, None)) == [(1,), (4,), (5,), (9,)]


def test_cold_books_leave_the_interactions(spark):
    # Book 0 has four users, book 1 three, book 2 two.
    df = scores(spark, [(u, b, 1.0) for b, n in ((0, 4), (1, 3), (2, 2)) for u in range(n)])
    kept, cold = coldstart.filter_cold_books(df)
    assert rows(cold) == [(2, 2)]
    assert {r["book_id"] for r in kept.collect()} == {0, 1} and kept.count() == 7


def catalogue(spark, n, seed=0):
    rng = np.random.default_rng(seed)
    return books(
        spark,
        [
            (b, f"t{b}", "a", "c", float(rng.choice([3.4, 3.5, 4.0, 4.5])), int(rng.integers(0, 5)))
            for b in range(n)
        ],
    )


def test_popularity_pool_by_brute_force(spark):
    df = catalogue(spark, 80)
    frame = df.toPandas()
    frame = frame[frame.rating_avg >= 3.5]
    share = lambda s: (s.rank(method="min") - 1) / (len(s) - 1)
    frame["p"] = (0.6 * share(frame.purchase_count) + 0.4 * share(frame.rating_avg)).round(6)
    want = frame.sort_values(["p", "book_id"], ascending=[False, True]).head(10)
    got = coldstart.popularity_pool(df).toPandas()
    assert got.book_id.tolist() == want.book_id.tolist()
    assert got.popularity_score.tolist() == pytest.approx(want.p.tolist(), abs=1e-6)


@pytest.mark.parametrize("n", [0, 1])
def test_pool_of_a_tiny_catalogue(spark, n):
    df = books(spark, [(b, "t", "a", "c", 4.0, 3) for b in range(n)])
    got = coldstart.popularity_pool(df).collect()
    assert [r["popularity_score"] for r in got] == [0.0] * n
    users = spark.createDataFrame([(1,), (2,)], "user_id long")
    sample = coldstart.sample_pool(users, coldstart.popularity_pool(df))
    assert sample.count() == 2 * n


def test_sample_is_a_fixed_draw_per_user(spark):
    pool = coldstart.popularity_pool(catalogue(spark, 60))
    users = spark.range(30).withColumnRenamed("id", "user_id")
    got = coldstart.sample_pool(users, pool).toPandas()
    ids = pool.toPandas().book_id
    for user, part in got.groupby("user_id"):
        want = sorted(ids, key=lambda b: hashlib.md5(f"{user}:{b}".encode()).hexdigest())[:5]
        assert part.sort_values("rank").book_id.tolist() == want
        assert sorted(part["rank"]) == [1, 2, 3, 4, 5]


def test_sample_smaller_pool_than_wanted(spark):
    pool = coldstart.popularity_pool(catalogue(spark, 60), ColdStartConfig(pool_size=3))
    users = spark.range(2).withColumnRenamed("id", "user_id")
    assert coldstart.sample_pool(users, pool, 5).groupBy("user_id").count().collect()[0]["count"] == 3


def test_blend_by_hand(spark):
    mf = spark.createDataFrame(
        [(1, 10, 2.0), (1, 11, 0.1), (2, 10, 1.0)], "user_id long, book_id long, mf_score double"
    )
    popular = spark.createDataFrame(
        [(1, 11, 0.9), (1, 12, 0.5), (3, 12, 0.5)],
        "user_id long, book_id long, popularity_score double",
    )
    got = rows(coldstart.hybrid_blend(mf, popular, 2), "user_id", "rank", "book_id", "hybrid_score")
    assert got == [(1, 1, 11, 0.66), (1, 2, 10, 0.6), (2, 1, 10, 0.3), (3, 1, 12, 0.35)]


def plain_similar(data, cold, k):
    """All pairs compared."""
    terms = {}
    for b, title, author, category, rating, _ in data:
        own = {}
        words = re.split(r"\s+", title.strip(" ").lower()) if title is not None else []
        for t, w in [(f"category={category}", 1.0), (f"author={author}", 1.0), *((f"title={x}", 1 / len(words) ** 0.5) for x in words)]:
            if not t.endswith("=None"):
                own[t] = own.get(t, 0.0) + w
        terms[b] = own, ((rating or 0.0) - 3) / 4
    out = []
    for a in cold:
        found = []
        for b in terms:
            if b not in cold:
                s = sum(w * terms[b][0].get(t, 0.0) for t, w in terms[a][0].items()) + terms[a][1] * terms[b][1]
                found.append((-round(s, 9) + 0.0, b))
        out += [(a, b, -s + 0.0, n) for n, (s, b) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def similar(df, cold, k=5):
    found = coldstart.similar_books(df, cold, k).select("book_id", "similar_book_id", "similarity", "rank")
    return sorted((r[0], r[1], round(r[2], 9) + 0.0, r[3]) for r in found.collect())


@pytest.mark.parametrize("seed", range(3))
def test_similar_books_are_those_of_all_pairs(spark, seed):
    r = np.random.default_rng(seed)
    words = ["red", "Green", "blue", "river", "hill", "sea", "of", "the"]
    data = []
    for b in range(150):
        title = " ".join(r.choice(words[: 8 if seed else 3], r.integers(1, 5))) if b % 17 else None
        author = f"A{r.integers(2 if seed == 1 else 30)}" if b % 13 else None
        data.append((b, title, author, "x" if b % 3 == 0 else f"c{r.integers(6)}", float(r.choice([0.0, 3.0, 3.5, 4.25, 5.0])), 1))
    data += [(200, "alone in here", "nobody else", "own kind", 3.0, 1), (201, "alone", "none", "other", 2.0, 1), (202, None, None, None, 4.0, 1)]
    cold = [b for b, *_ in data if b % 10 == 3] + [200, 201, 202]
    df = books(spark, data)
    asked = spark.createDataFrame([(b,) for b in cold], "book_id long")
    assert similar(df, asked) == plain_similar(data, set(cold), 5)


def test_similar_books_of_few_or_none(spark):
    data = [(1, "a b", "A", "x", 4.0, 1), (2, "a", "A", "x", 4.0, 1), (3, "c", "C", "z", 4.0, 1)]
    df = books(spark, data)
    one = spark.createDataFrame([(1,), (77,)], "book_id long")
    assert similar(df, one) == plain_similar(data, {1}, 5)
    assert similar(df, one.where("false")) == []
    assert similar(df, df.select("book_id")) == []
    assert similar(df.where("false"), one) == []


def test_frequent_terms_are_left_out(spark):
    """With a rare author in common, the category of all books cannot change the best books and is not read."""
    data = [(b, f"w{b % 50}", f"A{b // 8}", "all", 3.0, 1) for b in range(400)]
    asked = spark.createDataFrame([(b,) for b in range(0, 400, 40)], "book_id long")
    seen = []
    stored = coldstart.materialise

    def spy(df, name, *rest):
        out = stored(df, name, *rest)
        seen.append((name, out.count()))
        return out

    coldstart.materialise = spy
    try:
        got = similar(books(spark, data), asked)
    finally:
        coldstart.materialise = stored
    assert got == plain_similar(data, set(range(0, 400, 40)), 5)
    read = dict(seen)
    assert read["content-seeded"] + read["content-others"] <= 10 * 25  # of 3,900 pairs


@pytest.mark.parametrize("sizes", [(20_000, 100_000), (7, 40)])
def test_frequent_rarest_terms_make_no_rows_of_pairs(spark, monkeypatch, sizes):
    """Where even a book's rarest term is frequent, cells still hand on ``k`` rows a cold book each, however they are cut."""
    monkeypatch.setattr(coldstart, "COLD_PER_CELL", sizes[0])
    monkeypatch.setattr(coldstart, "WARM_PER_CELL", sizes[1])
    r = np.random.default_rng(4)
    data = [(b, f"w{r.integers(3)} w{r.integers(3)}", f"A{r.integers(3)}", f"c{r.integers(2)}", float(r.integers(0, 6)), 1) for b in range(400)]
    cold = list(range(0, 400, 20))
    stored, read = coldstart.materialise, {}

    def spy(df, name, *rest):
        out = stored(df, name, *rest)
        read[name] = out.count()
        return out

    monkeypatch.setattr(coldstart, "materialise", spy)
    got = similar(books(spark, data), spark.createDataFrame([(b,) for b in cold], "book_id long"))
    assert got == plain_similar(data, set(cold), 5)
    blocks = -(-380 // sizes[1])
    assert read["content-seeded"] <= 5 * len(cold) * blocks and read["content-more"] <= 5 * len(cold) * blocks
