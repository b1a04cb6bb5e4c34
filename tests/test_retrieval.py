import numpy as np
import pyarrow as pa
import pytest
from helpers import factors, rows, scores
from pyspark.sql import functions as F

from shelfrank.functions.vectors import to_binary
from shelfrank.operators import retrieval
from shelfrank.operators.grid import Grid

RNG = np.random.default_rng(5)
U = RNG.normal(size=(40, 6)).round(1)
V = RNG.normal(size=(70, 6)).round(1)
V[60:] = V[50:60]  # ties
SEEN = sorted({(int(a), int(b)) for a, b in zip(RNG.integers(0, 40, 900), RNG.integers(0, 70, 900))})
# User 0 owns every book, user 1 none.
SEEN = [s for s in SEEN if s[0] > 1] + [(0, b) for b in range(70)]

GRIDS = [None, Grid(3, 1), Grid(2, 4)]


def brute(user, depth):
    score = (V.astype(np.float32).astype(float) @ U[user].astype(np.float32).astype(float)).round(12)
    order = sorted(range(len(V)), key=lambda b: (-score[b], b))
    return [(b, score[b]) for b in order[:depth]]


@pytest.mark.parametrize("grid", GRIDS)
def test_best_scored_is_exact_with_ties(spark, grid):
    got = retrieval.best_scored(factors(spark, U), factors(spark, V), 9, grid=grid).toPandas()
    for user in range(40):
        part = got[got.user_id == user].sort_values("rank")
        want = brute(user, 9)
        assert part.book_id.tolist() == [b for b, _ in want]
        assert part.mf_score.tolist() == pytest.approx([s for _, s in want], abs=2e-6)
        assert part["rank"].tolist() == list(range(1, 10))


@pytest.mark.parametrize("grid", GRIDS)
@pytest.mark.parametrize("overfetch", [2, None])
def test_candidates_skip_seen_books(spark, grid, overfetch):
    seen = scores(spark, [(u, b, 1.0) for u, b in SEEN])
    got = retrieval.generate_candidates(
        factors(spark, U), factors(spark, V), seen, k=8, overfetch=overfetch, grid=grid
    ).toPandas()
    owned = set(SEEN)
    for user in range(40):
        part = got[got.user_id == user].sort_values("rank").candidate_book_id.tolist()
        pool = brute(user, 16 if overfetch else 70)
        want = [b for b, _ in pool if (user, b) not in owned][:8]
        # User 1 has no interaction and is not asked for.
        assert part == ([] if user == 1 else want)
    assert retrieval.quality(
        retrieval.generate_candidates(factors(spark, U), factors(spark, V), seen, 8, grid=grid), seen
    ).first()["leaked_rows"] == 0


def test_exact_mode_fills_the_list_of_a_heavy_user(spark):
    order = [b for b, _ in brute(3, 70)]
    seen = scores(spark, [(3, b, 1.0) for b in order[:60]])
    args = factors(spark, U), factors(spark, V), seen, 5
    assert retrieval.generate_candidates(*args, overfetch=2).count() == 0
    full = retrieval.generate_candidates(*args, overfetch=None)
    assert [r["candidate_book_id"] for r in full.orderBy("rank").collect()] == order[60:65]


def test_fewer_books_than_wanted_and_no_books(spark):
    few = retrieval.best_scored(factors(spark, U[:3]), factors(spark, V[:2]), 9)
    assert few.count() == 6
    assert retrieval.best_scored(factors(spark, U[:3]), factors(spark, V).limit(0), 9).count() == 0
    assert retrieval.best_scored(factors(spark, U).limit(0), factors(spark, V), 9).count() == 0


def test_score_pairs_of_unknown_ids(spark):
    pairs = spark.createDataFrame([(0, 0), (0, 99), (99, 0)], "user_id long, book_id long")
    users, items = factors(spark, [[1.0, 2.0]]), factors(spark, [[3.0, 4.0]])
    assert rows(retrieval.score_pairs(pairs, users, items)) == [(0, 0, 11.0), (0, 99, 0.0), (99, 0, 0.0)]
    assert rows(retrieval.score_pairs(pairs, users, items, "drop")) == [(0, 0, 11.0)]


def test_requests_with_open_length_and_unknown_user(spark):
    asked = spark.createDataFrame([(0, None), (1, 2), (77, 3)], "user_id long, top_k int")
    got = retrieval.recommend_requests(asked.union(asked), factors(spark, U), factors(spark, V)).toPandas()
    assert got.groupby("user_id").size().to_dict() == {0: 5, 1: 2}
    long = spark.createDataFrame([(0, 33), (1, 2)], "user_id long, top_k int")
    answered = retrieval.recommend_requests(long, factors(spark, U), factors(spark, V)).toPandas()
    assert answered.groupby("user_id").size().to_dict() == {0: 33, 1: 2}
    first = got[got.user_id == 0].sort_values("rank").book_id.tolist()
    assert first == [b for b, _ in brute(0, 5)]


def test_lists_keep_the_rank_order(spark):
    ranked = spark.createDataFrame([(1, 9, 2), (1, 4, 1), (2, 3, 1)], "user_id long, book_id long, rank int")
    assert rows(retrieval.as_lists(ranked)) == [(1, [4, 9]), (2, [3])]


def test_short_vectors_are_left_out(monkeypatch):
    rng = np.random.default_rng(8)
    u = rng.normal(size=(30, 6))
    v = rng.normal(size=(2000, 6)) / np.arange(1, 2001)[:, None] ** 1.5
    v = v[rng.permutation(2000)]
    v[5] = v[6]
    monkeypatch.setattr(retrieval, "ITEM_CHUNK", 50)
    seen = rng.integers(0, 30, 600), rng.integers(0, 2000, 600)
    mark = np.zeros((30, 2000), dtype=bool)
    mark[seen] = True
    product = np.round(u @ v.T, 12)
    for skip in (False, True):
        places, scores, flags, blocks = retrieval.top_products(u, v, 10, seen, skip)
        key = np.where(mark, -np.inf, product) if skip else product
        want = np.lexsort((np.broadcast_to(np.arange(2000), key.shape), -key), axis=1)[:, :10]
        assert (places == want).all() and blocks < 20
        assert (scores == np.take_along_axis(product, want, 1)).all()
        assert (flags == np.take_along_axis(mark, want, 1)).all()
    # vectors of one length leave nothing out; more places than rows give all rows
    even = v / np.linalg.norm(v, axis=1)[:, None]
    assert retrieval.top_products(u, even, 10, (seen[0][:0], seen[1][:0]))[3] == 40
    places, *_ = retrieval.top_products(u, v[:7], 10, (seen[0][:0], seen[1][:0]))
    assert sorted(places[0]) == list(range(7))


def test_blocks_of_short_books_meet_no_users(spark, monkeypatch):
    rng = np.random.default_rng(9)
    long, short = rng.normal(size=(60, 6)) + 3, rng.normal(size=(240, 6)) / 1000
    v = np.concatenate([short, long])
    u = np.abs(rng.normal(size=(40, 6))) + 1
    met = []
    cells = retrieval._in_cells
    monkeypatch.setattr(retrieval, "_in_cells", lambda users, *rest: met.append(users.count()) or cells(users, *rest))
    got = retrieval.best_scored(factors(spark, u), factors(spark, v), 5, grid=Grid(2, 5)).toPandas()
    assert met == [40]
    for user in range(40):
        score = v.astype(np.float32).astype(float) @ u[user].astype(np.float32).astype(float)
        assert got[got.user_id == user].sort_values("rank").book_id.tolist() == list(np.argsort(-score)[:5])


def test_pairs_without_factors_do_not_travel(spark, monkeypatch):
    """Pairs of unknown users or books cannot change a list, so cells are not sized or filled by them."""
    met = []
    cells = retrieval._in_cells

    def spy(users, items, seen, *rest):
        met.append(seen.count())
        return cells(users, items, seen, *rest)

    monkeypatch.setattr(retrieval, "_in_cells", spy)
    known = [s for s in SEEN if s[0] % 2 == 0]
    unknown = [(u, b) for u in range(900, 920) for b in range(70)] + [(u, b) for u in range(40) for b in range(500, 520)]
    seen = scores(spark, [(u, b, 1.0) for u, b in known + unknown])
    got = retrieval.generate_candidates(factors(spark, U), factors(spark, V), seen, k=8).toPandas()
    assert met == [len(known)]
    owned = set(known)
    for user in range(2, 40):
        want = [b for b, _ in brute(user, 70) if (user, b) not in owned][:8]
        assert got[got.user_id == user].sort_values("rank").candidate_book_id.tolist() == want


def test_single_precision_only_prepares(monkeypatch):
    """Products that single precision cannot tell apart are ranked by doubles, and few of them are taken in doubles."""
    rng = np.random.default_rng(12)
    v = rng.normal(size=(900, 8)).astype(np.float32)
    v[300:] = v[rng.integers(0, 20, 600)]
    v[300:, 0] = np.nextafter(v[300:, 0], np.float32(9)) + np.float32(0)
    u = rng.normal(size=(50, 8)).astype(np.float32)
    monkeypatch.setattr(retrieval, "ITEM_CHUNK", 128)
    rows = []
    einsum = np.einsum
    monkeypatch.setattr(np, "einsum", lambda s, x, y, **kw: rows.append(len(x)) or einsum(s, x, y, **kw))
    places, scores_, _, _ = retrieval.top_products(u, v, 5, (np.zeros(0, int), np.zeros(0, int)))
    assert sum(rows) < 50 * 900 / 2
    product = np.round(u.astype(float) @ v.astype(float).T, 12)
    want = np.lexsort((np.broadcast_to(np.arange(900), product.shape), -product), axis=1)[:, :5]
    assert (places == want).all() and np.allclose(scores_, np.take_along_axis(product, want, 1), atol=2e-12)
    # vectors beyond single precision are taken in doubles throughout
    huge = retrieval.top_products(u.astype(float) * 1e30, v, 5, (np.zeros(0, int), np.zeros(0, int)))[0]
    assert (np.take_along_axis(product, huge, 1) == np.take_along_axis(product, want, 1)).all()


@pytest.mark.parametrize("blocks", [8, 13])
def test_no_two_cells_meet_in_one_task(spark, blocks):
    rng = np.random.default_rng(3)
    u, v = rng.standard_normal((300, 4)), rng.standard_normal((20, 4))
    grid = Grid(blocks, 1)
    best = retrieval._in_cells(factors(spark, u), factors(spark, v), None, grid, 1, False, None)
    dealt = best.select(F.spark_partition_id().alias("task"), grid.user_block("user_id").alias("block")).distinct().collect()
    assert len(dealt) == len({r["task"] for r in dealt}) == len({r["block"] for r in dealt}) == blocks


def like_users(rng, n_groups, n_users, n_books, width=24, apart=0.4):
    """Users and books around a few directions, of about equal lengths, and users and books with no direction at all."""
    centres = rng.normal(size=(n_groups, width))
    u, v = (centres[rng.integers(n_groups, size=n)] + apart * rng.normal(size=(n, width)) for n in (n_users, n_books))
    u[:3], v[:5] = 0, 0
    u, v = (x / np.maximum(np.linalg.norm(x, axis=1)[:, None], 1e-9) for x in (u, v))
    return u.astype(np.float32), v.astype(np.float32)


def test_bounds_of_a_direction_and_the_sieve_leave_nothing_out():
    rng = np.random.default_rng(21)
    for groups, apart in ((5, 0.4), (30, 0.1), (1, 3.0)):
        u, v = like_users(rng, groups, 400, 3000, apart=apart)
        v *= rng.uniform(0.1, 3, size=(3000, 1)).astype(np.float32)
        product = u.astype(float) @ v.T.astype(float)
        length, length_v = retrieval._lengths(u), retrieval._lengths(v)
        centres, nearest = retrieval.directions(u)
        assert len(nearest) == 400 and np.allclose(np.linalg.norm(centres, axis=1), 1, atol=1e-5)
        for n, centre in enumerate(centres):
            own = np.flatnonzero(nearest == n)
            limit = retrieval.limits_along(u[own], centre, (v @ centre).astype(float), length_v)
            assert (product[own] <= length[own][:, None] * limit + 1e-12).all()
            least = np.sort(product[own], axis=1)[:, -10]
            passed = retrieval.sieve_for(u[own], v, length_v)(least, np.arange(3000))
            assert (product[own] >= least[:, None]).any(axis=0)[~passed].sum() == 0


@pytest.mark.parametrize("skip", [False, True])
def test_a_cell_of_users_of_few_directions_multiplies_few_books(monkeypatch, skip):
    """Lengths are equal, so only directions can leave books out: the result is that of all products."""
    rng = np.random.default_rng(22)
    u, v = like_users(rng, 6, 300, 20_000, apart=0.15)
    monkeypatch.setattr(retrieval, "ITEM_CHUNK", 256)
    monkeypatch.setattr(retrieval, "LIKE_USERS", 32)
    seen = rng.integers(0, 300, 2000), rng.integers(0, 20_000, 2000)
    mark = np.zeros((300, 20_000), dtype=bool)
    mark[seen] = True
    blocks, top = [], retrieval.top_products

    def counted(*args):
        found = top(*args)
        blocks.append(found[3] * len(args[0]) * 256)
        return found

    monkeypatch.setattr(retrieval, "top_products", counted)
    kind = np.r_[np.zeros(300, int), np.ones(2000, int)]
    users = pa.table({
        "kind": kind, "user_id": np.r_[np.arange(300), seen[0]], "book_id": pa.array([None] * 300 + seen[1].tolist(), pa.int64()),
        "vec": pa.chunked_array([to_binary(u), pa.nulls(2000, pa.binary())]).combine_chunks(),
    })
    books = pa.table({"book_id": np.arange(20_000), "vec": to_binary(v)})
    got = retrieval._best_in_cell(7, skip, None)(users, books).to_pandas().sort_values(["user_id", "rank"])
    key = np.round(u.astype(float) @ v.T.astype(float), 12)
    key = np.where(mark, -np.inf, key) if skip else key
    want = np.lexsort((np.broadcast_to(np.arange(20_000), key.shape), -key), axis=1)[:, :7]
    assert got.book_id.to_numpy().reshape(300, 7).tolist() == want.tolist()
    assert sum(blocks) < 300 * 20_000 / 3


def test_a_known_last_place_keeps_rows_in_the_cell():
    rng = np.random.default_rng(23)
    u, v = like_users(rng, 3, 50, 5000)
    product = np.round(u.astype(float) @ v.T.astype(float), 12)
    least = np.sort(product, axis=1)[:, -3]
    least[7] = np.nan
    left = pa.table({
        "kind": np.zeros(50, int), "user_id": np.arange(50), "book_id": pa.nulls(50, pa.int64()), "vec": to_binary(u),
        "least": pa.array(least, from_pandas=True),
    })
    got = retrieval._best_in_cell(9, True, None)(left, pa.table({"book_id": np.arange(5000), "vec": to_binary(v)})).to_pandas()
    for user in range(3, 50):
        want = np.lexsort((np.arange(5000), -product[user]))[:9]
        want = [b for b in want if user == 7 or product[user, b] >= least[user]]
        assert got[got.user_id == user].sort_values("rank").book_id.tolist() == want


def test_later_book_blocks_return_only_what_reaches_the_last_places(spark, monkeypatch):
    rng = np.random.default_rng(24)
    u, v = rng.normal(size=(60, 6)), rng.normal(size=(400, 6))
    rows_, cells = [], retrieval._in_cells

    def counted(*args):
        found = cells(*args).localCheckpoint()
        rows_.append(found.count())
        return found

    monkeypatch.setattr(retrieval, "_in_cells", counted)
    seen = scores(spark, [(int(a), int(b), 1.0) for a, b in {(a, b) for a, b in zip(rng.integers(0, 60, 900), rng.integers(0, 400, 900))}])
    got = retrieval.best_scored(factors(spark, u), factors(spark, v), 10, seen, True, grid=Grid(2, 8)).toPandas()
    owned = {(r["user_id"], r["book_id"]) for r in seen.collect()}
    assert rows_[0] == 600 and sum(rows_[2:]) < 1000
    product = (u.astype(np.float32).astype(float) @ v.astype(np.float32).astype(float).T).round(12)
    for user in range(60):
        want = [b for b in sorted(range(400), key=lambda b: (-product[user, b], b)) if (user, b) not in owned][:10]
        assert got[got.user_id == user].sort_values("rank").book_id.tolist() == want
