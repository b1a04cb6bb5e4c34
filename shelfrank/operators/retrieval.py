"""Scoring users against books with factor vectors."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.functions.ordering import top_per_group
from shelfrank.functions.scalars import dot
from shelfrank.functions.vectors import longs, pack, to_matrix
from shelfrank.operators.grid import SEPARATE_CELLS, Grid, fit_grid, separate_keys
from shelfrank.operators.joins import frequent_keys, join_hot, join_listed
from shelfrank.session import materialise

# Floats of one user-chunk x book-chunk score matrix in a task, books of such a chunk, and rows multiplied at once after it.
CHUNK_CELLS = 2_000_000
ITEM_CHUNK = 4096
MERGED_ROWS = 50_000
# Share by which a bound must lie below a product, whose sum may be rounded.
SLACK = 1e-9
# Users of one direction that a cell looks at together on average, most directions of a cell, and passes that find them.
LIKE_USERS = 256
MAX_DIRECTIONS = 128
DIRECTION_PASSES = 6
# Directions along which the books are measured at once, and what that may be off in single precision, as a share of the length.
MEASURED = 16
OFF = 1e-5
# Shares of the dimensions in which the books may be sieved, books that are tried for that, and what a book that passes costs
# beside the product in all dimensions.
SIEVES = (0.125, 0.25, 0.375, 0.5)
TRIED = 1024
PASSED_COST = 1.5

BEST_SCHEMA = "user_id long, book_id long, mf_score double, seen boolean, rank int"


def score_pairs(
    pairs: DataFrame,
    user_factors: DataFrame,
    item_factors: DataFrame,
    unknown: str = "zero",
) -> DataFrame:
    """Dot product per (user_id, book_id); an id without factors scores 0.0 or drops its row.

    ``pairs`` is read twice, so it should be a stored table.
    """
    how = "left" if unknown == "zero" else "inner"
    users = user_factors.select(F.col("id").alias("user_id"), F.col("features").alias("_u"))
    items = item_factors.select(F.col("id").alias("book_id"), F.col("features").alias("_v"))
    hot_users, hot_books = frequent_keys(pairs, ["user_id", "book_id"])
    joined = join_hot(pairs, users, "user_id", how, ["book_id"], hot_users)
    joined = join_hot(joined, items, "book_id", how, ["user_id"], hot_books)
    score = F.coalesce(dot(F.col("_u"), F.col("_v")), F.lit(0.0))
    return joined.select(*pairs.columns, score.alias("mf_score"))


def _empty_best() -> pa.Table:
    return pa.table(
        {
            "user_id": pa.array([], pa.int64()),
            "book_id": pa.array([], pa.int64()),
            "mf_score": pa.array([], pa.float64()),
            "seen": pa.array([], pa.bool_()),
            "rank": pa.array([], pa.int32()),
        }
    )


def _lengths(x: np.ndarray) -> np.ndarray:
    """Length of every row in double precision, infinite where it is not a number."""
    return np.nan_to_num(np.sqrt(np.einsum("ij,ij->i", x, x, dtype=np.float64)), nan=np.inf, posinf=np.inf)


def _first_reach(low: np.ndarray, take: int, marks: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """The ``take``-th largest single-precision product per row, without the marked ones."""
    low = low.copy()
    if marks is not None:
        low[marks] = -np.inf
    return np.partition(low, low.shape[1] - take, axis=1)[:, low.shape[1] - take].astype(np.float64)


def top_products(
    u: np.ndarray,
    v: np.ndarray,
    depth: int,
    seen: tuple[np.ndarray, np.ndarray],
    skip_seen: bool = False,
    length_v: np.ndarray | None = None,
    limit_v: np.ndarray | None = None,
    floor: np.ndarray | None = None,
    sieve: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The ``depth`` rows of ``v`` with the largest products per row of ``u``: (places, products, seen, blocks scored).

    Ties go to the smaller place. ``seen`` has pairs (row of u, row of v); they are flagged, or with ``skip_seen`` come after
    all others. Rows of ``v`` are scored in blocks from the longest vector on: as no product exceeds the product of the
    lengths, the rest is left out as soon as that bound lies below the last place of every row of ``u``, and a row of ``u``
    that no bound reaches any more is left out before. ``limit_v`` bounds products more narrowly: none exceeds it times the
    length of the row of ``u``. Products below a row's ``floor`` need not be found. ``sieve`` tells, from the last places after
    the first block, which of some rows of ``v`` can reach one of them. A block is first
    multiplied in single precision; only products that reach a row's last place, less the largest error such a product can
    have, are taken in double precision and ranked, so the result is that of doubles throughout. Places that stay empty
    are ``len(v)``. ``length_v`` are the lengths of ``v`` if they are known.
    """
    n, width = v.shape if v.ndim == 2 else (0, 0)
    take = min(depth, n)
    length_u = _lengths(u)
    length_v = _lengths(v) if length_v is None else length_v
    limit = length_v if limit_v is None else limit_v
    floor = np.full(len(u), -np.inf) if floor is None else floor
    # only the rows of the first block are put in order before it is known what can still be reached
    by_limit = np.argpartition(-limit, ITEM_CHUNK)[:ITEM_CHUNK] if n > ITEM_CHUNK else np.arange(n)
    by_limit = by_limit[np.argsort(-limit[by_limit], kind="stable")]
    # Vectors whose products may leave single precision are all taken in doubles.
    narrow = bool(len(u)) and bool(n) and float(length_u.max()) < 1e15 and float(length_v.max()) < 1e15
    low_u = u.astype(np.float32) if narrow else None
    best = np.full((len(u), take), -np.inf)
    score, place, flag = best.copy(), np.full((len(u), take), n), np.zeros((len(u), take), dtype=bool)
    turn = np.full(n, -1, dtype=np.int64)
    turn[by_limit] = np.arange(len(by_limit))
    marked = np.unique(np.asarray(seen[0], dtype=np.int64) * n + np.asarray(seen[1], dtype=np.int64))
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, ...]:
        row, at = (np.concatenate(x) for x in zip(*waiting))
        waiting.clear()
        # Full values but for the digits in which equal sums differ by their order.
        own = np.empty(len(row))
        for start in range(0, len(row), MERGED_ROWS):
            part = slice(start, start + MERGED_ROWS)
            own[part] = np.einsum("ij,ij->i", u[row[part]].astype(np.float64), v[at[part]].astype(np.float64))
        own = np.nan_to_num(np.round(own, 12), nan=-np.inf)
        pair = row * n + at
        known = np.searchsorted(marked, pair)
        mark = known < len(marked)
        mark[mark] = marked[known[mark]] == pair[mark]
        key = np.where(mark, -np.inf, own) if skip_seen else own
        row = np.concatenate([np.repeat(np.arange(len(u)), take), row])
        columns = [np.concatenate([x.ravel(), y]) for x, y in ((best, key), (score, own), (place, at), (flag, mark))]
        order = np.lexsort((columns[2], -columns[0], row))
        nth = np.arange(len(row)) - np.searchsorted(row[order], np.arange(len(u)))[row[order]]
        order = order[nth < take]
        return tuple(x[order].reshape(len(u), take) for x in columns)

    scored, held, start = 0, 0, 0
    while start < n:
        # merged when as many wait as are held, and often at the start, when the last places still move a lot
        if waiting and (held >= len(u) * take or scored & (scored - 1) == 0):
            best, score, place, flag = merged()
            held = 0
        least = np.maximum(best[:, -1], floor)
        if scored == 1 and len(by_limit) < n:
            # the others that a row can reach
            with np.errstate(divide="ignore", invalid="ignore"):
                lowest = (least - SLACK) / (length_u * (1.0 + SLACK))
            lowest = np.where(length_u > 0, lowest, np.where(least > SLACK, np.inf, -np.inf))
            rest = np.flatnonzero((limit >= lowest.min(initial=np.inf) * (1.0 - SLACK) - SLACK) & (turn < 0))
            if sieve is not None and narrow:
                rest = rest[sieve(least, rest)]
            by_limit = np.concatenate([by_limit, rest[np.argsort(-limit[rest], kind="stable")]])
            turn[by_limit] = np.arange(len(by_limit))
        if start >= len(by_limit):
            break
        own = by_limit[start : start + ITEM_CHUNK]
        bound = length_u * limit[own[0]]
        within = bound + SLACK * (1.0 + bound) >= least
        if start >= take and not within.any():
            break
        scored += 1
        # of many rows that cannot be reached any more, none is multiplied
        part = np.flatnonzero(within) if start >= take and within.mean() < 0.8 else np.arange(len(u))
        if narrow:
            low = (low_u if len(part) == len(u) else low_u[part]) @ v[own].astype(np.float32, copy=False).T
            # what rounding to single precision and any order of the sum can change, doubled
            error = ((width + 8) * 2.0**-22 * length_u * float(length_v[own].max()) + width * 1e-36 + 2e-12)[part]
            reach = least[part] - error
            fresh = np.flatnonzero(np.isneginf(least[part])) if len(own) > take else ()
            if len(fresh):
                marks = None
                if skip_seen and len(marked):
                    here = turn[marked % n] - start
                    inside = (here >= 0) & (here < len(own))
                    of_fresh = np.full(len(u), -1)
                    of_fresh[part[fresh]] = np.arange(len(fresh))
                    rows = of_fresh[marked[inside] // n]
                    marks = rows[rows >= 0], here[inside][rows >= 0]
                reach[fresh] = _first_reach(low[fresh], take, marks) - 2 * error[fresh]
            reached = np.flatnonzero(low >= np.nextafter(reach.astype(np.float32), np.float32(-np.inf))[:, None])
        else:
            reached = np.arange(len(part) * len(own))
        row, column = np.divmod(reached, len(own))
        waiting.append((part[row], own[column]))
        held += len(row)
        start += len(own)
    if waiting:
        best, score, place, flag = merged()
    return place, score, flag, scored


def directions(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors, number of the nearest one per row): rows of ``u`` gathered by their direction, the same in any order
    of equal rows of ids."""
    length = np.linalg.norm(u, axis=1)
    unit = np.divide(u, length[:, None], out=np.zeros_like(u, dtype=np.float32), where=(length > 0)[:, None], casting="unsafe")
    wanted = min(MAX_DIRECTIONS, -(-len(u) // LIKE_USERS))
    rng = np.random.default_rng(0)
    centres = [unit[rng.integers(len(u))]]
    away = np.full(len(u), np.inf, dtype=np.float32)
    while len(centres) < wanted:
        # the next one is drawn by the squared distance from those there are
        away = np.minimum(away, np.maximum(1.0 - unit @ centres[-1], 0.0))
        share = np.cumsum(away, dtype=np.float64)
        if not share[-1] > 0:
            break
        centres.append(unit[min(np.searchsorted(share, rng.random() * share[-1]), len(u) - 1)])
    centres = np.array(centres)
    for _ in range(DIRECTION_PASSES):
        nearest = np.argmax(unit @ centres.T, axis=1)
        order = np.argsort(nearest, kind="stable")
        found = np.flatnonzero(np.r_[True, np.diff(nearest[order]) > 0])
        sums = np.add.reduceat(unit[order], found, axis=0, dtype=np.float64)
        size = np.linalg.norm(sums, axis=1)
        centres = (sums[size > 0] / size[size > 0, None]).astype(np.float32) if (size > 0).any() else centres
    return centres, np.argmax(unit @ centres.T, axis=1)


def limits_along(u: np.ndarray, centre: np.ndarray, along: np.ndarray, length_v: np.ndarray) -> np.ndarray:
    """What a product of a row of ``u`` with a row of ``v`` can be at most, as a share of the length of the former.

    ``along`` has the products of ``v`` with the unit vector ``centre`` in single precision. Of the angle between a user and
    a book no less is left than what the book's angle from the centre exceeds the widest angle of a user from it.
    """
    length_u = _lengths(u)
    with np.errstate(divide="ignore", invalid="ignore"):
        cosines = (u.astype(np.float64) @ centre.astype(np.float64)) / length_u
    cosines = cosines[length_u > 0]
    if not np.isfinite(cosines).all() or not np.isfinite(length_v).all():
        return length_v
    widest = np.clip(cosines.min(initial=1.0) - OFF, -1.0, 1.0)
    nearer = along + OFF * length_v
    aside = np.sqrt(np.maximum(length_v**2 - np.maximum(np.abs(along) - OFF * length_v, 0.0) ** 2, 0.0))
    narrowed = nearer * widest + aside * np.sqrt(1.0 - widest**2)
    return np.where(nearer >= length_v * widest, length_v, np.minimum(narrowed, length_v) * (1.0 + OFF))


def sieve_for(u: np.ndarray, v: np.ndarray, length_v: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function of the last places of the rows of ``u`` and of some rows of ``v``: which of these can reach one of them.

    A product is at most that of the parts inside a few dimensions and that of the lengths of the parts outside of them. The
    dimensions are those along which the rows of ``u`` lie; how many are taken is tried on some rows of ``v``.
    """
    width = u.shape[1]
    length_u = _lengths(u)
    unit = u / np.maximum(length_u, 1e-300)[:, None]
    axes = np.linalg.eigh(unit.T.astype(np.float64) @ unit)[1][:, ::-1].astype(np.float32)

    def reached(least: np.ndarray, some: np.ndarray, dims: int) -> np.ndarray:
        inside = u.astype(np.float64) @ axes[:, :dims]
        outside = np.sqrt(np.maximum(length_u**2 - (inside**2).sum(axis=1), 0.0) + OFF * length_u**2)
        left = np.column_stack([inside, outside, -np.maximum(least, -1e30)]).astype(np.float32)
        found = np.empty(len(some), dtype=bool)
        for start in range(0, len(some), ITEM_CHUNK):
            own = some[start : start + ITEM_CHUNK]
            right = np.empty((len(own), dims + 2), dtype=np.float32)
            np.matmul(v[own].astype(np.float32, copy=False), axes[:, :dims], out=right[:, :dims])
            length = length_v[own]
            rest = length**2 - np.einsum("ij,ij->i", right[:, :dims], right[:, :dims])
            right[:, dims] = np.sqrt(np.maximum(rest, 0.0) + 2 * OFF * length**2)
            right[:, dims + 1] = 1.0
            # what single precision can change in the sum
            error = OFF * (length_u.max(initial=0.0) * length + np.abs(left[:, -1]).max(initial=0.0))
            found[start : start + ITEM_CHUNK] = (left @ right.T).max(axis=0) >= -error
        return found

    def passing(least: np.ndarray, some: np.ndarray) -> np.ndarray:
        if not np.isfinite(least).all() or len(some) <= TRIED:
            return np.ones(len(some), dtype=bool)
        tried = some[:: len(some) // TRIED]
        costs = {d: (d + 2) / width + PASSED_COST * reached(least, tried, d).mean() for d in {int(width * x) for x in SIEVES} if d}
        dims = min(costs, key=costs.get, default=0)
        if not dims or costs[dims] >= PASSED_COST:
            return np.ones(len(some), dtype=bool)
        return reached(least, some, dims)

    return passing


def _best_in_cell(depth: int, skip_seen: bool, keep_unseen: int | None):
    """Cell function: the ``depth`` best books of the block for each user of the block.

    Seen books are flagged; ``skip_seen`` leaves them out before the cut at ``depth``, and
    ``keep_unseen`` drops them after it and keeps that many of the rest.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        is_user = left.column("kind").to_numpy(zero_copy_only=False) == 0
        users = left.filter(pa.array(is_user))
        if users.num_rows == 0 or right.num_rows == 0:
            return _empty_best()
        user_ids, item_ids = longs(users, "user_id"), longs(right, "book_id")
        # Ascending ids, so that a position doubles as the tie-break.
        by_user, by_item = np.argsort(user_ids), np.argsort(item_ids)
        user_ids, item_ids = user_ids[by_user], item_ids[by_item]
        u = to_matrix(users.column("vec"))[by_user]
        v = to_matrix(right.column("vec"))[by_item]
        length_u, length_v = _lengths(u), _lengths(v)

        pairs = left.filter(pa.array(~is_user))
        seen_u, seen_i = longs(pairs, "user_id"), longs(pairs, "book_id")
        pos_u = np.searchsorted(user_ids, seen_u)
        pos_i = np.searchsorted(item_ids, seen_i)
        known = (pos_u < len(user_ids)) & (pos_i < len(item_ids))
        known[known] = (user_ids[pos_u[known]] == seen_u[known]) & (
            item_ids[pos_i[known]] == seen_i[known]
        )
        pos_u, pos_i = pos_u[known], pos_i[known]
        order = np.argsort(pos_u, kind="stable")
        pos_u, pos_i = pos_u[order], pos_i[order]

        floor = np.full(len(user_ids), -np.inf)
        if "least" in users.column_names:
            floor = np.nan_to_num(users.column("least").to_numpy().astype(np.float64)[by_user], nan=-np.inf, neginf=-np.inf)

        def best(rows: np.ndarray, limit_v: np.ndarray, sieve: Callable | None = None) -> pa.Table:
            sizes = after[rows] - before[rows]
            of_row = np.repeat(np.arange(len(rows)), sizes)
            at = np.repeat(before[rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(of_row))
            places, scores, flags, _ = top_products(u[rows], v, depth, (of_row, pos_i[at]), skip_seen, length_v, limit_v, floor[rows], sieve)
            rank = np.tile(np.arange(1, places.shape[1] + 1, dtype=np.int32), (len(rows), 1))
            wanted = ~flags if skip_seen else np.ones_like(flags)
            if keep_unseen is not None:
                rank = np.cumsum(~flags, axis=1, dtype=np.int32)
                wanted = ~flags & (rank <= keep_unseen)
            wanted &= (places < len(item_ids)) & (scores >= floor[rows][:, None])
            owner = np.broadcast_to(user_ids[rows, None], flags.shape)
            columns = [owner, item_ids[np.minimum(places, len(item_ids) - 1)], scores, flags, rank]
            return pa.table(
                [c[wanted] for c in columns],
                names=["user_id", "book_id", "mf_score", "seen", "rank"],
            )

        before, after = (np.searchsorted(pos_u, np.arange(len(user_ids)), side=x) for x in ("left", "right"))
        step = max(1, CHUNK_CELLS // min(len(item_ids), ITEM_CHUNK))
        parts = []
        if len(item_ids) <= ITEM_CHUNK or not (np.isfinite(u).all() and np.isfinite(v).all()):
            # of so few books none can be left out
            parts = [best(np.arange(start, min(start + step, len(user_ids))), length_v) for start in range(0, len(user_ids), step)]
            return pa.concat_tables(parts)
        centres, nearest = directions(u)
        for first in range(0, len(centres), MEASURED):
            along = (v.astype(np.float32, copy=False) @ centres[first : first + MEASURED].T).T
            for n, centre in enumerate(centres[first : first + MEASURED]):
                rows = np.flatnonzero(nearest == first + n)
                # the widest angles last, so that they widen no other
                rows = rows[np.argsort(-(u[rows] @ centre) / np.maximum(length_u[rows], 1e-300), kind="stable")]
                measured = along[n].astype(np.float64)
                for start in range(0, len(rows), step):
                    own = rows[start : start + step]
                    parts.append(best(own, limits_along(u[own], centre, measured, length_v), sieve_for(u[own], v, length_v)))
        return pa.concat_tables(parts)

    return run


def _user_rows(factors: DataFrame, grid: Grid) -> DataFrame:
    """Rows of users, with the ``least`` that a product must reach if that is known."""
    return pack(factors, *[c for c in factors.columns if c == "least"]).select(
        grid.user_block("id").alias("ub"),
        F.lit(0).alias("kind"),
        F.col("id").alias("user_id"),
        F.lit(None).cast("long").alias("book_id"),
        "vec",
        *[c for c in factors.columns if c == "least"],
    )


def _in_cells(
    user_factors: DataFrame, item_factors: DataFrame, seen: DataFrame | None, grid: Grid, depth: int, skip_seen: bool, keep_unseen: int | None
) -> DataFrame:
    """The best books of one book block for every user, one cell a user block."""
    users = _user_rows(user_factors, grid)
    if seen is not None:
        users = users.unionByName(
            seen.select(
                grid.user_block("user_id").alias("ub"),
                F.lit(1).alias("kind"),
                "user_id",
                "book_id",
                F.lit(None).cast("binary").alias("vec"),
            ),
            allowMissingColumns=True,
        )
    items = pack(item_factors).select(grid.each_user_block().alias("ub"), F.col("id").alias("book_id"), "vec")

    tasks, cell = grid.tasks, F.col("ub")
    if grid.user_blocks <= SEPARATE_CELLS:
        # a cell is the most that a task may hold, so no two meet in one
        tasks = grid.user_blocks
        cell = F.element_at(F.array(*map(F.lit, separate_keys(user_factors.sparkSession, tasks))), F.col("ub") + 1)

    def spread(df: DataFrame) -> DataFrame:
        return df.withColumn("ub", cell).repartition(tasks, "ub").groupBy("ub")

    return spread(users).cogroup(spread(items)).applyInArrow(_best_in_cell(depth, skip_seen, keep_unseen), BEST_SCHEMA)


def best_scored(
    user_factors: DataFrame,
    item_factors: DataFrame,
    depth: int,
    seen: DataFrame | None = None,
    skip_seen: bool = False,
    keep_unseen: int | None = None,
    grid: Grid | None = None,
) -> DataFrame:
    """The ``depth`` best books per user by dot product, exact, with ties by book id.

    Users are cut into blocks by hash, books into blocks by the length of their vectors. A cell takes its users by the
    direction of their vectors (``directions``), scores the books from those on that can reach furthest (``limits_along``) and
    stops where no further product can be large enough (``top_products``); at most ``depth`` rows per user and book block
    leave it. With several book blocks these follow each other, the longest first, and a block meets only the
    users whose own length times the block's longest reaches their last place so far. ``seen`` pairs travel with the users:
    they are flagged, or left out before the cut at ``depth`` with ``skip_seen``, or dropped after it with ``keep_unseen``,
    which then limits the list.
    """
    grid = grid or fit_grid(user_factors, item_factors)
    if grid.item_blocks == 1:
        return _in_cells(user_factors, item_factors, seen, grid, depth, skip_seen, keep_unseen)

    cells = Grid(grid.user_blocks, 1)
    length = F.sqrt(dot(F.col("features"), F.col("features")))
    items = materialise(item_factors.select("id", "features", length.alias("_length")), "items-by-length")
    shares = [k / grid.item_blocks for k in range(1, grid.item_blocks)]
    bounds = sorted(set(items.approxQuantile("_length", shares, 0.1 / grid.item_blocks)), reverse=True)
    block = sum((F.when(F.col("_length") < x, 1).otherwise(0) for x in bounds), F.lit(0))
    items = materialise(items.select("id", "features", "_length", block.cast("int").alias("_block")), "items-by-length")
    longest = {r["_block"]: r["m"] for r in items.groupBy("_block").agg(F.max("_length").alias("m")).collect()}
    users = materialise(user_factors.select("id", "features"), "users-by-length")
    limits = users.select("id", length.alias("_length"), F.lit(None).cast("double").alias("_least"))
    if seen is not None:
        of_book = items.select(F.col("id").alias("book_id"), "_block")
        seen = materialise(join_listed(seen.select("user_id", "book_id"), of_book, ["book_id"], "inner"), "seen-by-length")
    found = []
    for n in sorted(longest):
        reach = F.col("_length") * F.lit(longest[n])
        limits = limits.where(F.col("_least").isNull() | (reach + SLACK * (1 + reach) >= F.col("_least")))
        limits = materialise(limits, "users-in-reach")
        if limits.isEmpty():
            break
        # only what reaches a user's last place so far leaves the cells
        active = join_listed(users, limits.select("id", F.col("_least").alias("least")), ["id"], "inner")
        own = None if seen is None else seen.where(F.col("_block") == n)
        best = _in_cells(active, items.where(F.col("_block") == n).drop("_block"), own, cells, depth, skip_seen, None)
        found.append(materialise(best, "best-by-length"))
        # the last place inside one block bounds the last place of all
        last = found[-1].groupBy("user_id").agg(F.count("*").alias("n"), F.min("mf_score").alias("_last")).where(F.col("n") == depth)
        limits = limits.join(last.select(F.col("user_id").alias("id"), "_last"), "id", "left").select(
            "id", "_length", F.greatest("_least", "_last").alias("_least")
        )
    best = reduce(DataFrame.unionByName, found) if found else users.sparkSession.createDataFrame([], BEST_SCHEMA)
    best = top_per_group(best.drop("rank"), ["user_id"], by_score(), depth)
    if keep_unseen is not None:
        unseen = best.where(~F.col("seen")).drop("rank")
        best = top_per_group(unseen, ["user_id"], by_score(), keep_unseen)
    return best


def generate_candidates(
    user_factors: DataFrame,
    item_factors: DataFrame,
    interactions: DataFrame,
    k: int = 50,
    overfetch: int | None = None,
    grid: Grid | None = None,
) -> DataFrame:
    """Top ``k`` unseen books per interaction user: (user_id, candidate_book_id, mf_score, rank).

    Seen books are dropped first, so every user with enough unseen books gets ``k``. With
    ``overfetch`` the best ``k * overfetch`` books are taken before seen ones are dropped: a heavy
    user may then get fewer.
    ``interactions`` is read more than once, so it should be a stored table.
    """
    active = user_factors.join(
        interactions.select(F.col("user_id").alias("id")).distinct(), "id", "left_semi"
    )
    # Only pairs of users and books that have factors travel to the cells.
    seen = interactions.select("user_id", "book_id")
    for own, key in ((user_factors, "user_id"), (item_factors, "book_id")):
        seen = join_listed(seen, own.select(F.col("id").alias(key)).distinct(), [key], "left_semi")
    seen = materialise(seen, "seen-with-factors")
    grid = grid or fit_grid(user_factors, item_factors, seen)
    if overfetch is None:
        best = best_scored(active, item_factors, k, seen, skip_seen=True, grid=grid)
    else:
        best = best_scored(active, item_factors, k * overfetch, seen, keep_unseen=k, grid=grid)
    return best.select(
        "user_id", F.col("book_id").alias("candidate_book_id"), "mf_score", "rank"
    )


def by_score(score: str = "mf_score", book: str = "book_id") -> list[Column]:
    return [F.desc(score), F.asc(book)]


def exclude_seen(pairs: DataFrame, interactions: DataFrame, book: str = "book_id") -> DataFrame:
    """Drop (user, book) rows that the user already interacted with."""
    seen = interactions.select("user_id", F.col("book_id").alias(book))
    return pairs.join(seen, ["user_id", book], "left_anti")


def recommend_requests(
    requests: DataFrame,
    user_factors: DataFrame,
    item_factors: DataFrame,
    default_top_k: int = 5,
    grid: Grid | None = None,
) -> DataFrame:
    """Top books per distinct request (user_id, top_k), as many as it asks for.

    Seen books stay, unknown users get no rows.
    """
    limits = requests.select(
        "user_id", F.coalesce("top_k", F.lit(default_top_k)).alias("top_k")
    ).distinct()
    wanted = limits.select(F.col("user_id").alias("id")).distinct()
    longest = limits.agg(F.max("top_k")).first()[0] or default_top_k
    grid = grid or fit_grid(user_factors, item_factors)
    best = best_scored(user_factors.join(wanted, "id", "left_semi"), item_factors, longest, grid=grid)
    return (
        best.join(limits, "user_id")
        .where(F.col("rank") <= F.col("top_k"))
        .select("user_id", "top_k", "book_id", "mf_score", "rank")
    )


def as_lists(ranked: DataFrame, book: str = "book_id", name: str = "books") -> DataFrame:
    """One ordered array per user; the input holds a top-k list per user, so arrays are short."""
    entries = F.array_sort(F.collect_list(F.struct("rank", F.col(book).alias("book"))))
    return ranked.groupBy("user_id").agg(F.transform(entries, lambda e: e["book"]).alias(name))


def quality(candidates: DataFrame, interactions: DataFrame) -> DataFrame:
    """Candidate rows, and how many of them the user had already seen (expected 0)."""
    seen = interactions.select("user_id", F.col("book_id").alias("candidate_book_id"))
    marked = candidates.join(
        seen.withColumn("_hit", F.lit(1)), ["user_id", "candidate_book_id"], "left"
    )
    return marked.agg(
        F.count("*").alias("candidate_rows"), F.count("_hit").alias("leaked_rows")
    )
