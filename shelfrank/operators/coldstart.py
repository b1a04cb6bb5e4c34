"""User groups, cold books, popularity and blended fallbacks."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.config import ColdStartConfig
from shelfrank.functions.ordering import percent_rank_table, slice_bounds, top_per_group
from shelfrank.functions.scalars import full_value
from shelfrank.functions.vectors import one_chunk
from shelfrank.operators.grid import Grid
from shelfrank.operators.interactions import book_counts
from shelfrank.operators.joins import join_listed
from shelfrank.session import materialise

DEFAULTS = ColdStartConfig()


# ---- users -----------------------------------------------------------------------------------


def user_universe(interactions: DataFrame, dim_users: DataFrame | None) -> DataFrame:
    """Every user with an interaction or a dimension row; the dimension may be absent."""
    users = interactions.select("user_id")
    if dim_users is not None:
        users = users.unionByName(dim_users.select("user_id"))
    return users.distinct()


def classify_users(
    interactions: DataFrame, dim_users: DataFrame | None, cfg: ColdStartConfig = DEFAULTS
) -> DataFrame:
    """(user_id, n_books, user_group): cold without books, hybrid below the threshold, else warm.

    One grouped pass: a dimension row counts 0, an interaction row counts 1.
    """
    marks = interactions.select("user_id", F.lit(1).cast("long").alias("one"))
    if dim_users is not None:
        marks = marks.unionByName(dim_users.select("user_id", F.lit(0).cast("long").alias("one")))
    counts = marks.groupBy("user_id").agg(F.sum("one").alias("n_books"))
    n = F.col("n_books")
    group = (
        F.when(n == 0, "cold").when(n < cfg.min_interactions_for_full, "hybrid").otherwise("warm")
    )
    return counts.withColumn("user_group", group)


def group_sizes(classified: DataFrame) -> DataFrame:
    return classified.groupBy("user_group").agg(F.count("*").alias("n_users"))


# ---- books -----------------------------------------------------------------------------------


def cold_books(interactions: DataFrame, min_interactions: int = DEFAULTS.min_book_interactions) -> DataFrame:
    return book_counts(interactions).where(F.col("n_users") < min_interactions)


def filter_cold_books(
    interactions: DataFrame, min_interactions: int = DEFAULTS.min_book_interactions
) -> tuple[DataFrame, DataFrame]:
    """(interactions of books with enough users, the cold books)."""
    cold = cold_books(interactions, min_interactions)
    kept = join_listed(interactions, cold.select("book_id"), ["book_id"], "left_anti")
    return kept, cold


# ---- popularity ------------------------------------------------------------------------------


def eligible_books(books: DataFrame, cfg: ColdStartConfig = DEFAULTS) -> DataFrame:
    return books.where(F.col("rating_avg") >= cfg.min_rating)


def percent_ranks(books: DataFrame, cfg: ColdStartConfig = DEFAULTS) -> DataFrame:
    """Eligible books with the percent ranks of their purchase count and of their rating."""
    eligible = eligible_books(books, cfg)
    by_purchases, by_rating = slice_bounds(eligible, ["purchase_count", "rating_avg"])
    purchases = percent_rank_table(eligible, "purchase_count", "purchase_rank", by_purchases)
    ratings = percent_rank_table(eligible, "rating_avg", "rating_rank", by_rating)
    ranked = join_listed(eligible, purchases, ["purchase_count"], "inner")
    return join_listed(ranked, ratings, ["rating_avg"], "inner")


def popularity_scores(books: DataFrame, cfg: ColdStartConfig = DEFAULTS) -> DataFrame:
    score = F.col("purchase_rank") * cfg.purchase_weight + F.col("rating_rank") * cfg.rating_weight
    return percent_ranks(books, cfg).withColumn("popularity_score", full_value(score))


def popularity_pool(books: DataFrame, cfg: ColdStartConfig = DEFAULTS) -> DataFrame:
    """The ``pool_size`` best eligible books."""
    return (
        popularity_scores(books, cfg)
        .select("book_id", "title", "popularity_score")
        .orderBy(F.desc("popularity_score"), "book_id")
        .limit(cfg.pool_size)
        .withColumn("popularity_score", F.round("popularity_score", 6))
    )


def sample_pool(
    users: DataFrame, pool: DataFrame, top_k: Column | int = 5, seed: str = "", keep: Sequence[str] = ()
) -> DataFrame:
    """Give each row of ``users`` min(top_k, pool) books of the pool, in an order of its own.

    ``keep`` names further columns of ``users`` to carry along. The pool has ``pool_size`` rows at most; it reaches the users as one array from a scalar
    subquery, so users are neither shuffled nor joined.
    """
    k = F.lit(top_k) if isinstance(top_k, int) else top_k
    packed = pool.agg(F.collect_list(F.struct("book_id", "title", "popularity_score"))).scalar()

    def keyed(book):
        key = F.concat(
            F.lit(seed), F.col("user_id").cast("string"), F.lit(":"), book["book_id"].cast("string")
        )
        return F.struct(F.md5(key).alias("draw"), book.alias("book"))

    return (
        users.select("user_id", *keep, k.cast("int").alias("_k"), packed.alias("_pool"))
        .withColumn("_drawn", F.slice(F.array_sort(F.transform("_pool", keyed)), F.lit(1), F.col("_k")))
        .select("user_id", *keep, F.posexplode("_drawn").alias("_pos", "_pick"))
        .select(
            "user_id",
            *keep,
            F.col("_pick.book.book_id").alias("book_id"),
            F.col("_pick.book.title").alias("title"),
            F.round("_pick.book.popularity_score", 6).alias("popularity_score"),
            (F.col("_pos") + 1).alias("rank"),
        )
    )


def hybrid_blend(
    candidates: DataFrame,
    popular: DataFrame,
    top_k: Column | int = 5,
    cfg: ColdStartConfig = DEFAULTS,
    keys: Sequence[str] = ("user_id",),
) -> DataFrame:
    """0.3 x factor score + 0.7 x popularity over the union of both lists, best ``top_k`` per key.

    ``candidates`` is (keys, book_id, mf_score), ``popular`` is (keys, book_id, popularity_score); a
    side that lacks a book counts 0.
    """
    k = F.lit(top_k) if isinstance(top_k, int) else top_k
    left = candidates.select(*keys, "book_id", "mf_score")
    right = popular.select(*keys, "book_id", "popularity_score")
    score = (
        F.coalesce("mf_score", F.lit(0.0)) * cfg.hybrid_mf_weight
        + F.coalesce("popularity_score", F.lit(0.0)) * cfg.hybrid_popularity_weight
    )
    blended = left.join(right, [*keys, "book_id"], "full_outer").select(
        *keys, "book_id", full_value(score).alias("hybrid_score")
    )
    best = top_per_group(blended, keys, [F.desc("hybrid_score"), F.asc("book_id")], k)
    return best.withColumn("hybrid_score", F.round("hybrid_score", 6))


# ---- new books -------------------------------------------------------------------------------

# Scores that differ by less are equal sums in another order.
SLACK = 1e-9
# Books of a cell that are asked for and that answer, on average.
COLD_PER_CELL, WARM_PER_CELL = 20_000, 100_000
# Of the answering books' number, the postings up to which a book's candidates are scored one by one and not all books at once.
FEW = 1 / 32


def content_terms(books: DataFrame) -> DataFrame:
    """(book_id, term, weight): category and author weigh 1, a title word 1 / sqrt(title words) as often as it stands."""
    words = F.split(F.lower(F.trim("title")), r"\s+")

    def term(kind: str, value: Column, weight: Column) -> Column:
        return F.struct(F.concat(F.lit(f"{kind}="), value).alias("term"), weight.alias("weight"))

    one = F.lit(1.0)
    terms = F.concat(
        F.array(term("category", F.col("category_name"), one), term("author", F.col("author"), one)),
        F.coalesce(
            F.transform(words, lambda w: term("title", w, one / F.sqrt(F.size(words)))),
            F.array().cast("array<struct<term:string,weight:double>>"),
        ),
    )
    rows = books.select("book_id", F.inline(terms)).where(F.col("term").isNotNull())
    return rows.groupBy("book_id", "term").agg(F.sum("weight").alias("weight"))


def _coded(column: pa.ChunkedArray, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ends of the lists, places of their strings in ``words`` or -1) of a column of lists."""
    lists = one_chunk(column)
    codes = pc.fill_null(pc.index_in(lists.flatten(), value_set=words), -1).to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.r_[0, np.cumsum(sizes)], codes


def _similar_in_cell(k: int):
    """Cell function: the ``k`` best books of the block for each asked book with a term to read that a book of it has.

    An asked book has its ``names`` and ``weights``, the terms to ``read`` and, if known, the ``least`` score that matters.
    """

    def run(asked: pa.Table, books: pa.Table) -> pa.Table:
        ids = {"book_id": asked.column("book_id"), "similar_book_id": books.column("similar_book_id")}
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        n = books.num_rows
        if n and asked.num_rows:
            # ascending ids, so that a place doubles as the tie-break
            books = books.sort_by("similar_book_id")
            ids["similar_book_id"] = books.column("similar_book_id")
            words = pc.unique(one_chunk(books.column("names")).flatten())
            ends, codes = _coded(books.column("names"), words)
            order = np.argsort(codes, kind="stable")
            holder = np.repeat(np.arange(n), np.diff(ends))[order]
            weight = one_chunk(books.column("weights")).flatten().to_numpy()[order]
            first = np.r_[0, np.cumsum(np.bincount(codes, minlength=len(words)))]
            rating = books.column("other_rating").to_numpy()
            own_ends, own = _coded(asked.column("names"), words)
            own_weight = one_chunk(asked.column("weights")).flatten().to_numpy()
            read_ends, read = _coded(asked.column("read"), words)
            own_rating = asked.column("rating").to_numpy()
            least = pc.fill_null(asked.column("least"), -math.inf).to_numpy()
            for row in range(asked.num_rows):
                terms = [t for t in read[read_ends[row] : read_ends[row + 1]] if t >= 0]
                if not terms:
                    continue
                mine = [(own[x], own_weight[x]) for x in range(own_ends[row], own_ends[row + 1]) if own[x] >= 0]
                if sum(first[t + 1] - first[t] for t in terms) <= n * FEW:
                    at = np.unique(np.concatenate([holder[first[t] : first[t + 1]] for t in terms]))
                    score = np.zeros(len(at))
                    for t, w in mine:
                        has = holder[first[t] : first[t + 1]]
                        near = np.minimum(np.searchsorted(has, at), len(has) - 1)
                        score += np.where(has[near] == at, w * weight[first[t] + near], 0.0)
                    score += own_rating[row] * rating[at]
                else:
                    at, score = np.arange(n), np.zeros(n)
                    for t, w in mine:
                        # a book has a term once
                        score[holder[first[t] : first[t + 1]]] += w * weight[first[t] : first[t + 1]]
                    score += own_rating[row] * rating
                limit = least[row]
                if limit == -math.inf and len(at) > k:
                    limit = np.partition(score, len(at) - k)[len(at) - k]
                good = np.flatnonzero(score >= limit - SLACK)
                full = np.round(score[good], 12) + 0.0
                best = np.argsort(-full, kind="stable")[:k]
                found.append((row, at[good[best]], full[best]))
        row = np.concatenate([np.full(len(at), r) for r, at, _ in found] or [np.zeros(0, int)])
        at = np.concatenate([x for _, x, _ in found] or [np.zeros(0, int)])
        score = np.concatenate([x for _, _, x in found] or [np.zeros(0)])
        names = ["book_id", "similar_book_id", "similarity"]
        return pa.table([ids["book_id"].take(row), ids["similar_book_id"].take(at), score], names)

    return run


def similar_books(books: DataFrame, cold: DataFrame, k: int = 5) -> DataFrame:
    """(book_id, similar_book_id, similarity, rank): the ``k`` most similar other books of every book of ``cold`` (book_id).

    Similarity is the inner product of the books' terms plus that of their ratings, (rating - 3) / 4; ties go to the smaller
    id. Exact, and no pair of books is a row of its own: cold and other books meet in cells of a block of each, where an
    inverted index of the other books' terms adds up the scores and only ``k`` rows a cold book leave a cell. The index is
    read for the rarest term of a cold book first. The k-th best score found there bounds what else can matter: a book with none of the terms that are
    read scores at most the sum of the largest products of the terms left out and of the ratings, so the most frequent terms
    are left out as long as that sum stays below the bound. Books that share no term differ by their rating alone, so the
    k best by it are candidates of every cold book.
    """
    rated = books.select("book_id", ((F.coalesce("rating_avg", F.lit(0.0)) - 3) / 4).cast("double").alias("rating"))
    is_cold = F.coalesce("is_cold", F.lit(False)).alias("is_cold")
    marked = rated.join(cold.select("book_id").distinct().withColumn("is_cold", F.lit(True)), "book_id", "left")
    marked = materialise(marked.select("book_id", "rating", is_cold), "content-books")
    terms = content_terms(books).join(marked.select("book_id", "is_cold"), "book_id")
    terms = materialise(terms, "content-terms")
    postings = terms.where(~F.col("is_cold")).select(F.col("book_id").alias("similar_book_id"), "term", "weight")
    found = postings.groupBy("term").agg(F.count("*").alias("books"), F.max("weight").alias("most"))
    asked = terms.where("is_cold").select("book_id", "term", "weight").join(found, "term")
    asked = asked.select("book_id", "term", "books", (F.col("weight") * F.col("most")).alias("most"))

    # one map of terms a book, for the exact score of a pair
    of_book = F.map_from_entries(F.collect_list(F.struct("term", "weight"))).alias("terms")
    whole = marked.join(terms.groupBy("book_id").agg(of_book), "book_id", "left")
    whole = materialise(whole.select("book_id", "rating", "terms", "is_cold"), "content-whole")
    left = whole.where("is_cold").select("book_id", F.col("rating").alias("_r"), F.map_entries("terms").alias("_terms"))
    right = whole.where(~F.col("is_cold")).select(
        F.col("book_id").alias("similar_book_id"), F.col("rating").alias("_s"), F.col("terms").alias("_map")
    )

    def scored(pairs: DataFrame) -> DataFrame:
        # one row a book on either side; adaptive execution broadcasts a small one and splits what a hot book makes large
        both = pairs.join(left, "book_id").join(right, "similar_book_id")
        common = F.aggregate(
            F.coalesce("_terms", F.array().cast("array<struct<key:string,value:double>>")),
            F.lit(0.0),
            lambda total, t: total + t["value"] * F.coalesce(F.try_element_at("_map", t["key"]), F.lit(0.0)),
        )
        score = full_value(common + F.col("_r") * F.col("_s")) + 0.0
        return both.select("book_id", "similar_book_id", score.alias("similarity"))

    n_cold, n_warm = marked.agg(F.count_if("is_cold"), F.count_if(~F.col("is_cold"))).first()
    grid = Grid(max(1, math.ceil(n_cold / COLD_PER_CELL)), max(1, math.ceil(n_warm / WARM_PER_CELL)))
    apart = [F.map_keys("terms").alias("names"), F.map_values("terms").alias("weights")]
    answering = whole.where(~F.col("is_cold") & F.col("terms").isNotNull()).select(
        grid.each_user_block().alias("ub"),
        grid.item_block("book_id").alias("ib"),
        F.col("book_id").alias("similar_book_id"),
        F.col("rating").alias("other_rating"),
        *apart,
    )
    kind = marked.schema["book_id"].dataType.simpleString()

    def in_cells(wanted: DataFrame) -> DataFrame:
        """The best books of every cell that have a term of ``wanted`` (book_id, term, least)."""
        read = wanted.groupBy("book_id").agg(F.collect_list("term").alias("read"), F.first("least").alias("least"))
        asking = whole.where("is_cold").join(read, "book_id").select(
            grid.user_block("book_id").alias("ub"), "book_id", "rating", *apart, "read", "least"
        )
        asking = asking.withColumn("ib", grid.each_item_block())
        cells = grid.spread(asking).groupBy("ub", "ib").cogroup(grid.spread(answering).groupBy("ub", "ib"))
        return cells.applyInArrow(_similar_in_cell(k), f"book_id {kind}, similar_book_id {kind}, similarity double")

    by_rarity = Window.partitionBy("book_id").orderBy((F.col("books") >= k).desc(), "books", "term")
    first = asked.withColumn("_n", F.row_number().over(by_rarity))
    seeds = first.where("_n = 1").select("book_id", "term", F.lit(None).cast("double").alias("least"))
    seeded = materialise(in_cells(seeds), "content-seeded")

    kth = top_per_group(seeded, ["book_id"], [F.desc("similarity")], k).where(F.col("rank") == k)
    warm = marked.where(~F.col("is_cold"))
    low, high = warm.agg(F.min("rating"), F.max("rating")).first()
    rated_most = F.greatest(*[F.col("rating") * F.lit(x or 0.0) for x in (low, high)])
    least = kth.select("book_id", F.col("similarity").alias("_least"))
    limits = marked.where("is_cold").join(least, "book_id", "left").select("book_id", "_least", rated_most.alias("_rated"))
    left_out = F.sum("most").over(Window.partitionBy("book_id").orderBy(F.desc("books"), "term")) + F.col("_rated")
    rest = first.where("_n > 1").join(limits, "book_id").withColumn("_rest", left_out)
    needed = rest.where(F.col("_least").isNull() | (F.col("_rest") >= F.col("_least") - SLACK))
    more = materialise(in_cells(needed.select("book_id", "term", F.col("_least").alias("least"))), "content-more")

    def best_rated(order: Column, kind: Column) -> DataFrame:
        top = [r["book_id"] for r in warm.orderBy(order, "book_id").limit(k).collect()]  # k rows
        ids = F.array(*map(F.lit, top)).cast(f"array<{warm.schema['book_id'].dataType.simpleString()}>")
        return marked.where(F.col("is_cold") & kind).select("book_id", F.explode(ids).alias("similar_book_id"))

    rating = F.col("rating")
    by_rating = (
        best_rated(F.desc("rating"), rating > 0)
        .unionByName(best_rated(F.asc("rating"), rating < 0))
        .unionByName(best_rated(F.asc("book_id"), rating == 0))
    )
    found = seeded.unionByName(more).dropDuplicates(["book_id", "similar_book_id"])
    others = by_rating.distinct().join(found.drop("similarity"), ["book_id", "similar_book_id"], "left_anti")
    every = found.unionByName(materialise(scored(others), "content-others"))
    return top_per_group(every, ["book_id"], [F.desc("similarity"), F.asc("similar_book_id")], k)
