"""Every registered query: one callable (spark, folder) -> DataFrame per operator.

Computed doubles are rounded to six decimals, ids and ranks are BIGINT, and ties end on an id, so
that each result is one well-defined table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.config import AlsConfig, BprConfig, CacheConfig, ColdStartConfig, DecayConfig
from shelfrank.functions.ordering import top_per_group
from shelfrank.functions.scalars import clean_text
from shelfrank.operators import (
    coldstart,
    evaluate,
    factorization,
    gold,
    interactions,
    profiles,
    rerank,
    retrieval,
)
from shelfrank.operators.joins import join_unique
from shelfrank.plans.recommend import Inputs, recommend
from shelfrank.session import fresh_path, materialise
from shelfrank.sources import tables
from shelfrank.sources.retail import Retail
from shelfrank.streaming import freshness
from shelfrank.streaming.store import SnapshotStore

AS_OF = dt.date(2024, 2, 1)
# Events before this day train, later ones test.
CUT = dt.date(2024, 1, 16)
TEST_END = dt.date(2024, 2, 1)
VALIDATION_START = dt.date(2024, 1, 8)
SNAPSHOT_TIME = dt.datetime(2024, 1, 31, 12)
MODEL_VERSION = 1
# The default threshold of 3 removes no book of these tables.
MIN_BOOK_USERS = 8
FLOW = ColdStartConfig(min_book_interactions=MIN_BOOK_USERS)
RATES = (0.01, 0.05, 0.1, 0.5)
# Events of a day from which a refresh is due.
BUSY_DAY = 340
STREAM_DELAY = "60 days"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
    """Register ``build`` under its name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Retail(spark, folder))

    QUERIES[build.__name__] = run
    return build


def r6(column: str):
    return F.round(column, 6).alias(column)


def mf6():
    return (F.round("mf_score", 6) + 0.0).alias("mf_score")


def long(column: str):
    return F.col(column).cast("long").alias(column)


# ---- shared inputs ---------------------------------------------------------------------------


def scores(t: Retail) -> DataFrame:
    sales = t.sales(end=AS_OF + dt.timedelta(days=1), completed=True)
    return interactions.interaction_scores(sales, t.fact_cart, t.fact_reviews, AS_OF)


def stored_scores(t: Retail) -> DataFrame:
    return materialise(scores(t), "interactions")


def stored_kept(t: Retail) -> DataFrame:
    """Interactions with books that enough users know."""
    kept, _ = coldstart.filter_cold_books(stored_scores(t), MIN_BOOK_USERS)
    return materialise(kept, "warm-interactions")


def train_facts(t: Retail, end: dt.date = CUT) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        t.sales(end=end),
        interactions.between(t.fact_cart, "added_at", end=end),
        interactions.between(t.fact_reviews, "snapshot_date", end=end),
    )


def train_scores(t: Retail, end: dt.date = CUT) -> DataFrame:
    return materialise(interactions.interaction_scores(*train_facts(t, end), end), "train-interactions")


def truth(t: Retail, start: dt.date = CUT, end: dt.date = TEST_END) -> DataFrame:
    return evaluate.ground_truth(t.sales(start, end, completed=True), t.fact_reviews, start, end)


def candidates_of(t: Retail, seen: DataFrame) -> DataFrame:
    return retrieval.generate_candidates(t.factors, t.factors, seen)


def reranked_of(
    candidates: DataFrame, weights: DataFrame, sales: DataFrame, reviews: DataFrame, books: DataFrame
) -> DataFrame:
    users = candidates.select("user_id").distinct()
    named = materialise(
        profiles.attribute_weights(weights.join(users, "user_id", "left_semi"), books), "attribute-weights"
    )
    texts = profiles.user_profiles(users, weights, sales, reviews, books, weights=named)
    liked = profiles.top_names(profiles.of_attribute(named, "category"), "category_name")
    wanted = profiles.candidate_books(
        books, candidates.select(F.col("candidate_book_id").alias("book_id"))
    )
    return rerank.rerank_candidates(
        candidates, texts, profiles.item_descriptions(wanted), books, liked
    )


def train_lists(t: Retail) -> tuple[DataFrame, DataFrame]:
    """(candidates, reranked) from events before the cut only, book figures included."""
    sales, _, reviews = train_facts(t)
    weights = train_scores(t)
    books = materialise(gold.with_book_figures(t.catalogue, sales, reviews), "train-books")
    candidates = materialise(candidates_of(t, weights), "train-candidates")
    return candidates, reranked_of(candidates, weights, sales, reviews, books)


def as_ranked(candidates: DataFrame) -> DataFrame:
    return candidates.withColumnRenamed("candidate_book_id", "book_id")


# ---- sources and sinks -----------------------------------------------------------------------


@query
def param_sql(t: Retail) -> DataFrame:
    return tables.query(
        t.spark,
        """SELECT item_status, count(*) AS n_lines, round(sum(line_total), 2) AS total
           FROM {sales} WHERE quantity >= :min_quantity AND order_date >= :since
           GROUP BY item_status""",
        {"min_quantity": 10, "since": dt.date(2020, 1, 1)},
        sales=t.fact_sales,
    )


@query
def scan_tables(t: Retail) -> DataFrame:
    dates = gold.dim_date(gold.calendar_dates(t.fact_sales, t.fact_cart, t.fact_reviews))
    frames = {
        "dim_books": t.catalogue,
        "dim_date": dates,
        "dim_users": t.dim_users,
        "fact_cart": t.fact_cart,
        "fact_reviews": t.fact_reviews,
        "fact_sales": t.fact_sales,
    }
    return tables.manifest(t.spark, frames).select("table_name", "row_count")


@query
def preview_rows(t: Retail) -> DataFrame:
    return tables.preview(t.catalogue, ["book_id"])


@query
def source_manifest(t: Retail) -> DataFrame:
    names = ["lineitem", "orders", "part", "customer", "supplier", "events", "embeddings"]
    found = {n: tables.optional_source(tables.read_parquet, t.spark, t.folder, n) for n in names}
    return tables.manifest(t.spark, tables.require_sources(found))


@query
def factors_roundtrip(t: Retail) -> DataFrame:
    path = fresh_path(t.spark, "model")
    tables.save_factors(path, t.factors, t.factors, seed=42)
    users, items = tables.load_factors(t.spark, path)
    both = users.select(F.lit("user").alias("kind"), "*").unionByName(
        items.select(F.lit("item").alias("kind"), "*")
    )
    return both.select(
        "kind",
        "id",
        F.size("features").cast("long").alias("n_factors"),
        F.round(
            F.aggregate(
                "features", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
            ),
            6,
        ).alias("squared_norm"),
    )


@query
def csv_roundtrip(t: Retail) -> DataFrame:
    folder = fresh_path(t.spark, "csv")
    tables.write_csv(
        t.dim_books.withColumn("seller_username", F.lit(None).cast("string")), folder, "dim_books"
    )
    return tables.read_csv(t.spark, folder, "dim_books")


@query
def json_seed(t: Retail) -> DataFrame:
    """The dimension tables packed as seed objects of 100 records, each with one of the arrays."""
    path = fresh_path(t.spark, "seed")

    def packed(df: DataFrame, key: str, array: str, record) -> DataFrame:
        return df.groupBy(F.floor(F.col(key) / 100)).agg(F.collect_list(record).alias(array)).select(array)

    buyers = packed(
        t.raw("customer"), "c_custkey", "buyers", F.struct(F.col("c_name").alias("username"))
    )
    sellers = packed(
        t.raw("supplier"), "s_suppkey", "sellers", F.struct(F.col("s_name").alias("username"))
    )
    products = packed(
        t.catalogue, "book_id", "products", F.struct("title", "author", "category_name", "price")
    )
    seed = buyers.unionByName(sellers, allowMissingColumns=True).unionByName(
        products, allowMissingColumns=True
    )
    seed.write.json(path)
    parts = tables.read_seed(t.spark, path, multi_line=False)
    return (
        parts["buyers"]
        .select(F.lit("buyer").alias("kind"), F.col("username").alias("name"))
        .unionByName(
            parts["sellers"].select(F.lit("seller").alias("kind"), F.col("username").alias("name"))
        )
        .unionByName(
            parts["products"].select(
                F.lit("product").alias("kind"),
                F.col("title").alias("name"),
                "author",
                "category_name",
                "price",
            ),
            allowMissingColumns=True,
        )
    )


# Parts of the published tables; a cluster takes a number that suits its larger table.
BUCKETS = 16


@query
def published_tables(t: Retail) -> DataFrame:
    """Scores and sale lines published in equal buckets by user, read by qualified name, joined where they lie."""
    suffix = uuid.uuid4().hex[:12]
    lines = t.fact_sales.select(F.col("buyer_id").alias("user_id"), "line_total")
    for name, df in (("scores", scores(t)), ("lines", lines)):
        tables.publish(df, f"{name}_{suffix}", True, BUCKETS, path=fresh_path(t.spark, name))
    read = [tables.warehouse_table(t.spark, f"{name}_{suffix}", "spark_catalog", "default") for name in ("scores", "lines")]
    books = interactions.user_counts(read[0])
    spent = read[1].groupBy("user_id").agg(F.count("*").alias("n_lines"), F.round(F.sum("line_total"), 2).alias("total"))
    return books.hint("merge").join(spent, "user_id").select("user_id", "n_books", "n_lines", "total")


# ---- filters and interaction scores ----------------------------------------------------------


@query
def completed_sales(t: Retail) -> DataFrame:
    return interactions.completed(t.fact_sales).select(
        "order_id", "buyer_id", "book_id", "order_date", "quantity", "line_total"
    )


@query
def positive_reviews(t: Retail) -> DataFrame:
    return interactions.positive(t.fact_reviews)


@query
def event_union(t: Retail) -> DataFrame:
    return interactions.events(t.fact_sales, t.fact_cart, t.fact_reviews)


@query
def decayed_events(t: Retail) -> DataFrame:
    scored = interactions.decay(event_union(t), AS_OF)
    return scored.select("user_id", "book_id", "event_ts", "base_score", r6("decayed_score"))


@query
def interaction_scores(t: Retail) -> DataFrame:
    tables.publish(scores(t), "interaction_scores")
    return t.spark.table("interaction_scores").select("user_id", "book_id", r6("interaction_score"))


@query
def validated_interactions(t: Retail) -> DataFrame:
    return interactions.validated(scores(t)).select("user_id", "book_id", r6("interaction_score"))


@query
def quality_counts(t: Retail) -> DataFrame:
    return interactions.quality_counts(scores(t))


@query
def single_user(t: Retail) -> DataFrame:
    """Interactions of one user: the one with the highest total score."""
    table = stored_scores(t)
    total = F.round(F.sum("interaction_score"), 6).alias("total")
    best = table.groupBy("user_id").agg(total).orderBy(F.desc("total"), "user_id").limit(1)
    return interactions.of_users(table, best).select("user_id", "book_id", r6("interaction_score"))


@query
def eval_period(t: Retail) -> DataFrame:
    start, end = interactions.month_period(2024, 1)
    return t.sales(start, end, completed=True).select("order_id", "buyer_id", "book_id", "order_date")


@query
def user_counts(t: Retail) -> DataFrame:
    return interactions.user_counts(stored_kept(t))


@query
def book_counts(t: Retail) -> DataFrame:
    return interactions.book_counts(scores(t))


@query
def interaction_stats(t: Retail) -> DataFrame:
    return interactions.stats(scores(t))


@query
def score_describe(t: Retail) -> DataFrame:
    table = materialise(scores(t).select(r6("interaction_score")), "scores")
    return interactions.describe(table).select("statistic", r6("value"))


@query
def count_distribution(t: Retail) -> DataFrame:
    counts = materialise(interactions.user_counts(scores(t)), "counts")
    return interactions.count_distribution(counts)


# ---- cold start ------------------------------------------------------------------------------


@query
def warm_interactions(t: Retail) -> DataFrame:
    kept, _ = coldstart.filter_cold_books(stored_scores(t), MIN_BOOK_USERS)
    return kept.select("user_id", "book_id", r6("interaction_score"))


@query
def cold_books(t: Retail) -> DataFrame:
    return coldstart.cold_books(scores(t), MIN_BOOK_USERS)


@query
def user_universe(t: Retail) -> DataFrame:
    return coldstart.user_universe(stored_kept(t), t.dim_users)


@query
def user_groups(t: Retail) -> DataFrame:
    return coldstart.classify_users(stored_kept(t), t.dim_users)


@query
def group_sizes(t: Retail) -> DataFrame:
    return coldstart.group_sizes(user_groups(t))


@query
def percent_rank_pop(t: Retail) -> DataFrame:
    return coldstart.percent_ranks(t.dim_books).select(
        "book_id", "purchase_count", "rating_avg", r6("purchase_rank"), r6("rating_rank")
    )


@query
def popularity_pool(t: Retail) -> DataFrame:
    return coldstart.popularity_pool(t.dim_books)


@query
def popularity_sample(t: Retail) -> DataFrame:
    pool = coldstart.popularity_pool(t.dim_books)
    return coldstart.sample_pool(t.dim_users, pool).withColumn("rank", long("rank"))


@query
def cold_recs(t: Retail) -> DataFrame:
    users = user_groups(t).where(F.col("user_group") != "warm")
    pool = coldstart.popularity_pool(t.dim_books)
    return coldstart.sample_pool(users, pool, keep=["user_group"]).withColumn("rank", long("rank"))


@query
def hybrid_blend(t: Retail) -> DataFrame:
    listed = materialise(as_ranked(candidates_of(t, stored_scores(t))), "candidates")
    users = listed.select("user_id").distinct()
    popular = coldstart.sample_pool(users, coldstart.popularity_pool(t.dim_books))
    return coldstart.hybrid_blend(listed, popular).withColumn("rank", long("rank"))


@query
def cold_book_similar(t: Retail) -> DataFrame:
    """The five most similar warm books of every cold book."""
    table = stored_scores(t)
    cold = coldstart.cold_books(table, MIN_BOOK_USERS).select("book_id")
    unsold = t.dim_books.join(interactions.book_counts(table), "book_id", "left_anti")
    cold = cold.unionByName(unsold.select("book_id"))
    return coldstart.similar_books(t.dim_books, cold).select(
        "book_id", "similar_book_id", F.round("similarity", 6).alias("similarity"), long("rank")
    )


# ---- texts -----------------------------------------------------------------------------------


@query
def category_weights(t: Retail) -> DataFrame:
    return profiles.category_weights(scores(t), t.catalogue)


@query
def author_weights(t: Retail) -> DataFrame:
    return profiles.author_weights(scores(t), t.catalogue)


@query
def top_categories(t: Retail) -> DataFrame:
    weights = profiles.category_weights(scores(t), t.catalogue)
    return profiles.top_names(weights, "category_name").withColumn("rank", long("rank"))


@query
def top_authors(t: Retail) -> DataFrame:
    weights = profiles.author_weights(scores(t), t.catalogue)
    return profiles.top_names(weights, "author").withColumn("rank", long("rank"))


@query
def recent_purchases(t: Retail) -> DataFrame:
    return profiles.recent_purchases(t.fact_sales, t.catalogue).withColumn("rank", long("rank"))


@query
def high_rated(t: Retail) -> DataFrame:
    return profiles.high_rated(t.fact_reviews, t.catalogue).withColumn("rank", long("rank"))


@query
def user_profiles(t: Retail) -> DataFrame:
    table = stored_scores(t)
    kept, _ = coldstart.filter_cold_books(table, MIN_BOOK_USERS)
    return profiles.user_profiles(kept, table, t.fact_sales, t.fact_reviews, t.catalogue)


@query
def item_descriptions(t: Retail) -> DataFrame:
    return profiles.item_descriptions(t.dim_books)


@query
def candidate_books(t: Retail) -> DataFrame:
    wanted = as_ranked(candidates_of(t, stored_scores(t)))
    return profiles.candidate_books(t.dim_books, wanted).select(
        "book_id", "title", "author", "category_name", "rating_avg", "purchase_count"
    )


@query
def missing_books(t: Retail) -> DataFrame:
    """Books that were sold but have no row among the reviewed books."""
    reviewed = t.dim_books.where(F.col("rating_avg") > 0)
    return profiles.missing_books(t.sale_lines, reviewed)


# ---- retrieval -------------------------------------------------------------------------------


@query
def score_pairs(t: Retail) -> DataFrame:
    pairs = materialise(scores(t).select("user_id", "book_id"), "pairs")
    scored = retrieval.score_pairs(pairs, t.factors, t.factors)
    return scored.select("user_id", "book_id", (F.round("mf_score", 6) + 0.0).alias("mf_score"))


@query
def dot_topk(t: Retail) -> DataFrame:
    best = retrieval.best_scored(t.factors, t.factors, 50)
    return best.select("user_id", "book_id", mf6(), long("rank"))


@query
def candidates_topk(t: Retail) -> DataFrame:
    listed = candidates_of(t, stored_scores(t))
    return listed.withColumn("rank", long("rank")).withColumn("mf_score", mf6())


@query
def candidates_overfetch(t: Retail) -> DataFrame:
    """The best hundred books cut before seen ones are dropped: heavy users get shorter lists."""
    listed = retrieval.generate_candidates(t.factors, t.factors, stored_scores(t), overfetch=2)
    return listed.withColumn("rank", long("rank")).withColumn("mf_score", mf6())


@query
def candidate_lists(t: Retail) -> DataFrame:
    lists = retrieval.as_lists(candidates_of(t, stored_scores(t)), "candidate_book_id")
    return lists.select("user_id", F.array_join(F.col("books").cast("array<string>"), ",").alias("books"))


@query
def candidate_quality(t: Retail) -> DataFrame:
    seen = stored_scores(t)
    return retrieval.quality(candidates_of(t, seen), seen)


@query
def warm_candidates(t: Retail) -> DataFrame:
    table = stored_scores(t)
    kept, _ = coldstart.filter_cold_books(table, MIN_BOOK_USERS)
    warm = coldstart.classify_users(kept, t.dim_users).where(F.col("user_group") == "warm")
    listed = candidates_of(t, table).join(warm, "user_id", "left_semi")
    return listed.withColumn("rank", long("rank")).withColumn("mf_score", mf6())


@query
def unseen_pairs(t: Retail) -> DataFrame:
    """Carted pairs that were never bought."""
    carted = interactions.seen_pairs(t.fact_cart.withColumnRenamed("buyer_id", "user_id"))
    bought = interactions.completed(t.fact_sales).withColumnRenamed("buyer_id", "user_id")
    return retrieval.exclude_seen(carted, bought)


def requests(t: Retail) -> DataFrame:
    """One request per customer; one customer in eight leaves the list length open."""
    return t.raw("customer").select(
        F.col("c_custkey").alias("user_id"),
        F.nullif(F.col("c_nationkey") % 8, F.lit(0)).cast("int").alias("top_k"),
    )


@query
def recommend_subset(t: Retail) -> DataFrame:
    best = retrieval.recommend_requests(requests(t), t.factors, t.factors)
    best = best.withColumn("rank", long("rank")).withColumn("mf_score", mf6())
    return best.withColumn("top_k", long("top_k"))


@query
def reranked(t: Retail) -> DataFrame:
    weights = stored_scores(t)
    candidates = materialise(candidates_of(t, weights), "candidates")
    best = reranked_of(candidates, weights, t.fact_sales, t.fact_reviews, t.dim_books)
    return best.withColumn("rank", long("rank"))


@query
def pair_score(t: Retail) -> DataFrame:
    """Every candidate pair through the Arrow scorer with a word-overlap model."""
    weights = stored_scores(t)
    candidates = materialise(candidates_of(t, weights), "candidates")
    users = candidates.select("user_id").distinct()
    texts = profiles.user_profiles(users, weights, t.fact_sales, t.fact_reviews, t.catalogue)
    listed = as_ranked(candidates)
    descriptions = profiles.item_descriptions(t.dim_books)
    pairs = rerank.join_texts(listed.join(texts, "user_id"), descriptions, listed)
    scored = rerank.score_text_pairs(pairs, rerank.word_overlap_scorer)
    return scored.select("user_id", "book_id", r6("score"))


# Words that a pair may have in the check of cutting.
PAIR_WORDS = 24


@query
def pair_lengths(t: Retail) -> DataFrame:
    """Words of profile and description that are left of every candidate pair cut to a budget."""
    weights = stored_scores(t)
    candidates = materialise(candidates_of(t, weights), "candidates")
    users = candidates.select("user_id").distinct()
    texts = profiles.user_profiles(users, weights, t.fact_sales, t.fact_reviews, t.catalogue)
    words = [F.size(F.split(c, r"\s+")).cast("long") for c in ("user_profile", "item_description")]
    listed = as_ranked(candidates)
    left = texts.select("user_id", words[0].alias("profile_words"))
    right = profiles.item_descriptions(t.dim_books).select("book_id", words[1].alias("description_words"))
    pairs = rerank.join_texts(listed.join(left, "user_id"), right, listed)
    cut = rerank.cut_length_columns(F.col("profile_words"), F.col("description_words"), PAIR_WORDS)
    return pairs.select("user_id", "book_id", cut[0].alias("profile_words"), cut[1].alias("description_words"))


# ---- training --------------------------------------------------------------------------------


def trained(t: Retail, cfg: BprConfig = BprConfig()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept interactions, user factors, item factors)."""
    kept = stored_kept(t)
    return kept, *factorization.train_bpr(kept, cfg)


@query
def bpr_train(t: Retail) -> DataFrame:
    _, users, items = trained(t)
    return users.select(F.lit("user").alias("kind"), "*").unionByName(
        items.select(F.lit("item").alias("kind"), "*")
    )


@query
def negative_samples(t: Retail) -> DataFrame:
    return factorization.negative_samples(stored_scores(t))


@query
def als_factors(t: Retail) -> DataFrame:
    """What the trained factors have to be: one finite vector of the set length for every id."""
    return factor_check(*factorization.train_als(stored_kept(t), AlsConfig()))


@query
def bpr_factors(t: Retail) -> DataFrame:
    _, users, items = trained(t, BprConfig(epochs=5))
    return factor_check(users, items)


def factor_check(users: DataFrame, items: DataFrame) -> DataFrame:
    both = users.select(F.lit("user").alias("kind"), "id", "features").unionByName(
        items.select(F.lit("item").alias("kind"), "id", "features")
    )
    finite = F.forall("features", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    return both.select(
        "kind", "id", F.size("features").cast("long").alias("n_factors"), finite.alias("is_finite")
    )


# Share of pairs in the right order from which a trained model passes.
LEAST_AUC = 0.9


def halved(pairs: DataFrame) -> DataFrame:
    """Pairs of a planted taste: users with an even id keep books with an even id, others the odd ones."""
    return pairs.where(F.col("user_id") % 2 == F.col("book_id") % 2)


def ranking_check(t: Retail, train: Callable[[DataFrame], tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Whether factors learnt before the cut order books as the planted taste does, and better than popularity.

    A pair is a book that the user took and the book with the next id, which is of the other half: pairs that were learnt
    from, and pairs of the days after the cut whose user and books were seen before it.
    """
    known = materialise(halved(train_scores(t)).select("user_id", "book_id", "interaction_score"), "halved")
    users, items = (materialise(f, "halved-factors") for f in train(known))
    counts = materialise(interactions.book_counts(known), "halved-counts")
    next_to = counts.select((F.col("book_id") - 1).alias("book_id"))
    later = halved(truth(t)).join(known, ["user_id", "book_id"], "left_anti")
    later = later.join(counts, "book_id", "left_semi").join(known.select("user_id").distinct(), "user_id", "left_semi")

    def judged(name: str, pairs: DataFrame) -> DataFrame:
        pairs = pairs.select("user_id", "book_id").join(next_to, "book_id", "left_semi")
        pairs = materialise(pairs.withColumn("other_id", F.col("book_id") + 1), "halved-pairs")
        found = evaluate.order_auc(pairs, users, items, counts)
        good = (F.col("factor_auc") >= LEAST_AUC) & (F.col("factor_auc") > F.col("popularity_auc"))
        return found.select(
            F.lit(name).alias("pairs"), "n_pairs", F.when(good, "PASS").otherwise("FAIL").alias("status")
        )

    return judged("learnt", known).unionByName(judged("later", later))


@query
def bpr_ranking(t: Retail) -> DataFrame:
    return ranking_check(t, lambda pairs: factorization.train_bpr(pairs, BprConfig(factors=16)))


@query
def als_ranking(t: Retail) -> DataFrame:
    return ranking_check(t, lambda pairs: factorization.train_als(pairs, AlsConfig(rank=16)))


@query
def als_candidates(t: Retail) -> DataFrame:
    kept = stored_kept(t)
    users, items = factorization.train_als(kept, AlsConfig())
    return retrieval.generate_candidates(users, items, kept).withColumn("mf_score", mf6())


# ---- evaluation ------------------------------------------------------------------------------


@query
def temporal_split(t: Retail) -> DataFrame:
    split = evaluate.temporal_split(event_union(t), "event_ts", VALIDATION_START, CUT)
    return split.select("user_id", "book_id", "event_ts", "split")


@query
def ground_truth(t: Retail) -> DataFrame:
    return truth(t)


@query
def gt_stats(t: Retail) -> DataFrame:
    stats = evaluate.ground_truth_stats(truth(t))
    return stats.select("n_users", "n_pairs", r6("mean_relevant"))


@query
def relevant_retrieved(t: Retail) -> DataFrame:
    listed = as_ranked(candidates_of(t, train_scores(t)))
    return evaluate.relevant_retrieved(listed, truth(t), 50).withColumn("rank", long("rank"))


@query
def recall_at_k(t: Retail) -> DataFrame:
    listed = as_ranked(candidates_of(t, train_scores(t)))
    return evaluate.recall_at_k(listed, truth(t)).select(r6("recall"))


@query
def hit_rate_at_k(t: Retail) -> DataFrame:
    listed = as_ranked(candidates_of(t, train_scores(t)))
    return evaluate.hit_rate_at_k(listed, truth(t)).select(r6("hit_rate"))


@query
def ndcg_at_k(t: Retail) -> DataFrame:
    _, ordered = train_lists(t)
    return evaluate.ndcg_at_k(ordered, truth(t)).select(r6("ndcg"))


@query
def map_at_k(t: Retail) -> DataFrame:
    _, ordered = train_lists(t)
    return evaluate.map_at_k(ordered, truth(t)).select(r6("map"))


@query
def mrr(t: Retail) -> DataFrame:
    _, ordered = train_lists(t)
    return evaluate.mean_reciprocal_rank(ordered, truth(t)).select(r6("mrr"))


@query
def metric_report(t: Retail) -> DataFrame:
    candidates, ordered = train_lists(t)
    return evaluate.metric_report(as_ranked(candidates), ordered, truth(t))


@query
def lambda_sweep(t: Retail) -> DataFrame:
    """Rates compared on the validation days; the test days are not looked at."""
    seen = train_scores(t, VALIDATION_START)
    candidates = materialise(candidates_of(t, seen), "train-candidates")
    facts = train_facts(t, VALIDATION_START)
    weights = evaluate.sweep_weights(*facts, t.catalogue, RATES, VALIDATION_START)
    wanted = truth(t, VALIDATION_START, CUT)
    return evaluate.lambda_sweep(candidates, weights, t.catalogue, wanted, RATES)


# ---- routing ---------------------------------------------------------------------------------


def inputs(t: Retail, users: DataFrame | None = None, items: DataFrame | None = None) -> Inputs:
    return Inputs(
        scores(t),
        t.fact_sales,
        t.fact_reviews,
        t.dim_books,
        t.dim_users,
        t.factors if users is None else users,
        t.factors if items is None else items,
    )


RESULT = ["user_id", "source", "rank", "book_id", "mf_score", "semantic_score", "popularity_score", "hybrid_score"]


@query
def recommendations(t: Retail) -> DataFrame:
    routed = recommend(inputs(t), cold_cfg=FLOW)
    return routed.withColumn("rank", long("rank")).select(*RESULT)


@query
def two_stage_batch(t: Retail) -> DataFrame:
    routed = recommend(inputs(t), requests(t), FLOW)
    return (
        routed.withColumn("rank", long("rank"))
        .withColumn("top_k", long("top_k"))
        .select("top_k", *RESULT)
    )


@query
def bpr_recommendations(t: Retail) -> DataFrame:
    """The whole flow with factors trained on the spot."""
    _, users, items = trained(t)
    routed = recommend(inputs(t, users, items), cold_cfg=FLOW)
    return routed.withColumn("rank", long("rank")).select(*RESULT)


@query
def als_recommendations(t: Retail) -> DataFrame:
    """The whole flow with alternating-least-squares factors, which every user of a kept book has."""
    users, items = factorization.train_als(stored_kept(t), AlsConfig())
    routed = recommend(inputs(t, users, items), cold_cfg=FLOW)
    return routed.withColumn("rank", long("rank")).select(*RESULT)


# ---- gold tables -----------------------------------------------------------------------------


@query
def book_purchase_count(t: Retail) -> DataFrame:
    return gold.book_purchase_count(t.sale_lines)


@query
def book_rating(t: Retail) -> DataFrame:
    return gold.book_rating(t.fact_reviews)


@query
def dim_books(t: Retail) -> DataFrame:
    products = t.catalogue.withColumn("seller_username", F.lit(None).cast("string"))
    return gold.dim_books(products, t.sale_lines, t.fact_reviews)


@query
def dim_users(t: Retail) -> DataFrame:
    nothing = F.lit(None).cast("string")
    people = t.dim_users.select(
        "user_id",
        "username",
        nothing.alias("full_name"),
        nothing.alias("email"),
        F.nullif(F.col("role"), F.lit("HOUSEHOLD")).alias("role"),
        F.lit(None).cast("boolean").alias("is_active"),
    )
    return gold.dim_users(people)


@query
def dim_date(t: Retail) -> DataFrame:
    dates = gold.dim_date(gold.calendar_dates(t.fact_sales, t.fact_cart, t.fact_reviews))
    return dates.withColumn("date", F.col("date").cast("string"))


@query
def review_running_count(t: Retail) -> DataFrame:
    counted = gold.review_running_count(t.fact_reviews)
    return counted.select("review_id", "book_id", long("total_reviews_at_snapshot"))


@query
def surrogate_keys(t: Retail) -> DataFrame:
    return gold.surrogate_keys(t.dim_users, "username", "user_key")


@query
def sales_line_total(t: Retail) -> DataFrame:
    titles = t.catalogue.select("book_id", "title", F.col("price").alias("unit_price"))
    shops = t.raw("supplier").select(
        F.col("s_suppkey").alias("seller_id"), F.col("s_name").alias("seller_username")
    )
    lines = t.sale_lines.select("order_id", "seller_id", "book_id", "quantity")
    lines = join_unique(lines, titles, "book_id", "inner", ["order_id", "quantity"])
    lines = join_unique(lines, shops, "seller_id", "left", ["order_id", "quantity"]).select(
        "order_id", "title", "seller_username", "quantity", "unit_price"
    )
    keyed = gold.sales_with_keys(lines, titles, shops)
    return keyed.select("order_id", "book_id", "seller_id", "quantity", "unit_price", "line_total")


@query
def clean_texts(t: Retail) -> DataFrame:
    cleaned = clean_text(F.col("text"))
    return t.raw("documents").select(
        "doc_id",
        F.md5(cleaned).alias("text_md5"),
        F.char_length(cleaned).cast("long").alias("n_chars"),
    )


# ---- freshness -------------------------------------------------------------------------------


def stored_lists(t: Retail) -> DataFrame:
    """The recommendations of every user with an event, dated by the user's last event."""
    listed = recommendations(t).select("user_id", "source", "rank", "book_id")
    made = event_union(t).groupBy("user_id").agg(F.max("event_ts").alias("made"))
    dated = listed.join(made, "user_id")
    return freshness.build_snapshot(dated, F.col("made"), MODEL_VERSION).drop("made")


@query
def snapshot_valid(t: Retail) -> DataFrame:
    valid = freshness.valid_rows(stored_lists(t), SNAPSHOT_TIME, MODEL_VERSION)
    return valid.withColumn("rank", long("rank"))


@query
def stale_users(t: Retail) -> DataFrame:
    """Users with a purchase or review after the cut, for lists made at the cut."""
    made = F.lit(CUT).cast("timestamp_ntz")
    lists = freshness.build_snapshot(train_scores(t), made, MODEL_VERSION)
    return freshness.stale_users(lists, freshness.invalidating_events(t.fact_sales, t.fact_reviews))


@query
def snapshot_store(t: Retail) -> DataFrame:
    """Lists of ten made at the cut, published; stale users' lists replaced by new ones of five, some users withdrawn."""
    listed = materialise(candidates_of(t, stored_scores(t)).where(F.col("rank") <= 10), "candidates")
    listed = as_ranked(listed).select("user_id", "book_id", "rank")
    store = SnapshotStore(t.spark, fresh_path(t.spark, "snapshot-store"))
    store.publish(freshness.build_snapshot(listed, F.lit(CUT).cast("timestamp_ntz"), MODEL_VERSION))
    events = freshness.invalidating_events(t.fact_sales, t.fact_reviews)
    stale = materialise(freshness.stale_users(store.read(), events), "stale-users")
    again = listed.where(F.col("rank") <= 5).join(stale, "user_id", "left_semi")
    now = F.lit(SNAPSHOT_TIME.isoformat(sep=" ")).cast("timestamp_ntz")
    store.replace(freshness.build_snapshot(again, now, MODEL_VERSION), stale)
    gone = listed.where(F.col("user_id") % 7 == 3)
    store.replace(store.read().where("false"), gone)
    store.compact()
    store.vacuum(1)
    return store.read().select("user_id", "book_id", long("rank"), "generated_at")


def stream(t: Retail) -> DataFrame:
    return freshness.event_stream(t.spark, t.folder, "events.parquet")


@query
def changed_users(t: Retail) -> DataFrame:
    marks = freshness.changed_users(stream(t))
    return marks.withColumn("last_event", F.col("last_event").cast("timestamp_ntz"))


@query
def stale_lists(t: Retail) -> DataFrame:
    """Lists made at the cut that an event makes stale within ten days, marked once, though every event comes twice."""
    made = F.lit(CUT).cast("timestamp_ntz")
    lists = freshness.build_snapshot(train_scores(t), made, MODEL_VERSION, CacheConfig(ttl_seconds=10 * 86400))
    replayed = stream(t).unionByName(stream(t))
    marks = freshness.stale_lists(replayed, materialise(lists, "lists"), STREAM_DELAY)
    return marks.withColumn("generated_at", F.col("generated_at").cast("timestamp_ntz"))


@query
def daily_volume(t: Retail) -> DataFrame:
    volume = freshness.daily_volume(stream(t), STREAM_DELAY)
    return freshness.refresh_days(volume, BUSY_DAY).select(
        F.to_date("day_start").cast("string").alias("day"), "n_events"
    )


@query
def forward_decay(t: Retail) -> DataFrame:
    """Scores kept up to date from two streams: carts and reviews, and the sales table as it grows."""
    path = fresh_path(t.spark, "sales-feed")
    sold = materialise(
        t.sales(completed=True).select(
            F.col("buyer_id").alias("user_id"), "book_id", F.col("order_date").alias("event_ts")
        ),
        "sales-feed",
        path,
    )
    feed = t.spark.readStream.schema(sold.schema).parquet(path)
    cfg = DecayConfig()
    purchases = feed.withColumn("base_score", F.lit(cfg.purchase_score))
    others = freshness.scored_events(stream(t), cfg)
    running = freshness.running_scores([purchases, others], AS_OF, cfg)
    return running.select("user_id", "book_id", r6("interaction_score"))


@query
def dedup_events(t: Retail) -> DataFrame:
    """The event feed delivered twice."""
    replayed = stream(t).unionByName(stream(t))
    kept = freshness.deduplicated(replayed, STREAM_DELAY)
    return kept.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
