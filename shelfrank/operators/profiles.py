"""Preference weights, profile texts of users and description texts of books."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.functions.ordering import top_per_group
from shelfrank.functions.scalars import joined_line
from shelfrank.operators.interactions import completed, of_buyers, of_users, positive
from shelfrank.operators.joins import fits_broadcast, join_unique

TOP_N = 3
RECENT_N = 2
# Wording of the profile texts (fixed values).
PROFILE_HEADER = "User strongly prefers:"


def attribute_weights(
    interactions: DataFrame, books: DataFrame, small: bool | None = None
) -> DataFrame:
    """(user_id, attribute, name, weight) for category and author, from one join and one shuffle."""
    attributes = books.select("book_id", "category_name", "author")
    joined = join_unique(interactions, attributes, "book_id", "inner", ["user_id"], small)
    named = F.array(
        F.struct(F.lit("category").alias("attribute"), F.col("category_name").alias("name")),
        F.struct(F.lit("author").alias("attribute"), F.col("author").alias("name")),
    )
    return (
        joined.select("user_id", "interaction_score", F.inline(named))
        .groupBy("user_id", "attribute", "name")
        .agg(F.round(F.sum("interaction_score"), 6).alias("weight"))
    )


def of_attribute(weights: DataFrame, attribute: str) -> DataFrame:
    """The rows of ``attribute_weights`` for one attribute, as (user_id, category_name or author, weight)."""
    name = {"category": "category_name", "author": "author"}[attribute]
    return weights.where(F.col("attribute") == attribute).select(
        "user_id", F.col("name").alias(name), "weight"
    )


def single_weights(interactions: DataFrame, books: DataFrame, column: str) -> DataFrame:
    """(user_id, ``column``, weight) for one attribute of the books."""
    joined = join_unique(
        interactions, books.select("book_id", column), "book_id", "inner", ["user_id"]
    )
    return joined.groupBy("user_id", column).agg(
        F.round(F.sum("interaction_score"), 6).alias("weight")
    )


def category_weights(interactions: DataFrame, books: DataFrame) -> DataFrame:
    return single_weights(interactions, books, "category_name")


def author_weights(interactions: DataFrame, books: DataFrame) -> DataFrame:
    return single_weights(interactions, books, "author")


def top_names(weights: DataFrame, name: str, n: int = TOP_N) -> DataFrame:
    return top_per_group(weights, ["user_id"], [F.desc("weight"), F.asc(name)], n)


def recent_purchases(
    sales: DataFrame, books: DataFrame, n: int = RECENT_N, small: bool | None = None
) -> DataFrame:
    """Titles of the last ``n`` completed purchases per user."""
    known = join_unique(
        completed(sales).select(F.col("buyer_id").alias("user_id"), "book_id", "order_date"),
        books.select("book_id", "title"),
        "book_id",
        "inner",
        ["user_id", "order_date"],
        small,
    )
    return top_per_group(known, ["user_id"], [F.desc("order_date"), F.asc("book_id")], n)


def high_rated(
    reviews: DataFrame,
    books: DataFrame,
    n: int = RECENT_N,
    threshold: float = 4.0,
    small: bool | None = None,
) -> DataFrame:
    """Titles of the ``n`` best-scored positive reviews per user."""
    known = join_unique(
        positive(reviews, threshold).select(
            F.col("buyer_id").alias("user_id"), "book_id", "score", "snapshot_date"
        ),
        books.select("book_id", "title"),
        "book_id",
        "inner",
        ["user_id", "snapshot_date"],
        small,
    )
    order = [F.desc("score"), F.desc("snapshot_date"), F.asc("book_id")]
    return top_per_group(known, ["user_id"], order, n)


def user_profiles(
    users: DataFrame,
    interactions: DataFrame,
    sales: DataFrame,
    reviews: DataFrame,
    books: DataFrame,
    threshold: float = 4.0,
    weights: DataFrame | None = None,
) -> DataFrame:
    """(user_id, user_profile) for every row of ``users``.

    The four sections are short per-user lists, made for the users asked for only; they meet in one
    grouping by user, so each user gathers ten strings at most. ``weights`` is the table of
    ``attribute_weights`` where the caller has it already.
    """
    wanted = users.select("user_id").distinct()
    buyers = wanted.withColumnRenamed("user_id", "buyer_id")
    sales = of_buyers(sales, buyers)
    reviews = of_buyers(reviews, buyers)

    def section(df: DataFrame, name: str, text: str) -> DataFrame:
        return df.select("user_id", F.lit(name).alias("section"), "rank", F.col(text).alias("text"))

    small = fits_broadcast(books.select("book_id", "title", "author", "category_name"))
    if weights is None:
        weights = attribute_weights(of_users(interactions, wanted), books, small)
    tops = top_per_group(
        weights, ["user_id", "attribute"], [F.desc("weight"), F.asc("name")], TOP_N
    ).select("user_id", F.col("attribute").alias("section"), "rank", F.col("name").alias("text"))
    anchors = wanted.select(
        "user_id",
        F.lit("user").alias("section"),
        F.lit(0).alias("rank"),
        F.lit(None).cast("string").alias("text"),
    )
    rated = high_rated(reviews, books, RECENT_N, threshold, small)
    bought = recent_purchases(sales, books, RECENT_N, small)
    pieces = (
        tops.unionByName(section(rated, "rated", "title"))
        .unionByName(section(bought, "bought", "title"))
        .unionByName(anchors)
    )

    def items(name: str) -> Column:
        entry = F.when(F.col("section") == name, F.struct("rank", "text"))
        return F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["text"])

    gathered = pieces.groupBy("user_id").agg(
        F.max(F.col("section") == "user").alias("_wanted"),
        items("category").alias("_categories"),
        items("author").alias("_authors"),
        items("rated").alias("_rated"),
        items("bought").alias("_bought"),
    )
    # Wording of the profile's lines (fixed values).
    profile = F.concat_ws(
        "\n",
        F.lit(PROFILE_HEADER),
        joined_line("- Categories: ", F.col("_categories")),
        joined_line("- Authors: ", F.col("_authors")),
        joined_line("- Highly rated books: ", F.col("_rated")),
        joined_line("- Recently purchased: ", F.col("_bought")),
    )
    return gathered.where("_wanted").select("user_id", profile.alias("user_profile"))


def candidate_books(books: DataFrame, wanted: DataFrame) -> DataFrame:
    """Books whose id occurs in ``wanted`` (book_id)."""
    return books.join(wanted.select("book_id").distinct(), "book_id", "left_semi")


def missing_books(wanted: DataFrame, books: DataFrame) -> DataFrame:
    """Wanted ids without a dimension row."""
    return wanted.select("book_id").distinct().join(books.select("book_id"), "book_id", "left_anti")


def item_descriptions(books: DataFrame) -> DataFrame:
    """(book_id, item_description): five labelled lines per book."""
    # Wording of the description's lines (fixed values).
    text = F.concat(
        F.lit("Title: "),
        F.col("title"),
        F.lit("\nAuthor: "),
        F.col("author"),
        F.lit("\nCategory: "),
        F.col("category_name"),
        F.lit("\nAverage Rating: "),
        F.round("rating_avg", 1).cast("string"),
        F.lit("\nPopularity rank: "),
        F.col("purchase_count").cast("string"),
    )
    return books.select("book_id", text.alias("item_description"))

