"""Derived columns and dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.functions.ordering import dense_keys, running_number
from shelfrank.functions.scalars import clean_text
from shelfrank.operators.joins import join_unique


def book_purchase_count(sales: DataFrame) -> DataFrame:
    """Sale lines per book, whatever their status."""
    return sales.groupBy("book_id").agg(F.count("*").alias("purchase_count"))


def book_rating(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("book_id").agg(F.round(F.avg("score"), 2).alias("rating_avg"))


def with_book_figures(catalogue: DataFrame, sales: DataFrame, reviews: DataFrame) -> DataFrame:
    """Books with purchase count and mean rating; 0 for books never sold or reviewed."""
    return (
        catalogue.join(book_purchase_count(sales), "book_id", "left")
        .join(book_rating(reviews), "book_id", "left")
        .withColumn("purchase_count", F.coalesce("purchase_count", F.lit(0).cast("long")))
        .withColumn("rating_avg", F.coalesce("rating_avg", F.lit(0.0)))
    )


def dim_books(products: DataFrame, sales: DataFrame, reviews: DataFrame) -> DataFrame:
    """Books with cleaned texts, defaults and figures."""
    cleaned = products.select(
        "book_id",
        clean_text(F.col("title")).alias("title"),
        clean_text(F.col("author")).alias("author"),
        clean_text(F.col("category_name")).alias("category_name"),
        F.coalesce("price", F.lit(0.0)).alias("price"),
        clean_text(F.col("seller_username"), "unknown").alias("seller_username"),
    )
    return with_book_figures(cleaned, sales, reviews)


def dim_users(people: DataFrame) -> DataFrame:
    """Users with cleaned texts and defaults for absent fields."""
    return people.select(
        "user_id",
        clean_text(F.col("username"), "user").alias("username"),
        clean_text(F.col("full_name")).alias("full_name"),
        clean_text(F.col("email"), "unknown@example.com").alias("email"),
        F.coalesce("role", F.lit("buyer")).alias("role"),
        F.coalesce("is_active", F.lit(True)).alias("is_active"),
    )


def calendar_dates(sales: DataFrame, carts: DataFrame, reviews: DataFrame) -> DataFrame:
    return (
        sales.select(F.to_date("order_date").alias("date"))
        .unionByName(carts.select(F.to_date("added_at").alias("date")))
        .unionByName(reviews.select(F.to_date("snapshot_date").alias("date")))
        .distinct()
    )


def dim_date(dates: DataFrame) -> DataFrame:
    d = F.col("date")
    return dates.select(
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.quarter(d).alias("quarter"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def review_running_count(reviews: DataFrame) -> DataFrame:
    """Reviews a book had when each of its reviews was written, that one included."""
    return running_number(
        reviews, ["book_id"], "snapshot_date", ["buyer_id", "review_id"], "total_reviews_at_snapshot"
    )


def surrogate_keys(df: DataFrame, natural_key: str, name: str) -> DataFrame:
    return dense_keys(df, natural_key, name)


def key_lookup(products: DataFrame, natural_key: str, key: str) -> DataFrame:
    """One id per natural key; the last one wins when a natural key repeats."""
    return products.groupBy(natural_key).agg(F.max(key).alias(key))


def sales_with_keys(lines: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Sale lines (title, seller name, unit price, quantity) with ids and line total.

    A title without a book drops the line; a seller without a row becomes seller 1.
    """
    books = key_lookup(products, "title", "book_id")
    shops = key_lookup(sellers, "seller_username", "seller_id")
    salt = ["unit_price", "quantity"]
    known = join_unique(lines, books, "title", "inner", ["seller_username", *salt])
    return (
        join_unique(known, shops, "seller_username", "left", ["title", *salt], keys_from=lines)
        .withColumn("seller_id", F.coalesce("seller_id", F.lit(1).cast("long")))
        .withColumn("line_total", F.round(F.col("unit_price") * F.col("quantity"), 2))
        .withColumn("unit_price", F.round("unit_price", 2))
    )
