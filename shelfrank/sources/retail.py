"""The retail test tables seen as the book-shop star schema.

Only projections, one line-to-header join and key-wise aggregates: column pruning and filters reach
the parquet scans through these frames.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.operators import gold
from shelfrank.session import materialise

# Moves the order dates so that the last one falls on 2024-01-31 (fixed value).
ORDER_DATE_SHIFT_DAYS = 8218


def _prop_book() -> Column:
    return F.get_json_object("props", "$.k").try_cast("bigint")


@dataclass(frozen=True)
class Retail:
    """Lazy logical tables over one folder of parquet files."""

    spark: SparkSession
    folder: str

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _lines(self, completed: bool = False) -> DataFrame:
        lines = self.raw("lineitem")
        if completed:
            lines = lines.where(F.col("l_linestatus") == "F")
        return lines.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_partkey").alias("book_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.round(F.col("l_extendedprice") / F.col("l_quantity"), 2).alias("unit_price"),
            F.col("l_extendedprice").alias("line_total"),
            F.when(F.col("l_linestatus") == "F", "completed").otherwise("pending").alias("item_status"),
        )

    @cached_property
    def sale_lines(self) -> DataFrame:
        """Sale lines without the order header: enough for per-book figures."""
        return self._lines()

    def sales(
        self, start: dt.date | None = None, end: dt.date | None = None, completed: bool = False
    ) -> DataFrame:
        """Sales of [start, end), completed ones only if asked.

        Both conditions stand on the stored columns, the dates moved back, so they reach the scans.
        """
        headers = self.raw("orders")
        for bound, keep in ((start, "__ge__"), (end, "__lt__")):
            if bound is not None:
                stored = F.lit(bound - dt.timedelta(days=ORDER_DATE_SHIFT_DAYS))
                kind = headers.schema["o_orderdate"].dataType
                headers = headers.where(getattr(F.col("o_orderdate"), keep)(stored.cast(kind)))
        headers = headers.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("buyer_id"),
            F.expr(f"o_orderdate + INTERVAL {ORDER_DATE_SHIFT_DAYS} DAYS").alias("order_date"),
            F.col("o_orderstatus").alias("order_overall_status"),
        )
        # An order with very many lines is left to the skew handling of adaptive execution: it only
        # copies the headers that need it, where a salt would copy all of them.
        return self._lines(completed).join(headers, "order_id")

    @cached_property
    def fact_sales(self) -> DataFrame:
        return self.sales()

    @cached_property
    def fact_cart(self) -> DataFrame:
        return (
            self.raw("events")
            .where(F.col("event_type") == "click")
            .select(
                F.col("event_id").alias("cart_id"),
                F.col("user_id").alias("buyer_id"),
                _prop_book().alias("book_id"),
                F.lit(1).alias("quantity"),
                F.col("ts").alias("added_at"),
            )
        )

    @cached_property
    def fact_reviews(self) -> DataFrame:
        stars = F.lit(5) - F.least(F.floor(F.col("value") / 30), F.lit(4).cast("long"))
        return (
            self.raw("events")
            .where(F.col("event_type") == "view")
            .select(
                F.col("event_id").alias("review_id"),
                _prop_book().alias("book_id"),
                F.col("user_id").alias("buyer_id"),
                stars.cast("double").alias("score"),
                F.col("ts").alias("snapshot_date"),
            )
        )

    @cached_property
    def catalogue(self) -> DataFrame:
        """Book attributes as delivered, without the derived counts."""
        return self.raw("part").select(
            F.col("p_partkey").alias("book_id"),
            F.col("p_name").alias("title"),
            F.col("p_brand").alias("author"),
            F.col("p_type").alias("category_name"),
            F.col("p_retailprice").alias("price"),
        )

    @cached_property
    def dim_books(self) -> DataFrame:
        """Books with purchase count and rating, stored once as a table of its own."""
        figures = gold.with_book_figures(self.catalogue, self.sale_lines, self.fact_reviews)
        return materialise(figures, "dim-books")

    @cached_property
    def dim_users(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("username"),
            F.col("c_mktsegment").alias("role"),
        )

    @cached_property
    def factors(self) -> DataFrame:
        """Each given vector serves as the factors of the user and of the book with its id."""
        return self.raw("embeddings").select(
            F.col("vec_id").alias("id"), F.col("embedding").alias("features")
        )
