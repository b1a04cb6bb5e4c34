"""Time-decayed implicit feedback per (user, book)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfrank.config import DecayConfig
from shelfrank.functions.ordering import exact_quantiles
from shelfrank.functions.scalars import age_in_months, decayed
from shelfrank.operators.joins import join_listed
from shelfrank.session import materialise
from shelfrank.sources.tables import require_columns

PAIR = ["user_id", "book_id"]


def completed(sales: DataFrame) -> DataFrame:
    return sales.where(F.col("item_status") == "completed")


def positive(reviews: DataFrame, threshold: float = 4.0) -> DataFrame:
    return reviews.where(F.col("score") >= threshold)


def events(sales: DataFrame, carts: DataFrame, reviews: DataFrame, cfg: DecayConfig = DecayConfig()) -> DataFrame:
    """All scored events of the three facts as (user_id, book_id, event_ts, base_score)."""

    def part(df: DataFrame, ts: str, base: Column) -> DataFrame:
        return df.select(
            F.col("buyer_id").alias("user_id"),
            "book_id",
            F.col(ts).alias("event_ts"),
            base.cast("double").alias("base_score"),
        )

    stars = F.when(F.col("score") >= cfg.review_threshold, F.lit(cfg.review_score)).otherwise(F.lit(0.0))
    return (
        part(completed(sales), "order_date", F.lit(cfg.purchase_score))
        .unionByName(part(carts, "added_at", F.lit(cfg.cart_score)))
        .unionByName(part(positive(reviews, cfg.review_threshold), "snapshot_date", stars))
        .where(F.col("base_score") > 0)
    )


def between(df: DataFrame, ts: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Rows of [start, end) as a plain range, which is pushed to the scan."""
    kind = df.schema[ts].dataType
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start).cast(kind))
    if end is not None:
        df = df.where(F.col(ts) < F.lit(end).cast(kind))
    return df


def month_period(year: int, month: int) -> tuple[dt.date, dt.date]:
    start = dt.date(year, month, 1)
    return start, dt.date(year + month // 12, month % 12 + 1, 1)


def decay(scored: DataFrame, as_of: dt.date, cfg: DecayConfig = DecayConfig(), clip_future: bool = True) -> DataFrame:
    """Add ``decayed_score``; events after ``as_of`` are left out unless ``clip_future`` is off."""
    if clip_future:
        scored = between(scored, "event_ts", end=as_of + dt.timedelta(days=1))
    months = age_in_months(F.col("event_ts"), F.lit(as_of), cfg.days_per_month)
    return scored.withColumn("decayed_score", decayed(F.col("base_score"), months, cfg.lambda_rate))


def interaction_scores(
    sales: DataFrame,
    carts: DataFrame,
    reviews: DataFrame,
    as_of: dt.date,
    cfg: DecayConfig = DecayConfig(),
    clip_future: bool = True,
) -> DataFrame:
    """Sum of decayed event scores per (user, book); partial sums form before the shuffle."""
    scored = decay(events(sales, carts, reviews, cfg), as_of, cfg, clip_future)
    return scored.groupBy(*PAIR).agg(F.sum("decayed_score").alias("interaction_score"))


def validated(interactions: DataFrame) -> DataFrame:
    """Rows with a positive score; null scores and scores <= 0 are dropped."""
    require_columns(interactions, [*PAIR, "interaction_score"])
    return interactions.where(F.col("interaction_score") > 0)


def stored_with_counts(interactions: DataFrame, name: str = "interactions") -> tuple[DataFrame, dict[str, int]]:
    """The stored table, and row_count, null_scores and non_positive_scores counted in the pass that writes it."""
    score, seen = F.col("interaction_score"), Observation(f"{name}-quality")
    watched = interactions.observe(
        seen,
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(score.isNull()).alias("null_scores"),
        F.count_if(score <= 0).alias("non_positive_scores"),
    )
    return materialise(watched, name), {k: int(v) for k, v in seen.get.items()}


def quality_counts(interactions: DataFrame) -> DataFrame:
    """One row of counts, taken while the table is stored."""
    _, counts = stored_with_counts(interactions)
    names = ("row_count", "null_scores", "non_positive_scores")
    return interactions.sparkSession.createDataFrame([[counts[n] for n in names]], ", ".join(f"{n} long" for n in names))


def user_counts(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("user_id").agg(F.count("*").alias("n_books"))


def book_counts(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("book_id").agg(F.count("*").alias("n_users"))


def stats(interactions: DataFrame) -> DataFrame:
    """Rows, distinct users and distinct books.

    Each count comes from per-key groups, so no task holds a set of all keys.
    """
    users = user_counts(interactions).agg(
        F.coalesce(F.sum("n_books"), F.lit(0)).alias("row_count"), F.count("*").alias("n_users")
    )
    books = book_counts(interactions).agg(F.count("*").alias("n_books"))
    return users.select("row_count", "n_users", books.scalar().alias("n_books"))


def approximate_stats(interactions: DataFrame) -> DataFrame:
    """As ``stats`` in one pass with sketches, for logging only."""
    return interactions.agg(
        F.count("*").alias("row_count"),
        F.approx_count_distinct("user_id").alias("n_users"),
        F.approx_count_distinct("book_id").alias("n_books"),
    )


def describe(interactions: DataFrame, column: str = "interaction_score") -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum as (statistic, value)."""
    basics = interactions.agg(
        F.count(column).cast("double").alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).cast("double").alias("min"),
        F.max(column).cast("double").alias("max"),
    ).unpivot([], ["count", "mean", "std", "min", "max"], "statistic", "value")
    # Quartile labels (fixed values).
    labels = F.when(F.col("prob") == 0.25, "25%").when(F.col("prob") == 0.5, "50%").otherwise("75%")
    quartiles = exact_quantiles(interactions, column, [0.25, 0.5, 0.75])
    return basics.unionByName(quartiles.select(labels.alias("statistic"), "value"))


def count_distribution(counts: DataFrame, column: str = "n_books") -> DataFrame:
    """Least, greatest and median count; 0 when there are no rows."""
    median = exact_quantiles(counts, column, [0.5]).agg(F.max("value"))
    return counts.agg(
        F.coalesce(F.min(column), F.lit(0)).alias("min_n"),
        F.coalesce(F.max(column), F.lit(0)).alias("max_n"),
    ).select("min_n", "max_n", F.coalesce(median.scalar(), F.lit(0.0)).alias("median_n"))


def of_users(interactions: DataFrame, users: DataFrame) -> DataFrame:
    """Interactions of the requested users."""
    wanted = users.select("user_id").distinct()
    return join_listed(interactions, wanted, ["user_id"], "left_semi")


def of_buyers(facts: DataFrame, buyers: DataFrame) -> DataFrame:
    """Fact rows of the given buyers (buyer_id, distinct)."""
    return join_listed(facts, buyers, ["buyer_id"], "left_semi")


def seen_pairs(interactions: DataFrame) -> DataFrame:
    return interactions.select(*PAIR).distinct()
