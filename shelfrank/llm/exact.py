"""Exact deduplication that splits off the heavy hitters.

A Misra-Gries summary names every digest that more than a given share of the rows have (and maybe a few others). Their
winners are found exactly with map-side partial aggregates, are few by the summary's own size, and are broadcast, so the
rows of large groups are decided where they lie. The remaining digests go through one ordinary shuffle. Only DataFrame
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.llm.tables import keep_rows, text_key
from shelfrank.session import materialise

#: A digest that more than this share of the rows have is a heavy hitter; the summary has at most 1 / SUPPORT entries,
#: which bounds the broadcast to 2,000 winners of about 100 bytes.
SUPPORT = 0.0005
BLANKS = r"[\x20\x09-\x0D]+"


def digest(text: Column) -> Column:
    """SHA-256 of the text without its ASCII blanks; null counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, ""), 256)


def _best_first() -> Column:
    """Order inside a group: most code points, smallest doc_id (null last), then the row that was read first."""
    return F.struct(-F.col("n_points"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_no"))


def exact_groups(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256, text_key``.

    Rows whose texts are equal after their ASCII blanks are deleted form a group (null is an empty text). The row with
    the most code points stays, then the smallest doc_id, null last; of rows that also repeat the doc_id exactly one
    stays. Empty texts are equal to each other; an empty table gives an empty table; further columns are ignored.
    """
    rows = materialise(
        docs.select(
            F.col("doc_id"),
            F.monotonically_increasing_id().alias("row_no"),
            F.char_length(F.coalesce(F.col("text"), F.lit(""))).alias("n_points"),
            F.unhex(digest(F.col("text"))).alias("sha"),
            text_key(F.col("text")).alias("text_key"),
        ),
        "exact-rows",
    )
    summary = rows.select(F.hex("sha").alias("item")).stat.freqItems(["item"], support)
    frequent = summary.select(F.explode("item_freqItems").alias("item")).select(F.unhex("item").alias("sha"))
    winners = materialise(
        rows.join(F.broadcast(frequent), "sha", "left_semi")
        .groupBy("sha")
        .agg(F.min(_best_first()).alias("best"), F.count("*").alias("group_size"))
        .select("sha", F.struct(F.col("best.doc_id"), F.col("best.row_no")).alias("best"), "group_size"),
        "exact-winners",
    )
    decided = rows.join(F.broadcast(winners), "sha", "left")
    group = Window.partitionBy("sha")
    rest = (
        decided.where(F.col("group_size").isNull())
        .withColumn("first", F.min(_best_first()).over(group))
        .withColumn("group_size", F.count("*").over(group))
        .withColumn("best", F.struct(F.col("first.doc_id"), F.col("first.row_no")))
        .select(*decided.columns)
    )
    return decided.where(F.col("group_size").isNotNull()).unionByName(rest).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("best.row_no") == F.col("row_no")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "text_key",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; decisions as in ``exact_groups``."""
    return keep_rows(docs, materialise(exact_groups(docs), "exact-groups"))
