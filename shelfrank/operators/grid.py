"""Cutting a user x book plane into cells of bounded size.

Users hash into ``user_blocks`` rows, books into ``item_blocks`` columns. A cell never holds more
than one user block and one book block, whatever the skew: a user with a third of all pairs has at
most one pair per book of the block in a cell, a book with a third of all pairs at most one per user.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

USERS_PER_BLOCK = 20_000
ITEMS_PER_BLOCK = 200_000
MIN_USER_BLOCKS = 8
# Every user block receives every book once, so beyond this many the blocks grow instead ...
MANY_USER_BLOCKS = 10_000
# ... up to this size.
MAX_USERS_PER_BLOCK = 100_000
# Seen pairs that travel to one cell, on average.
PAIRS_PER_CELL = 5_000_000
# Tasks per cell-wise stage; a few per cell even out hash collisions.
TASKS_PER_CELL = 2
MAX_TASKS = 20_000
# Cells that get a task each; of more, several may meet in one.
SEPARATE_CELLS = 4096


@dataclass(frozen=True)
class Grid:
    user_blocks: int
    item_blocks: int

    @property
    def tasks(self) -> int:
        return min(self.user_blocks * self.item_blocks * TASKS_PER_CELL, MAX_TASKS)

    def user_block(self, user: str) -> Column:
        return F.pmod(F.xxhash64(F.lit("user"), F.col(user)), F.lit(self.user_blocks)).cast("int")

    def item_block(self, item: str) -> Column:
        return F.pmod(F.xxhash64(F.lit("item"), F.col(item)), F.lit(self.item_blocks)).cast("int")

    def each_item_block(self) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(self.item_blocks - 1)))

    def each_user_block(self) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(self.user_blocks - 1)))

    def spread(self, df: DataFrame) -> DataFrame:
        """Shuffle by cell with a fixed task count, which AQE does not merge."""
        return df.repartition(self.tasks, "ub", "ib")


def separate_keys(spark: SparkSession, n: int) -> list[int]:
    """``n`` numbers that a shuffle into ``n`` tasks deals to one task each."""
    if n == 1:
        return [0]
    key = F.col("id").cast("int")
    task = F.pmod(F.hash(key), F.lit(n)).alias("task")
    rows = spark.range(64 * n).select(key.alias("key"), task).groupBy("task").agg(F.min("key").alias("key")).collect()
    return sorted(r.key for r in rows)


def fit_grid(
    users: DataFrame,
    items: DataFrame,
    pairs: DataFrame | None = None,
) -> Grid:
    """Block counts from row counts of the factor tables and of the pairs that travel along.

    They follow the data and not the cluster. The tables should be stored ones, which are counted
    from their file footers.
    """
    n_users = users.count()
    item_blocks = max(1, math.ceil(items.count() / ITEMS_PER_BLOCK))
    n_pairs = 0 if pairs is None else pairs.count()
    user_blocks = max(
        MIN_USER_BLOCKS,
        min(math.ceil(n_users / USERS_PER_BLOCK), MANY_USER_BLOCKS),
        math.ceil(n_users / MAX_USERS_PER_BLOCK),
        math.ceil(n_pairs / (item_blocks * PAIRS_PER_CELL)),
    )
    return Grid(user_blocks, item_blocks)
