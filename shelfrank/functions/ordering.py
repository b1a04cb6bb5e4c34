"""Exact ranks, quantiles, running counts and dense keys without a one-task global sort.

A window without PARTITION BY sorts the whole table in one task. Here the order is cut into
slices of about equal row counts, as many as the session has shuffle partitions: each slice is
numbered on its own and then shifted by the size of the slices before it. Only the slice bounds and
sizes (one number per slice and group) are ever looked at as a whole. Results do not depend on the
number of slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.session import materialise

MIN_SLICES, MAX_SLICES = 64, 10_000


def slice_bounds(df: DataFrame, columns: Sequence[str], slices: int | None = None) -> list[list[float]]:
    """Inner bounds of ranges of about equal row counts per column, from one sketch job."""
    if slices is None:
        wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        slices = min(max(wanted, MIN_SLICES), MAX_SLICES)
    probs = [i / slices for i in range(1, slices)]
    found = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).approxQuantile(
        list(columns), probs, 0.25 / slices
    )
    return [sorted(set(bounds)) for bounds in found]


def with_slice(df: DataFrame, value: Column, bounds: Sequence[float], name: str = "_slice") -> DataFrame:
    """Number the range that holds ``value``."""
    if not bounds:
        return df.withColumn(name, F.lit(0.0))
    cut = Bucketizer(
        splits=[float("-inf"), *bounds, float("inf")],
        inputCol="_order",
        outputCol=name,
        handleInvalid="keep",
    )
    return cut.transform(df.withColumn("_order", value.cast("double"))).drop("_order")


def histogram(df: DataFrame, column: str) -> DataFrame:
    """(value, n) without nulls; partial counts form before the shuffle."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def cumulative_counts(counts: DataFrame, value: str, bounds: Sequence[float]) -> DataFrame:
    """Add ``before`` (rows with a smaller value) and ``total`` to a (value, n) histogram."""
    sliced = with_slice(counts, F.col(value), bounds)
    sizes = sliced.groupBy("_slice").agg(F.sum("n").alias("_size"))
    everything = Window.orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = sizes.select(
        "_slice",
        (F.sum("_size").over(Window.orderBy("_slice")) - F.col("_size")).alias("_shift"),
        F.sum("_size").over(everything).alias("total"),
    )
    inside = Window.partitionBy("_slice").orderBy(value)
    # At most MAX_SLICES + 1 offset rows: the broadcast has a fixed bound.
    return (
        sliced.join(F.broadcast(offsets), "_slice")
        .withColumn("before", F.col("_shift") + F.sum("n").over(inside) - F.col("n"))
        .drop("_slice", "_shift")
    )


def percent_rank_table(df: DataFrame, column: str, name: str, bounds: Sequence[float]) -> DataFrame:
    """One row per distinct value with its (rank_min - 1) / (n - 1), 0 when n <= 1."""
    ranked = cumulative_counts(histogram(df, column), column, bounds)
    share = F.col("before").cast("double") / (F.col("total") - 1)
    return ranked.select(
        column, F.when(F.col("total") > 1, share).otherwise(F.lit(0.0)).alias(name)
    )


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles as rows (prob, value); no rows for an empty input.

    Reads ``df`` twice, so it should be a stored table.
    """
    (bounds,) = slice_bounds(df, [column])
    spread = F.explode(F.array(*[F.lit(float(p)) for p in probs]))
    ranked = cumulative_counts(histogram(df, column), column, bounds).select("*", spread.alias("prob"))
    position = F.col("prob") * (F.col("total") - 1)
    low, high = F.floor(position), F.ceil(position)
    first, last = F.col("before"), F.col("before") + F.col("n") - 1
    covering = ranked.where(((low >= first) & (low <= last)) | ((high >= first) & (high <= last)))
    weight = position - low
    return covering.groupBy("prob").agg(
        (
            F.min(column).cast("double") * (F.lit(1.0) - F.max(weight))
            + F.max(column).cast("double") * F.max(weight)
        ).alias("value")
    )


def prefix_scan(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str,
    value: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Add ``name``: the running sum of ``value`` (None counts rows) inside each group by ``order``, own row included.

    Rows are dealt out by ranges of (group, order) and not by group, so a group with a third of all rows, or a group all of
    whose rows agree in the first columns of the order, is summed by many tasks: only rows that agree in all columns of
    group and order stay together, and those are interchangeable. What a group holds in the ranges before is added last;
    no more groups than there are ranges begin before their range, so those offsets are few. Nulls are values of their own
    and come first. ``parts`` is the number of ranges; None leaves it to the session and to adaptive execution.
    """
    keys = [*group, *order]
    ranged = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    # stored, so that sums and rows see the same ranges
    at = F.monotonically_increasing_id()
    stored = materialise(ranged.sortWithinPartitions(*keys).withColumn("_at", at), "ranges")
    # the upper bits of the id number the range
    stored = stored.withColumn("_range", F.shiftright("_at", 33))
    one = F.lit(1).cast("long") if value is None else F.col(value)
    sums = stored.groupBy(*group, "_range").agg(F.sum(one).alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy(*group).orderBy("_range")) - F.col("_sum")
    offsets = sums.select(*[F.col(c).alias(f"_{n}") for n, c in enumerate(group)], F.col("_range").alias("_r"), before.alias("_ahead"))
    inside = Window.partitionBy("_range", *group).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = stored.withColumn(name, F.sum(one).over(inside))
    same = F.col("_range") == F.col("_r")
    for n, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_{n}"))
    joined = local.join(F.broadcast(offsets.where(F.col("_ahead") != 0)), same, "left")
    return joined.select(*df.columns, (F.col(name) + F.coalesce("_ahead", F.lit(0))).alias(name))


def running_number(
    df: DataFrame,
    group: Sequence[str],
    time: str,
    ties: Sequence[str],
    name: str,
    slices: int | None = None,
) -> DataFrame:
    """1-based position of each row inside its group by (``time``, ``ties``), cut across equal times as well."""
    return prefix_scan(df, group, [time, *ties], name, parts=slices)


def dense_keys(df: DataFrame, natural_key: str, name: str) -> DataFrame:
    """Number distinct natural keys 1..n in the order of their MD5.

    The first three hex digits cut the keys into 4,096 even parts whatever the keys look like.
    """
    hashed = df.select(natural_key).distinct().withColumn(
        "_hash", F.md5(F.col(natural_key).cast("string"))
    )
    parted = hashed.withColumn("_part", F.substring("_hash", 1, 3))
    sizes = parted.groupBy("_part").agg(F.count("*").alias("_size"))
    offsets = sizes.select(
        "_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_shift")
    )
    inside = Window.partitionBy("_part").orderBy("_hash")
    # At most 4,096 offset rows: the broadcast has a fixed bound.
    return parted.join(F.broadcast(offsets), "_part").select(
        (F.col("_shift") + F.row_number().over(inside)).cast("long").alias(name), natural_key
    )


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group; Spark prunes each map task to ``k`` rows per group first."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
