"""Steps that several operators share: bounded broadcasts, components of links, sorted groups, rows that stay."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.session import fresh_path, materialise

#: Rows of a few numbers that may be broadcast; larger tables are joined by shuffle.
BROADCAST_ROWS = 1_000_000


class Scratch:
    """A folder of stored steps in the shared folder, removed as soon as what follows from them is stored itself."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.steps = spark, fresh_path(spark, name), []

    def keep(self, df: DataFrame) -> DataFrame:
        out = materialise(df, "step", f"{self.folder}/{len(self.steps)}")
        self.steps.append(out)
        return out

    def done(self, *steps: DataFrame) -> None:
        """Remove steps that nothing will read any more."""
        for step in steps:
            self._delete(f"{self.folder}/{next(k for k, own in enumerate(self.steps) if own is step)}")

    def drop(self) -> None:
        self._delete(self.folder)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table marked for broadcast if its rows, which are counted, are few; else as it is."""
    return F.broadcast(df) if df.count() <= rows else df


def spare(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of the frame has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keep_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns, by the decisions ``doc_id, text_key, kept`` of a stored table.

    Rows are found by doc_id (null equals null) and text; of rows that repeat both, one stays.
    """
    chosen = decided.where("kept").select("doc_id", "text_key").distinct()
    same = docs["doc_id"].eqNullSafe(chosen["doc_id"]) & (text_key(docs["text"]) == chosen["text_key"])
    out = docs.join(chosen, same, "left_semi")
    if decided.groupBy("doc_id", "text_key").count().where("count > 1").isEmpty():
        return out
    key = spare(docs, "text_key")
    return out.withColumn(key, text_key(F.col("text"))).dropDuplicates(["doc_id", key]).drop(key)


def components(links: DataFrame, name: str, store: Scratch | None = None) -> DataFrame:
    """``node, component`` (the smallest node reachable) of all nodes of the links ``a, b`` (two longs), stored, in ``store``
    if one is given.

    Large-star and small-star steps alternate: nodes hand their larger, then their smaller neighbours to the smallest one
    they know. The minima are aggregated before they are shuffled and joined back, so a node with very many links is no
    single task; every step is written, and rounds grow with the logarithm of the longest path.

    A step has three exchanges and reads what the last one stored; a whole round in one plan has nine, which the driver
    plans again whenever one of them ends.
    """
    pairs = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi > lo").distinct()
    work = Scratch(links.sparkSession, f"{name}-rounds")
    pairs = work.keep(pairs)
    seen = None
    while True:
        # a node's larger neighbours never are the smallest one it knows
        least = pairs.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        large = pairs.join(least, F.col("lo") == F.col("u"), "left").select("hi", F.coalesce("m", "lo").alias("lo"))
        large = work.keep(large.distinct())
        work.done(pairs)
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(least, "hi").select(F.explode(F.array("hi", "lo")).alias("hi"), F.col("m").alias("lo"))
        pairs = work.keep(moved.where("hi > lo").distinct())
        work.done(large)
        now = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
        if now == seen:
            break
        seen = now
    stars = pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    whole = stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
    out = store.keep(whole) if store else materialise(whole, name)
    work.drop()
    return out


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows that agree in the first ``keys`` columns (longs), of batches sorted by them."""
    held: list[pa.RecordBatch] = []

    def cuts(batch: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(batch.num_rows, dtype=bool)
        for k in range(keys):
            column = batch.column(k).to_numpy(zero_copy_only=False)
            new[1:] |= column[1:] != column[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        if held and any(held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in range(keys)):
            yield pa.Table.from_batches(held)
            held = []
        last = 0
        for cut in cuts(batch):
            held.append(batch.slice(last, cut - last))
            yield pa.Table.from_batches(held)
            held, last = [], cut
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)
