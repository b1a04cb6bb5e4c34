"""Mixing sources to target weights by Sainte-Lague apportionment.

Every source's words are cut into blocks of equal length. Blocks are apportioned to sources by the highest quotients
target / (2 * seats + 1), then inside a source to its shards in the same way, so every shard has an integer quota before
any row is chosen. A shard lays its documents in a seeded order on a line of words and takes its quota of consecutive
blocks from a seeded first block, round and round; what a document gives is the part of its own stretch that is covered.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.tables import spare
from shelfrank.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeated; the share of all words that the mix takes; times a source's
#: words that its target may reach.
WEIGHTS = (5, 2, 1)
VOLUME = 1.5
MOST = 2.0
#: Words of a block; rows that make up a shard, and shards of a source at most (the shard table comes to the driver).
BLOCK = 32
SHARD_ROWS = 4096
MOST_SHARDS = 4096
SEED = 17


def apportion(votes: Sequence[float], seats: int, most: Sequence[int]) -> list[int]:
    """Sainte-Lague: seats go one by one to the highest votes / (2 * seats held + 1); ties to the first.

    ``most`` bounds each share; seats that nobody may take are left over. The start is the exact share rounded, from
    which the true result differs by a few seats, so the work does not grow with the seats.
    """
    total = float(sum(votes))
    if total <= 0 or seats <= 0:
        return [0] * len(votes)
    held = [min(int(v * seats / total + 0.5), m) for v, m in zip(votes, most, strict=True)]
    spare = seats - sum(held)
    if spare > 0:
        heap = [(-v / (2 * h + 1), i) for i, (v, h, m) in enumerate(zip(votes, held, most, strict=True)) if v > 0 and h < m]
        heapq.heapify(heap)
        while spare and heap:
            _, i = heapq.heappop(heap)
            held[i] += 1
            spare -= 1
            if held[i] < most[i]:
                heapq.heappush(heap, (-votes[i] / (2 * held[i] + 1), i))
    elif spare < 0:
        heap = [(v / (2 * h - 1), -i) for i, (v, h) in enumerate(zip(votes, held, strict=True)) if h]
        heapq.heapify(heap)
        while spare:
            _, i = heapq.heappop(heap)
            held[-i] -= 1
            spare += 1
            if held[-i]:
                heapq.heappush(heap, (votes[-i] / (2 * held[-i] - 1), i))
    return held


def targets(sizes: Sequence[int], weights: Sequence[float], volume: float = VOLUME, most: float = MOST) -> list[float]:
    """Share ``volume`` times all sizes by weight; a share above ``most`` times its size stops there, the excess is
    shared again among the others until none is above."""
    out: list[float] = [0.0] * len(sizes)
    open_ = list(range(len(sizes)))
    left = volume * sum(sizes)
    while open_:
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = most * sizes[i]
        left = max(0.0, left - sum(out[i] for i in over))
        open_ = [i for i in open_ if i not in set(over)]
    return out


def _overlap(a: Column, b: Column, lo: Column, hi: Column) -> Column:
    """The part of [a, b) inside [lo, hi), relative to a."""
    start, end = F.greatest(a, lo), F.least(b, hi)
    return F.struct((start - a).alias("start"), (end - a).alias("end"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    volume: float = VOLUME,
    most: float = MOST,
    block: int = BLOCK,
    seed: int = SEED,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per input row: ``doc_id, size, source_size, target, taken, source, row_no, copies, parts``.

    ``size`` counts the words of the text (null or empty: 0), ``target`` and ``source_size`` are its source's. The mix
    takes the whole document ``copies`` times and besides the word ranges ``parts`` (start, end); ``taken`` sums both
    and is at most twice the size. Sources stand in code point order, null last, an empty name is a name. The order
    inside a shard hangs on seed, doc_id and size only, so reruns agree; rows that repeat both are alike in it. An
    empty table gives an empty table; rows of size 0 are returned with taken 0; further columns are ignored.
    """
    spark = docs.sparkSession
    rows = materialise(
        docs.select(
            "doc_id",
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
        .withColumn("key", F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "size")))
        .withColumn("row_no", F.monotonically_increasing_id()),
        "mix-rows",
    )
    # by source only: as many rows as there are sources
    found = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("words")).collect()
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [r.words for r in found]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], volume, most)
    blocks = apportion(goal, round(sum(goal) / block), [-int(-most * s // block) for s in sizes])
    known = {r.source: i for i, r in enumerate(found)}
    shards = [min(MOST_SHARDS, -(-r.n // shard_rows)) for r in found]
    table = spark.createDataFrame(
        [(r.source, s, n, g) for r, s, n, g in zip(found, sizes, shards, goal, strict=True)],
        "name string, source_size long, shards int, target double",
    )
    # as many rows as sources: broadcast by Spark where small, else joined by shuffle
    placed = rows.join(table, F.col("source").eqNullSafe(F.col("name")), "left").withColumn(
        "shard", F.pmod(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), F.col("shards"))
    )
    lines = sorted(
        placed.groupBy("source", "shard").agg(F.sum("size").alias("words")).collect(),
        key=lambda r: (known[r.source], r.shard),
    )
    by_source: dict[int, list] = {}
    for r in lines:
        by_source.setdefault(known[r.source], []).append(r)
    chosen = []
    for i, own in by_source.items():
        quotas = apportion([r.words for r in own], blocks[i], [-int(-most * r.words // block) for r in own])
        for r, q in zip(own, quotas, strict=True):
            words = min(q * block, int(most * r.words))
            full, part = divmod(words, r.words) if r.words else (0, 0)
            n = -(-r.words // block)
            start = int(hashlib.md5(f"{seed}:{r.source}:{r.shard}".encode()).hexdigest()[:12], 16) % n * block if n else 0
            chosen.append((r.source, r.shard, r.words, full, start, part))
    quota = spark.createDataFrame(
        chosen, "q_source string, q_shard long, line long, copies long, first long, part long"
    )
    order = Window.partitionBy("source", "shard").orderBy("key", "doc_id", "row_no").rowsBetween(Window.unboundedPreceding, 0)
    spread = placed.withColumn("end", F.sum("size").over(order)).withColumn("start", F.col("end") - F.col("size"))
    joined = spread.join(
        quota, F.col("source").eqNullSafe(F.col("q_source")) & (F.col("shard") == F.col("q_shard")), "left"
    )
    a, b, stop = F.col("start"), F.col("end"), F.col("first") + F.col("part")
    ahead = _overlap(a, b, F.col("first"), F.least(stop, F.col("line")))
    around = _overlap(a, b, F.lit(0).cast("long"), F.greatest(stop - F.col("line"), F.lit(0)))
    parts = F.filter(F.array(around, ahead), lambda p: p["end"] > p["start"])
    out = joined.withColumn("parts", parts)
    covered = F.aggregate("parts", F.lit(0).cast("long"), lambda t, p: t + p["end"] - p["start"])
    return out.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size") + covered).alias("taken"),
        "source",
        "row_no",
        "copies",
        "parts",
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as rows with the columns of ``docs``: a document as often as it is taken whole, then its parts.

    A part has its words joined by single blanks; ``n_chars``, where there is one, counts the new text. Rows with
    nothing taken, so also those without words, are not in a mix. Rows that repeat a doc_id are treated as one place in
    the mix each: they are told apart by size and their order within it.
    """
    decided = materialise(mix(docs), "mix-decided")
    words, row, nth, part = (spare(docs, n) for n in ("words", "row", "nth", "part"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    left = docs.withColumns({words: size, row: F.monotonically_increasing_id()})
    on = ["doc_id", "size"]
    if not decided.groupBy("doc_id").count().where("count > 1").isEmpty():
        left = left.withColumn(nth, F.row_number().over(Window.partitionBy("doc_id", words).orderBy(row)))
        same = Window.partitionBy("doc_id", "size").orderBy("row_no")
        decided = decided.withColumn("nth", F.row_number().over(same))
        on.append("nth")
    whole = F.array_repeat(F.lit(None).cast("struct<start:bigint,end:bigint>"), F.col("copies").cast("int"))
    chosen = decided.where("taken > 0").select(
        *[F.col(c).alias(f"mix_{c}") for c in on], F.concat(whole, "parts").alias("mix_parts")
    )
    equal = [left[a].eqNullSafe(chosen[f"mix_{b}"]) for a, b in zip(["doc_id", words, nth], on, strict=False)]
    out = left.join(chosen, reduce(and_, equal)).withColumn(part, F.explode(chosen["mix_parts"]))
    taken = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    start, end = F.col(f"{part}.start"), F.col(f"{part}.end")
    cut = F.array_join(F.slice(taken, (start + 1).cast("int"), (end - start).cast("int")), " ")
    out = out.withColumn("text", F.when(F.col(part).isNull(), F.col("text")).otherwise(cut))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        n = F.char_length("text").cast(kind if isinstance(kind, T.NumericType) else "long")
        out = out.withColumn("n_chars", F.when(F.col(part).isNull(), F.col("n_chars")).otherwise(n))
    return out.select(*docs.columns)
