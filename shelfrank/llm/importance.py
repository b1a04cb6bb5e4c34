"""Target-distribution importance resampling over hashed word runs, hashed with a position-table CRC.

A CRC is linear but for a constant of the length: the CRC of a span is the XOR of one contribution per byte, which depends
on the byte and its distance from the span's end only, and of the CRC of as many zero bytes. So contributions come from one
table (distance x byte), ``bitwise_xor.reduceat`` folds those of all spans of a batch at once, and no byte is looked at in
a Python loop. Spans longer than the table are cut into blocks counted from their end; the values of neighbouring blocks
are folded pairwise, the farther one moved on by as many zero bytes as the nearer holds.

Counts of the buckets over all documents and over the target texts give every bucket a gain; a document's weight is the
mean gain of its features, and Gumbel noise from a hash of its id turns the highest scores into a seeded draw without
replacement by those weights.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.tables import keep_rows, text_key
from shelfrank.llm.words import steps, word_spans
from shelfrank.session import materialise

BUCKETS = 10_000
#: Words of the runs that are features.
RUNS = (1, 2)
#: Documents with fewer words are never drawn; of the others this share (percent) is.
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: Distances from the end that the table holds, a power of two; longer spans are folded from blocks of so many bytes.
REACH = 64
#: Rows that one task numbers, on average.
RANKED_TOGETHER = 1_000_000

_REFLECTED = np.uint32(0xEDB88320)  # fixed: the polynomial of crc32

_apart = np.ones(256, dtype=bool)
_apart[48:58] = _apart[65:91] = _apart[97:123] = _apart[128:] = False
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def _byte_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ _REFLECTED, out >> 1)
    return out.astype(np.uint32)


def _moved(value: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Values moved on by the zero bytes that the four tables of 256 stand for."""
    out = by[0][value & np.uint32(255)]
    for k in (1, 2, 3):
        out = out ^ by[k][(value >> np.uint32(8 * k)) & np.uint32(255)]
    return out


class PositionTable:
    """crc32 of many spans of one byte array."""

    def __init__(self, reach: int = REACH):
        one = _byte_table()
        self.reach = reach
        self.table = np.empty((reach, 256), dtype=np.uint32)
        self.table[0] = one
        for d in range(1, reach):
            before = self.table[d - 1]
            self.table[d] = (before >> np.uint32(8)) ^ one[before & np.uint32(255)]
        self.flat = self.table.ravel()
        # what ``reach`` zero bytes make of each byte of a value; doubled tables follow as they are needed
        step = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
        for _ in range(reach):
            step = (step >> np.uint32(8)) ^ one[step & np.uint32(255)]
        self.moves = [step]
        self.zeros = np.array([zlib.crc32(bytes(n)) for n in range(4 * reach)], dtype=np.uint32)

    def _constants(self, length: np.ndarray) -> np.ndarray:
        """crc32 of as many zero bytes."""
        near = length < len(self.zeros)
        if near.all():
            return self.zeros[length]
        out = self.zeros[np.where(near, length, 0)]
        far, which = np.unique(length[~near], return_inverse=True)
        out[~near] = np.array([zlib.crc32(bytes(int(n))) for n in far], dtype=np.uint32)[which]
        return out

    def crc32(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """crc32 of every ``data[start:end]``; spans may overlap, and none is empty."""
        length = end - start
        if not len(length):
            return np.zeros(0, dtype=np.uint32)
        blocks = -(-length // self.reach)
        if blocks.max() == 1:
            nth, b_end, b_length = None, end, length
        else:
            nth = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            b_end = np.repeat(end, blocks) - nth * self.reach
            b_length = np.minimum(b_end - np.repeat(start, blocks), self.reach)
        after = np.cumsum(b_length)
        # place of every byte of every block, and how far it stands from the block's end
        back = np.repeat(after, b_length) - np.arange(1, after[-1] + 1)
        at = np.repeat(b_end - 1, b_length) - back
        value = np.bitwise_xor.reduceat(self.flat[(back << 8) | data[at]], after - b_length)
        if nth is not None:
            value = self._fold(value, nth)
        return value ^ self._constants(length)

    def _fold(self, value: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """One value a span from those of its blocks, which stand in turn from the span's end on."""
        level = 0
        while nth.any():
            if level == len(self.moves):
                self.moves.append(_moved(self.moves[-1], self.moves[-1]))
            odd = (nth & 1).astype(bool)
            place = np.cumsum(~odd) - 1
            out = value[~odd]
            out[place[odd]] ^= _moved(value[odd], self.moves[level])
            value, nth = out, nth[~odd] >> 1
            level += 1
        return value


_own: dict[int, PositionTable] = {}


def position_table(reach: int = REACH) -> PositionTable:
    """The table of this worker process."""
    if reach not in _own:
        _own[reach] = PositionTable(reach)
    return _own[reach]


def run_hashes(column: pa.Array, runs: tuple[int, ...] = RUNS) -> Iterator[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """Words of every row, and for each run length the crc32 of all runs and the index of each row's first, part by part.

    A word is a run of letters a-z (A-Z count as such), digits and bytes above 127; the words of a run are joined by one
    space. A null is a row without words.
    """
    table = position_table()
    for _, _, data, offsets in steps(column):
        start, end = word_spans(data, offsets, _apart) if len(data) else (np.zeros(0, np.int64),) * 2
        first = np.searchsorted(start, offsets)
        length = end - start
        # the words alone, a space behind each
        stop = np.cumsum(length + 1) - 1
        joined = np.full(int(stop[-1]) + 1 if len(stop) else 0, 32, dtype=np.uint8)
        letters = np.ones(len(joined), dtype=bool)
        letters[stop] = False
        joined[letters] = _lower[data[~_apart[data]]]
        begin = stop - length
        words = np.diff(first)
        found = []
        for n in runs:
            count = np.maximum(words - n + 1, 0)
            at = np.concatenate([[0], np.cumsum(count)])
            own = np.repeat(first[:-1] - at[:-1], count) + np.arange(at[-1])
            found.append((table.crc32(joined, begin[own], stop[own + n - 1]), at))
        yield words, found


def bucket_counts(texts: DataFrame, runs: tuple[int, ...] = RUNS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of a table's ``text`` fall into each bucket: one number a bucket, whatever the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, found in run_hashes(batch.column(0), runs):
                for crc, _ in found:
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    summed = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    # at most ``buckets`` rows
    for r in summed.collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the smoothed log ratio of the target's share of each bucket to the corpus's."""
    n = len(corpus)
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Floored thousandths of a Gumbel number from a hash of the id; a null id counts as an empty text."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def score_documents(
    docs: DataFrame, target: DataFrame, runs: tuple[int, ...] = RUNS, buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    """One row per document: ``doc_id, text_key, n_words, n_features, weight, score``; ``target`` has a column ``text``."""
    gains = bucket_gains(bucket_counts(docs, runs, buckets), bucket_counts(target, runs, buckets))
    kept = docs.sparkSession.sparkContext.broadcast(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = kept.value
        for batch in batches:
            n_words, n_features, weight = [], [], []
            for words, found in run_hashes(batch.column(2), runs):
                n = np.zeros(len(words), dtype=np.int64)
                total = np.zeros(len(words), dtype=np.int64)
                for crc, at in found:
                    upto = np.concatenate([[0], np.cumsum(gains[crc % np.uint32(buckets)])])
                    n += np.diff(at)
                    total += upto[at[1:]] - upto[at[:-1]]
                n_words.append(words)
                n_features.append(n)
                weight.append(total // np.maximum(n, 1))
            if n_words:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), *(pa.array(np.concatenate(x)) for x in (n_words, n_features, weight))],
                    names=["doc_id", "text_key", "n_words", "n_features", "weight"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    weighed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text").mapInArrow(
        run, f"doc_id {kind}, text_key long, n_words long, n_features long, weight long"
    )
    return weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def draw(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    runs: tuple[int, ...] = RUNS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    ranked_together: int = RANKED_TOGETHER,
) -> DataFrame:
    """One row per document: ``doc_id, text_key, n_words, n_features, weight, score, rank``.

    Of the documents with at least ``least_words`` words, ``percent`` in a hundred (rounded down) are drawn: those with the
    highest scores, ties to the smaller doc_id (null last); ``rank`` numbers them from 1 and is null for all others. Null
    and empty texts have no feature and weight 0. Rows that repeat are documents of their own, with ranks one behind the
    other. An empty table gives an empty table, an empty target gives gains by the corpus alone; further columns are
    ignored. The order is cut into ranges of scores and ids, each numbered by one task, so no task sorts the whole.
    """
    spark = docs.sparkSession
    scored = materialise(score_documents(docs, target, runs, buckets, seed), "importance-scores")
    able = F.col("n_words") >= least_words
    n = scored.where(able).count()
    wanted = percent * n // 100
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // ranked_together))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ranged = scored.where(able).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # the id's lower 33 bits count the rows of a partition, the others are its number
    ranged = materialise(ranged.withColumn("_id", F.monotonically_increasing_id()), "importance-order")
    part = F.shiftright("_id", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).collect()  # one row a range
    ahead, total = {}, 0
    for r in sorted(sizes, key=lambda r: r["_part"]):
        ahead[r["_part"]] = total
        total += r["_n"]
    offsets = spark.createDataFrame(list(ahead.items()), "_part long, _ahead long")
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_ahead") + 1
    ranked = ranged.withColumn("_part", part).join(F.broadcast(offsets), "_part").select(
        *scored.columns, F.when(place <= wanted, place).alias("rank")
    )
    return ranked.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))


def resampled_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The documents that are drawn, with all their columns; of drawn rows that repeat doc_id and text one stays."""
    drawn = draw(docs, target, **options)
    decided = drawn.select("doc_id", "text_key", F.col("rank").isNotNull().alias("kept"))
    return keep_rows(docs, materialise(decided, "importance-drawn"))
