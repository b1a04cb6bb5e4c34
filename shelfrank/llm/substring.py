"""Substring deduplication by content-defined chunking.

A gear hash rolls over the bytes of a text; after a word where its top bits are zero a chunk may end, and it ends at the
first such place that gives it enough words. A cut depends on the few bytes before it only, so a passage is cut alike
wherever it stands, from shortly after its start on. A chunk starts at every cut, so chunks overlap and an insertion
spoils those around it only. Chunks are compared by digest over the whole corpus; stretches covered by chunks that other
documents have too are the repeated passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.tables import spare
from shelfrank.llm.words import Prefixes, mix, steps, word_spans
from shelfrank.session import materialise

#: A cut stands after a word with probability 1 / 2 ** CUT_BITS, and after this many words without one.
CUT_BITS = 2
MOST_WORDS = 32
#: Words of a chunk at least.
CHUNK_WORDS = 8
#: Words that a passage has at least. Of a repeated stretch the words before its first cut and after its last, together
#: six on average, are not in whole chunks.
LEAST_WORDS = 25

_gear = mix(np.arange(1, 257, dtype=np.uint64)).astype(np.uint16)
_gear[65:91] = _gear[97:123]
_gear[[9, 10, 11, 12, 13]] = _gear[32]


def gear_hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The rolling hash after every byte: 16 bits, so 16 bytes back, from the start of the row at most."""
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    h = _gear[data]
    for reach in (1, 2, 4, 8):
        back = np.zeros_like(h)
        back[reach:] = h[:-reach] << np.uint16(reach)
        back[place < reach] = 0
        h = h + back
    return h


def cut_chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, first byte, byte after the last, first word (in the row) and word after the last of every chunk."""
    start, end = word_spans(data, offsets)
    if not len(start):
        return (np.zeros(0, np.int64),) * 5
    row = np.searchsorted(offsets, start, side="right") - 1
    h = gear_hashes(data, offsets)
    opens = np.ones(len(start), dtype=bool)
    opens[1:] = (h[end[:-1] - 1] >> np.uint16(16 - CUT_BITS)) == 0
    opens[1:] |= row[1:] != row[:-1]
    first = np.flatnonzero(opens)
    opens |= (np.arange(len(start)) - first[np.cumsum(opens) - 1]) % MOST_WORDS == 0
    first = np.flatnonzero(opens)
    cuts = np.append(first[1:], len(start))
    at = np.searchsorted(cuts, first + CHUNK_WORDS)
    whole = at < len(cuts)
    first, after = first[whole], cuts[at[whole]]
    whole = row[first] == row[after - 1]
    first, after = first[whole], after[whole]
    base = np.searchsorted(start, offsets)[row[first]]
    return row[first], start[first], end[after - 1], first - base, after - base


def _packed(start: np.ndarray, stop: np.ndarray, word: np.ndarray, word_stop: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Places of the chunks of each row (``cuts`` bounds them) in few bytes: steps between starts and widths, in bytes
    as two bytes each (eight in a row with longer ones), in words as one byte each, which they always fit."""
    step, hop = start.copy(), word.copy()
    inside = np.ones(len(start), dtype=bool)
    inside[cuts[:-1][cuts[:-1] < len(start)]] = False
    at = np.flatnonzero(inside)
    step[at] -= start[at - 1]
    hop[at] -= word[at - 1]
    sizes = step, stop - start
    wide = np.maximum(*sizes) >= 1 << 16
    short = [v.astype("<u2").tobytes() for v in sizes]
    words = [v.astype(np.uint8).tobytes() for v in (hop, word_stop - word)]
    out = []
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if wide[i:j].any():
            own = [b"\x08", *(v[i:j].astype("<u8").tobytes() for v in sizes)]
        else:
            own = [b"\x02", *(v[2 * i : 2 * j] for v in short)]
        out.append(b"".join([*own, *(v[i:j] for v in words)]))
    return pa.array(out, pa.binary())


def _unpacked(raw: bytes) -> tuple[np.ndarray, ...]:
    size = raw[0]
    n = (len(raw) - 1) // (2 * size + 2)
    start, width = np.frombuffer(raw, f"<u{size}", 2 * n, 1).astype(np.int64).reshape(2, n)
    word, words = np.frombuffer(raw, np.uint8, 2 * n, 1 + 2 * size * n).astype(np.int64).reshape(2, n)
    start, word = start.cumsum(), word.cumsum()
    return start, start + width, word, word + words


def chunk_table(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``row_no, doc_id, places, digest``, the last two over its chunks.

    Places are bytes of the UTF-8 text and words of it. Texts of fewer than ``CHUNK_WORDS`` words have no chunks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in steps(batch.column(2)):
                row, start, stop, word, word_stop = cut_chunks(data, offsets)
                digest = Prefixes(data).hashes(start, stop).view(np.int64) if len(row) else start
                cuts = np.searchsorted(row, np.arange(hi - lo + 1))
                places = _packed(start - offsets[row], stop - offsets[row], word, word_stop, cuts)
                digests = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(digest, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(lo, hi - lo) for k in range(2)]
                    + [places, digests],
                    names=["row_no", "doc_id", "places", "digest"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(F.monotonically_increasing_id().alias("row_no"), "doc_id", "text").mapInArrow(
        run, f"row_no long, doc_id {kind}, places binary, digest array<long>"
    )


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches that a row's repeated chunks cover, from its places and ``found`` (nth, first row, places)."""
    for batch in batches:
        out = []
        for row in range(batch.num_rows):
            row_no = batch.column(0)[row].as_py()
            start, stop, word, word_stop = _unpacked(batch.column(1)[row].as_py())
            found = batch.column(2)[row].values
            nth, first, n = (found.field(k).to_numpy() for k in range(3))
            order = np.argsort(nth)
            nth, first, n = nth[order], first[order], n[order]
            own = first == row_no
            far = np.maximum.accumulate(word_stop[nth])
            opens = np.ones(len(nth), dtype=bool)
            opens[1:] = word[nth[1:]] > far[:-1]
            stretch = np.cumsum(opens)
            cut = np.flatnonzero(opens)
            size = (np.maximum.reduceat(word_stop[nth], cut) - word[nth[cut]])[stretch - 1]
            # within a stretch, chunks that stand here first and those that do not take turns: what the first ones cover
            # stays, and the others have the rest
            opens[1:] |= own[1:] != own[:-1]
            cut = np.flatnonzero(opens)
            ends = np.append(cut[1:], len(nth))
            parts = [
                (own[c], stretch[c], start[nth[c]], stop[nth[c:e]].max(), word[nth[c]], word_stop[nth[c:e]].max(), n[c:e].max(), first[c], size[c])
                for c, e in zip(cut, ends, strict=True)
            ]
            for i, (keeps, group, begin, end, w, w_end, most, head, whole) in enumerate(parts):
                if not keeps:
                    after = i > 0 and parts[i - 1][1] == group
                    if after:
                        begin, w = max(begin, parts[i - 1][3]), max(w, parts[i - 1][5])
                    if i + 1 < len(parts) and parts[i + 1][1] == group and parts[i + 1][2] <= end + 1:
                        # a blank stays between what is left on both sides
                        end, w_end = parts[i + 1][2] - after, min(w_end, parts[i + 1][4])
                if w < w_end:
                    out.append((row_no, begin, end, w_end - w, most, head, keeps, whole))
        names = ["row_no", "start", "stop", "n_words", "n_places", "first_row", "kept", "whole"]
        kinds = [pa.int64()] * 6 + [pa.bool_(), pa.int64()]
        columns = zip(*out, strict=True) if out else [[]] * 8
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def repeated_passages(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per repeated passage and place: ``doc_id, start, stop, n_words, n_places, first_doc_id, kept, row_no``.

    A passage is a stretch of at least ``least_words`` words covered by chunks that each stand in another row too, or the
    parts of one that this row has first (of as many words themselves, else they just stay) and that it has not; ``start`` and ``stop`` are bytes of the UTF-8 text. ``n_places`` counts the places of the most frequent of its
    chunks, ``first_doc_id`` is the document of the earliest row that has the passage's first chunk, and ``kept`` is
    true where this row is the earliest for all its chunks. Others have nothing of those, so they can go and every chunk
    still stands where it was first. Rows that repeat a doc_id are
    different places. Texts that are null, empty or shorter have no passages; a null doc_id is returned as such; an
    empty table gives an empty table; further columns are ignored.
    """
    table = materialise(chunk_table(docs), "chunks")
    chunks = table.select("row_no", F.posexplode("digest").alias("nth", "digest"))
    # partial counts come first, so a chunk that very many rows have is no single task; Spark splits it in the join
    shared = (
        chunks.groupBy("digest")
        .agg(F.min("row_no").alias("first_row"), F.max("row_no").alias("last_row"), F.count("*").alias("n_places"))
        .where("first_row < last_row")
        .drop("last_row")
    )
    found = (
        chunks.join(shared, "digest")
        .groupBy(F.col("row_no").alias("found_no"))
        .agg(F.collect_list(F.struct("nth", "first_row", "n_places")).alias("found"))
    )
    places = table.select("row_no", "places").join(found, F.col("row_no") == F.col("found_no"))
    runs = (
        places.drop("found_no")
        .mapInArrow(
            _stretches,
            "row_no long, start long, stop long, n_words long, n_places long, first_row long, kept boolean, whole long",
        )
        .where(F.col("whole") >= least_words)
        .where(~F.col("kept") | (F.col("n_words") >= least_words))
    )
    ids = table.select("row_no", "doc_id")
    return (
        runs.join(ids, "row_no")
        .join(ids.toDF("first_row", "first_doc_id"), "first_row")
        .select("doc_id", "start", "stop", "n_words", "n_places", "first_doc_id", "kept", "row_no")
    )


def remove_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """The documents with the passages that are not kept cut out of their texts.

    ``docs`` is the stored table that the passages were found in, read the same way: rows are known by their number in it, so
    documents may share a doc_id or have none.
    """
    number, own_id = spare(docs, "row_no"), spare(docs, "cut_id")
    cuts = passages.where(~F.col("kept")).groupBy(F.col("row_no").alias("cut_no"), F.col("doc_id").alias(own_id)).agg(
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias(spare(docs, "cuts"))
    )
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            cuts = batch.column(batch.num_columns - 1).to_pylist()
            out = []
            for text, own in zip(texts, cuts, strict=True):
                if text is not None and own:
                    raw, kept, last = text.encode(), [], 0
                    for c in own:
                        kept.append(raw[last : c["start"]])
                        last = max(last, c["stop"])
                    text = b"".join([*kept, raw[last:]]).decode()
                out.append(text)
            columns = batch.columns[:-1]
            columns[at] = pa.array(out, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    numbered = docs.withColumn(number, F.monotonically_increasing_id())
    same = (numbered[number] == cuts["cut_no"]) & numbered["doc_id"].eqNullSafe(cuts[own_id])
    return numbered.join(cuts, same, "left").drop(cuts["cut_no"], cuts[own_id], numbered[number]).mapInArrow(run, docs.schema)
