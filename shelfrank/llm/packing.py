"""Packing documents into sequences by bin completion with branch and bound.

Only the number of pieces of each length decides how good a packing can be, and there are no more lengths than tokens in
a sequence. So the lengths are counted by Spark, the few thousand counts are solved on the driver into fillings with a
number of uses, and every piece then looks its place up by its rank among the pieces of its length.
"""

from __future__ import annotations

import logging
import os
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.llm.words import Prefixes, steps, word_spans
from shelfrank.session import materialise

CAPACITY = 2048
#: Pieces of the sequences that are packed anew where the first packing may be improved, and sets of pieces that this looks
#: at. What was found stands when they are used up; ``pack`` logs how far it is from the lower bound.
TAIL = 60
NODES = 20_000
#: Units whose ids a worker keeps.
UNITS_KEPT = 2_000_000
#: Pieces that are ranked in one task.
RANKED_TOGETHER = 200_000
#: Id that ends every document.
END = 0
#: Units that go through the tokenizer in one call.
TOGETHER = 4096
#: Byte-level models write a byte as a letter: itself where it prints, else one from 256 on; blanks part units here.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = np.arange(256, dtype="<u4")
BYTE_LETTERS[[b for b in range(256) if b not in _PRINTED]] = np.arange(256, 512 - len(_PRINTED))
BYTE_LETTERS[32] = 32
#: Multiplier of the second hash of units; any odd 64-bit number serves that is not the first's.
OTHER_BASE = np.uint64(0xC2B2AE3D27D4EB4F)

_count = np.arange(1, 257, dtype=np.uint64)
_small = np.arange(256, dtype=np.uint8)
_small[65:91] += 32
_letter = np.zeros(256, dtype=bool)
_letter[65:91] = _letter[97:123] = True
_second = np.zeros(256, dtype=bool)
_second[0x80:0xC0] = True
_second[[0x97, 0xB7]] = False
_mark = np.array([33 <= b < 127 and not chr(b).isalnum() and b not in b"'|" for b in range(256)])


@dataclass(frozen=True)
class Filling:
    """One way to fill a sequence: its lengths, largest first, and the number of sequences filled so."""

    lengths: tuple[int, ...]
    uses: int


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: the sum bound, raised by pieces too large to share a sequence.

    For every k, pieces above capacity - k stand with pieces below k only or alone; those above half stand apart from
    each other, and what the pieces from k on need beyond the room beside them is added.
    """
    total = sum(length * n for length, n in counts.items())
    best = -(-total // capacity)
    lengths = sorted(counts)
    for k in {0, *(x for x in lengths if x <= capacity // 2)}:
        alone = sum(counts[x] for x in lengths if x > capacity - k)
        half = [x for x in lengths if capacity // 2 < x <= capacity - k]
        n_half = sum(counts[x] for x in half)
        small = sum(x * counts[x] for x in lengths if k <= x <= capacity // 2)
        room = sum((capacity - x) * counts[x] for x in half)
        best = max(best, alone + n_half + max(0, -(-(small - room) // capacity)))
    return best


def best_fit_room(lengths: list[int], counts: dict[int, int], room: int) -> list[int]:
    """Fill the room greedily with the largest length that fits, again and again: the incumbent of the search."""
    used: dict[int, int] = {}
    out = []
    at = bisect_right(lengths, room)
    while at and room >= lengths[0]:
        at = min(at, bisect_right(lengths, room))
        if not at:
            break
        x = lengths[at - 1]
        if used.get(x, 0) < counts[x]:
            used[x] = used.get(x, 0) + 1
            out.append(x)
            room -= x
        else:
            at -= 1
    return out


class Sums:
    """For every prefix of the lengths the sums that their counts allow, as the bits of one number.

    The smallest waste of any filling follows at once, which bounds every branch exactly. What has not changed since the last
    filling is kept; a count only matters up to as many as fit.
    """

    def __init__(self, capacity: int):
        self.capacity, self.known, self.sums = capacity, [], [1]

    def update(self, lengths: list[int], counts: dict[int, int]) -> None:
        now = [(x, min(counts[x], self.capacity // x)) for x in lengths]
        same = next((k for k, (a, b) in enumerate(zip(now, self.known, strict=False)) if a != b), min(len(now), len(self.known)))
        del self.sums[same + 1 :]
        every = (1 << (self.capacity + 1)) - 1
        for x, n in now[same:]:
            found, step = self.sums[-1], 1
            while n:
                some = min(step, n)
                found |= found << (some * x) & every
                n, step = n - some, 2 * step
            self.sums.append(found)
        self.known = now

    def most(self, at: int, room: int) -> int:
        """The largest sum of the first ``at`` lengths that fits."""
        return (self.sums[at] & ((1 << (room + 1)) - 1)).bit_length() - 1


def complete(lengths: list[int], counts: dict[int, int], room: int, sums: Sums | None = None) -> list[int]:
    """The filling of ``room`` with the least waste, larger pieces first among equals.

    Branch and bound over undominated fillings: pieces go in from large to small; a branch whose least possible waste is
    not below the incumbent's is cut; a filling to which a piece could be added is dominated and never stands. The first
    incumbent is the best-fit filling, so the result is never worse than that. The bound is exact, so the search goes
    straight to a filling of least waste and needs no limit.
    """
    best = best_fit_room(lengths, counts, room)
    sums = sums or Sums(room)
    sums.update(lengths, counts)
    least = room - sums.most(len(lengths), room)
    if room - sum(best) == least:
        return best
    chosen: list[int] = []
    at, left = len(lengths), room
    while left > least:
        at = min(at, bisect_right(lengths, left))
        x = lengths[at - 1]
        # as many of the largest as still allow the least waste below them
        k = next(k for k in range(min(counts[x], left // x), -1, -1) if left - k * x - sums.most(at - 1, left - k * x) <= least)
        chosen += [x] * k
        at, left = at - 1, left - k * x
    return chosen


def greedy(counts: dict[int, int], capacity: int = CAPACITY) -> list[Filling]:
    """Fillings that use up the counts: the largest length left is completed with least waste, as often as the counts allow.

    At least one length is used up or falls below its number in the filling each time, so the steps follow the number of
    lengths. This is the first incumbent of ``solve``.
    """
    left = {x: n for x, n in counts.items() if n > 0}
    lengths = sorted(left)
    out, sums = [], Sums(capacity)
    while lengths:
        largest = lengths[-1]
        left[largest] -= 1
        own = {x: n for x, n in left.items() if n}
        chosen = [largest, *complete(sorted(own), own, capacity - largest, sums)]
        left[largest] += 1
        number = {x: chosen.count(x) for x in set(chosen)}
        uses = min(left[x] // k for x, k in number.items())
        for x, k in number.items():
            left[x] -= uses * k
            if not left[x]:
                del left[x]
        lengths = sorted(left)
        out.append(Filling(tuple(sorted(chosen, reverse=True)), uses))
    return out


def fillings_around(items: tuple[int, ...], capacity: int, waste: int) -> list[tuple[int, ...]]:
    """Undominated fillings of a sequence with the first (largest) of ``items`` (falling) that waste at most ``waste``.

    A filling is dominated if a piece outside it could be added, could take the place of one smaller piece, or could take
    that of two pieces whose sum it is not below: putting that piece in and those out leaves a problem that is no harder.
    """
    number: dict[int, int] = {}
    for x in items[1:]:
        number[x] = number.get(x, 0) + 1
    lengths = list(number)
    rest = [0]
    for x in reversed(lengths):
        rest.append(rest[-1] + x * number[x])
    rest.reverse()
    out = []
    stack: list[tuple[int, int, tuple[int, ...]]] = [(0, capacity - items[0], ())]
    while stack:
        at, left, chosen = stack.pop()
        if left - rest[at] > waste:
            continue
        if at == len(lengths):
            if left <= waste and not _dominated(chosen, left, number):
                out.append((items[0], *chosen))
            continue
        x = lengths[at]
        stack += [(at + 1, left - k * x, chosen + (x,) * k) for k in range(min(number[x], left // x) + 1)]
    return sorted(out, key=lambda f: (-sum(f), [-x for x in f]))


def _dominated(chosen: tuple[int, ...], left: int, number: dict[int, int]) -> bool:
    outside = [x for x, n in number.items() if n > chosen.count(x)]
    if not outside:
        return False
    if min(outside) <= left:
        return True
    own = sorted(set(chosen))
    if any(y < x <= y + left for y in own for x in outside):
        return True
    pairs = {own[i] + own[j] for i in range(len(own)) for j in range(i, len(own)) if i != j or chosen.count(own[i]) > 1}
    return any(p <= x <= p + left for p in pairs for x in outside)


def fewer(items: list[int], capacity: int, below: int, nodes: int = NODES) -> tuple[list[tuple[int, ...]] | None, bool]:
    """A packing of ``items`` into fewer than ``below`` sequences, or None, and whether the search was finished.

    Branch and bound: the largest piece left is completed by its undominated fillings in order of waste; a branch is cut
    when the waste so far is more than ``below`` - 1 sequences leave, when the lower bound of what is left is too high, or
    when the same pieces were left before with as many sequences.
    """
    spare = (below - 1) * capacity - sum(items)
    if spare < 0:
        return None, True
    seen: set[tuple[int, ...]] = set()
    stack: list[tuple[tuple[int, ...], int, tuple]] = [(tuple(sorted(items, reverse=True)), spare, ())]
    while stack:
        left, waste, done = stack.pop()
        if not left:
            return list(done), True
        if left in seen:
            continue
        seen.add(left)
        if len(seen) > nodes:
            return None, False
        counts: dict[int, int] = {}
        for x in left:
            counts[x] = counts.get(x, 0) + 1
        if len(done) + lower_bound(counts, capacity) >= below:
            continue
        # the least waste comes off the stack first
        for f in reversed(fillings_around(left, capacity, waste)):
            after = list(left)
            for x in f:
                after.remove(x)
            stack.append((tuple(after), waste - capacity + sum(f), (*done, f)))
    return None, True


def solve(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[Filling]:
    """Fillings that use up the counts of all lengths, in as few sequences as the search finds.

    The greedy fillings are the incumbent. Where it lies above the lower bound, the sequences that waste most, so many that
    one could be saved and not more than ``TAIL`` pieces, are packed anew by branch and bound, until the bound is met or
    nothing is saved. Small problems are such a tail as a whole and are solved exactly.
    """
    best = greedy(counts, capacity)
    bound = lower_bound({x: n for x, n in counts.items() if n > 0}, capacity)
    while sum(f.uses for f in best) > bound:
        by_waste = sorted(best, key=lambda f: sum(f.lengths))
        taken: list[tuple[Filling, int]] = []
        room = TAIL
        for f in by_waste:
            n = min(f.uses, room // len(f.lengths))
            if n:
                taken.append((f, n))
                room -= n * len(f.lengths)
        items = [x for f, n in taken for x in f.lengths * n]
        number = sum(n for _, n in taken)
        found, _ = fewer(items, capacity, number, nodes)
        if found is None:
            break
        rest = [Filling(f.lengths, f.uses - sum(n for g, n in taken if g is f)) for f in best]
        best = [f for f in rest if f.uses] + [Filling(f, found.count(f)) for f in dict.fromkeys(found)]
    return best


def unit_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches that the tokenizer treats alone: words, cut before marks that follow a letter.

    Letters are a-z, A-Z and those of two bytes that begin with C3; a mark is an ASCII one but the apostrophe, which has rules
    of its own, and the bar, which special tokens hold.
    """
    start, end = word_spans(data, offsets)
    if not len(start):
        return start, end
    begins, ends = (np.zeros(len(data) + 1, dtype=bool) for _ in range(2))
    begins[start] = ends[end] = True
    # a first byte of a row or word is none behind a letter
    inside = ~begins[1:-1]
    letter, mark = _letter[data], _mark[data]
    cut = mark[1:] & letter[:-1] & inside
    wide = np.flatnonzero(data[:-2] == 0xC3)
    wide = wide[mark[wide + 2] & _second[data[wide + 1]] & inside[wide + 1]] + 1
    cut[wide] = True
    begins[1:-1] |= cut
    ends[1:-1] |= cut
    return np.flatnonzero(begins), np.flatnonzero(ends)


class _Encoder:
    """Ids of texts, unit by unit.

    The tokenizer splits at white space and at marks behind letters and treats each part alone, so a text's ids are those of
    its units in turn. A worker keeps the ids of the units that it has met as arrays sorted by hash, up to a number; a
    batch's units are found there all at once, and only those that are new go through the tokenizer. Two hashes of 64 bits
    stand for a unit.
    """

    own: dict[str, _Encoder] = {}

    @classmethod
    def of(cls, path: str) -> _Encoder:
        """The encoder of this worker process."""
        if path not in cls.own:
            cls.own[path] = cls(path)
        return cls.own[path]

    def __init__(self, path: str, kept: int = UNITS_KEPT):
        # a worker is one task: threads of its own would only add memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer, self.kept = Tokenizer.from_file(path), kept
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        # ids that end a word, if the tokenizer marks them
        ends = [n for token, n in self.tokenizer.get_vocab().items() if token.endswith("</w>")]
        self.ends = np.isin(np.arange(self.tokenizer.get_vocab_size()), ends) if ends else None
        # of every known unit, by its first hash: the second, the place and number of its ids, the turn it was last met in
        self.hash, self.check = (np.zeros(0, np.uint64) for _ in range(2))
        self.place, self.length, self.met = (np.zeros(0, np.int64) for _ in range(3))
        self.ids = np.array([END], np.uint32)
        self.turn = 0

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows of bytes, the closing id behind each row's, and the index of each row's first id."""
        start, end = unit_spans(data, offsets)
        low = _small[data]
        bars = np.flatnonzero(data == 0x7C)
        for k in np.unique(np.searchsorted(start, bars, side="right") - 1) if len(bars) else ():
            # a unit with a bar may be a special token, which is told by its case
            low[start[k] : end[k]] = data[start[k] : end[k]]
        plain = self._plain(low, start, end)
        first = Prefixes(low, values=_count).hashes(start, end)
        second = Prefixes(low, OTHER_BASE, _count).hashes(start, end)
        found, at, which = np.unique(first, return_index=True, return_inverse=True)
        if (second != second[at][which]).any():
            # two units of one hash: each occurrence for itself
            found, at, which = first, np.arange(len(first)), np.arange(len(first))
            order = np.argsort(found, kind="stable")
            found, at = found[order], at[order]
            which[order] = np.arange(len(order))
        at = self._known(low, start[at], end[at], found, second[at], plain[at])
        # the closing id, which is the first of all, stands behind each row's units
        rows = np.searchsorted(start, offsets[1:])
        unit = np.insert(which, rows, len(found))
        number = np.append(self.length[at], 1)[unit]
        upto = np.cumsum(number)
        place = np.append(self.place[at], 0)[unit]
        out = self.ids[np.repeat(place - upto + number, number) + np.arange(upto[-1] if len(upto) else 0)]
        if len(self.hash) > self.kept:
            self._forget()
        return out, np.concatenate([[0], upto[rows + np.arange(len(rows))]])

    def _known(
        self, data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, second: np.ndarray, plain: np.ndarray
    ) -> np.ndarray:
        """Places among the known units of units sorted by their first hash; new ones are encoded and put there."""
        self.turn += 1
        at = np.searchsorted(self.hash, first)
        near = np.minimum(at, len(self.hash) - 1)
        known = (self.hash[near] == first) & (self.check[near] == second) if len(self.hash) else np.zeros(len(first), bool)
        new = np.flatnonzero(~known)
        if len(new):
            ids, place, length = self._encode(data, start[new], end[new], plain[new])
            place += len(self.ids)
            self.ids = np.concatenate([self.ids, ids])
            here = at[new]
            self.hash, self.check = np.insert(self.hash, here, first[new]), np.insert(self.check, here, second[new])
            self.place, self.length = np.insert(self.place, here, place), np.insert(self.length, here, length)
            self.met = np.insert(self.met, here, self.turn)
            at = np.searchsorted(self.hash, first)
            # of units with one first hash the right one stands a few places on
            while (wrong := self.check[at] != second).any():
                at[wrong] += 1
        self.met[at] = self.turn
        return at

    def _plain(self, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether units are letters a-z and of two bytes that begin with C3 alone; capitals of the latter become small."""
        wide = np.flatnonzero((low[:-1] == 0xC3) & _second[low[1:]]) + 1
        good = _letter[low]
        good[wide] = good[wide - 1] = True
        bad = np.concatenate([[0], np.cumsum(~good)])
        plain = bad[end] == bad[start]
        if len(wide) and len(start):
            capital = wide[low[wide] < 0x9F]
            unit = np.maximum(np.searchsorted(start, capital, side="right") - 1, 0)
            low[capital[plain[unit] & (capital < end[unit])]] += 0x20
        return plain

    def _forget(self) -> None:
        """Keep the units met last, half of them at least."""
        keep = self.met >= np.partition(self.met, len(self.met) // 2)[len(self.met) // 2]
        if keep.all():
            keep = np.arange(len(keep)) % 2 == 0
        length = self.length[keep]
        upto = np.cumsum(length)
        ids = self.ids[np.repeat(self.place[keep] - upto + length, length) + np.arange(upto[-1])]
        self.hash, self.check, self.met, self.length = self.hash[keep], self.check[keep], self.met[keep], length
        self.place, self.ids = 1 + upto - length, np.concatenate([self.ids[:1], ids])

    def _encode(
        self, data: np.ndarray, start: np.ndarray, end: np.ndarray, plain: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of units in any order, and the place and number of those of each."""
        found, at, length, n = [], [], [], 0
        if self.ends is None:
            plain = np.zeros(len(start), bool)
        for kind, run in ((plain, self._letters), (~plain, self._others)):
            own = np.flatnonzero(kind)
            for lo in range(0, len(own), TOGETHER):
                units = own[lo : lo + TOGETHER]
                ids, number = run(data, start[units], end[units])
                found.append(ids)
                at.append(units)
                length.append(number)
        at, number = np.concatenate(at), np.concatenate(length)
        place, length = np.empty(len(start), np.int64), np.empty(len(start), np.int64)
        place[at], length[at] = np.cumsum(number) - number, number
        return np.concatenate(found), place, length

    def _others(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of any units one behind the other, and their number for each."""
        raw = [data[a:b].tobytes().decode() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(raw, add_special_tokens=False)]
        return np.array([x for own in ids for x in own], dtype=np.uint32), np.array([len(x) for x in ids], dtype=np.int64)

    def _letters(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of units of small letters alone, by the tokenizer's model in one call: as the bytes' letters that its
        splitter makes, parted by blanks; the last id of a unit tells that it is the last."""
        length = end - start
        stop = np.cumsum(length + 1) - 1
        joined = np.full(int(stop[-1]) + 1, 32, dtype=np.uint8)
        letters = np.ones(len(joined), dtype=bool)
        letters[stop] = False
        joined[letters] = data[np.repeat(start - stop + length, length) + np.flatnonzero(letters)]
        text = BYTE_LETTERS[joined].tobytes().decode("utf-32-le")
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
        return ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Rows ``doc_id, piece, start, length, ids_crc32``: each document's ids and the closing id, cut where too long.

    A null or empty text has the closing id alone. Every row of a repeated document is a document of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _Encoder.of(tokenizer_path)
        for batch in batches:
            for lo, hi, data, offsets in steps(batch.column(1)):
                ids, first = encode(data, offsets)
                pieces = -(-np.diff(first) // capacity)
                row = np.repeat(np.arange(hi - lo), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(first[row + 1] - first[row] - start, capacity)
                raw = memoryview(ids.astype("<u4").tobytes())
                at = 4 * (first[row] + start)
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row + lo, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _slots(fillings: list[Filling]) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of each length go: rows (length, first rank, times in a sequence, place, first sequence)."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for f in fillings:
        place = 0
        for x in sorted(set(f.lengths), reverse=True):
            times = f.lengths.count(x)
            rows.append((x, used.get(x, 0), times, place, base))
            used[x] = used.get(x, 0) + times * f.uses
            place += times * x
        base += f.uses
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return table, table[:, 0] * (1 << 44) + table[:, 1]


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Every piece lies whole in one sequence; the pieces of a sequence stand one behind the other from offset 0, largest
    first, and hold at most ``capacity`` ids. Null and empty texts are pieces of one id. Rows that repeat are packed
    each; a null doc_id is returned as such; an empty table gives an empty table; further columns are ignored.
    """
    pieces = materialise(cut_pieces(docs, tokenizer_path, capacity), "pieces")
    counted = pieces.groupBy("length").agg(F.count("*").alias("n"))
    # at most ``capacity`` rows, whatever the corpus
    counts = {r.length: r.n for r in counted.collect()}
    fillings = solve(counts, capacity, nodes)
    used, bound = sum(f.uses for f in fillings), lower_bound(counts, capacity)
    logging.getLogger(__name__).info("%d sequences, lower bound %d", used, bound)
    table, keys = _slots(fillings)
    parts = max(1, -(-sum(counts.values()) // RANKED_TOGETHER))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
    # a length that very many pieces have is ranked in parts: by salt, then by the counts of the parts before
    before = (
        salted.groupBy("length", "salt")
        .agg(F.count("*").alias("n"))
        .withColumn("ahead", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n"))
        .drop("n")
    )
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start")
    ranked = (
        salted.withColumn("rank", F.row_number().over(inside) - 1)
        .join(before, ["length", "salt"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("ahead")).alias("rank"))
    )
    slots = docs.sparkSession.sparkContext.broadcast((table, keys))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, keys = slots.value
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 5))
            _, first, times, at, base = table[np.searchsorted(keys, length * (1 << 44) + rank, side="right") - 1].T
            nth, which = np.divmod(rank - first, times)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(base + nth, pa.int64()), pa.array(at + which * length, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    schema = ranked.drop("rank").schema
    return ranked.mapInArrow(place, schema.add("sequence_id", "long").add("offset", "long"))
