"""Words of whole Arrow string columns as 64-bit hashes, found with array operations instead of a loop per word.

A word is a run of bytes other than the six ASCII blanks; A-Z count as a-z. The hash of a word is a polynomial in its
bytes modulo 2^64 followed by a finaliser, so equal words have equal hashes in every task and every session.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLANKS = b" \t\n\x0b\x0c\r"
#: Odd multipliers of the hashes; any odd 64-bit numbers serve.
BASE = np.uint64(0x9E3779B97F4A7C15)
SHINGLE = (np.uint64(2**64 - 59) * np.arange(3, 203, 2, dtype=np.uint64)) ^ np.uint64(0xD6E8FEB86659FD92)
#: Bytes of text that one step works on; a longer text is a step of its own.
STEP_BYTES = 1 << 20

_blank = np.zeros(256, dtype=bool)
_blank[list(BLANKS)] = True
_lower = np.arange(1, 257, dtype=np.uint64)
_lower[65:91] += np.uint64(32)
_form = np.arange(1, 257, dtype=np.uint64)
_form[97:123] = _form[128:] = 1
_form[65:91] = 2
_form[48:58] = 3
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of a public 64-bit hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power(name: str, base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; what one step needs is kept, longer tables are made anew."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n, STEP_BYTES + 1), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= STEP_BYTES + 1:
            _powers[name] = have
    return have[:n]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and the offsets of its rows; a null is an empty row."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    first, last = int(offsets[0]), int(offsets[-1])
    if data is None or first == last:
        return np.zeros(0, dtype=np.uint8), offsets - first
    return np.frombuffer(data, dtype=np.uint8)[first:last], offsets - first


def steps(column: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column into runs of whole rows of about ``limit`` bytes: first row, row after the last, bytes, offsets."""
    if not len(column):
        return
    data, offsets = raw(column)
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), rows)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


class Prefixes:
    """Running sums from which the hash of any stretch of the bytes follows at once.

    ``values`` says what a byte counts (A-Z as a-z unless another table is given), ``base`` is any odd multiplier.
    """

    def __init__(self, data: np.ndarray, base: np.uint64 = BASE, values: np.ndarray = _lower):
        n = len(data)
        inverse = pow(int(base), -1, 1 << 64)
        self.total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values[data] * _power(f"inverse {base}", inverse, n), out=self.total[1:])
        self.base = _power(f"base {base}", int(base), n + 1)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.base[end])


def stretch_hash(text: str) -> int:
    """The hash that ``Prefixes`` gives the bytes of a text."""
    data = np.frombuffer(text.encode(), np.uint8)
    return int(Prefixes(data).hashes(np.array([0]), np.array([len(data)]))[0])


def word_spans(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = _blank) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every word and the byte after its last; rows end words."""
    n = len(data)
    blank = blank[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    before, after = cut[:n].copy(), cut[1:].copy()
    before[1:] |= blank[:-1]
    after[:-1] |= blank[1:]
    start = np.flatnonzero(~blank & before)
    end = np.flatnonzero(~blank & after) + 1
    return start, end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, their first byte, the byte after the last, and the index of each row's first word."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    start, end = word_spans(data, offsets)
    return Prefixes(data).hashes(start, end), start, end, np.searchsorted(start, offsets)


def word_forms(data: np.ndarray, start: np.ndarray, end: np.ndarray, words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashes of the words' forms: runs of small letters, capitals and digits count as one mark, other bytes stand for
    themselves once a run, and a word equal to the one before it in its row has a form of its own."""
    if not len(words):
        return words
    marks = _form[data]
    new = np.ones(len(data), dtype=bool)
    new[1:] = marks[1:] != marks[:-1]
    new[start] = True
    kept = np.flatnonzero(new & ~_blank[data])
    lo, hi = np.searchsorted(kept, start), np.searchsorted(kept, end)
    total = np.zeros(len(kept) + 1, dtype=np.uint64)
    inverse = pow(int(BASE), -1, 1 << 64)
    np.cumsum(marks[kept] * _power(f"inverse {BASE}", inverse, len(kept)), out=total[1:])
    forms = mix((total[hi] - total[lo]) * _power(f"base {BASE}", int(BASE), len(kept) + 1)[hi])
    again = np.zeros(len(words), dtype=bool)
    again[1:] = words[1:] == words[:-1]
    again[first[:-1][first[:-1] < len(words)]] = False
    return np.where(again, np.uint64(1), forms)


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside rows, repeats included, and the index of each row's first run.

    A row with fewer words, but one at least, has its whole sequence as its only run.
    """
    count = np.diff(first)
    runs = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    at = np.concatenate([[0], np.cumsum(runs)])
    if not at[-1]:
        return np.zeros(0, np.uint64), at
    row = np.repeat(np.arange(len(count)), runs)
    start = first[row] + np.arange(at[-1]) - at[row]
    out = np.zeros(at[-1], dtype=np.uint64)
    length = np.minimum(count, size)[row]
    for k in range(size):
        # a missing word counts as nothing; the length goes into the hash
        there = k < length
        out += np.where(there, words[np.minimum(start + k, len(words) - 1)] * SHINGLE[k], np.uint64(0))
    return mix(out + length.astype(np.uint64)), at
