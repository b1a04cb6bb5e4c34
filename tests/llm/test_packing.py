import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shelfrank.llm import packing
from shelfrank.llm.words import steps
from tests.llm.frames import frame, odd_rows, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_pieces(rows, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for doc_id, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            out.append((doc_id, n, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    return sorted(map(str, out))


@pytest.mark.parametrize("capacity", [2048, 50])
def test_pieces_and_places(spark, capacity):
    rows = odd_rows() + [(i, prose(i, i % 37)) for i in range(100, 300)] + [(400, "a<|endoftext|>b 's ﬁ")] * 3
    got = packing.pack(frame(spark, rows), PATH, capacity).collect()
    assert sorted(str(tuple(r)[:5]) for r in got) == brute_pieces(rows, capacity)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    counts = defaultdict(int)
    for r in got:
        counts[r.length] += 1
    assert len(places) <= packing.lower_bound(counts, capacity) + 1


def test_ranking_in_parts_and_empty_table(spark, monkeypatch):
    assert packing.pack(frame(spark, []), PATH).count() == 0
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 7)
    got = packing.pack(frame(spark, [(i, "one two") for i in range(50)]), PATH, 9).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 50
    assert len({r.sequence_id for r in got}) == 17


def best_by_search(items, capacity):
    """The least number of sequences, by trying everything."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(items):
            best[0] = len(rooms)
            return
        for i in {room: i for i, room in enumerate(rooms)}.values():
            if rooms[i] >= items[k]:
                rooms[i] -= items[k]
                go(k + 1, rooms)
                rooms[i] += items[k]
        rooms.append(capacity - items[k])
        go(k + 1, rooms)
        rooms.pop()

    go(0, [])
    return best[0]


def checked(items, capacity):
    """Number of sequences that the solver needs, its fillings checked."""
    counts = defaultdict(int)
    for x in items:
        counts[x] += 1
    used = defaultdict(int)
    fillings = packing.solve(counts, capacity)
    for f in fillings:
        assert sum(f.lengths) <= capacity and f.uses > 0
        for x in f.lengths:
            used[x] += f.uses
    assert used == counts
    return sum(f.uses for f in fillings)


def test_small_problems_are_solved_exactly():
    r = random.Random(5)
    for n in range(400):
        capacity = r.choice([10, 30, 100])
        items = [r.randint(1, capacity // r.choice([1, 1, 2, 3])) for _ in range(r.randint(0, 10))]
        counts = {x: items.count(x) for x in items}
        best = best_by_search(items, capacity)
        assert packing.lower_bound(counts, capacity) <= best == checked(items, capacity), items
    assert checked([66, 61, 58, 51, 48, 43, 37, 32, 30, 28, 19, 14], 100) == 5
    greedy = packing.greedy({x: 1 for x in (66, 61, 58, 51, 48, 43, 37, 32, 30, 28, 19, 14)}, 100)
    assert sum(f.uses for f in greedy) == 6


def test_large_counts_stay_near_the_bound():
    r = random.Random(6)
    counts = {x: r.randint(1, 10**7) for x in range(1, 2049, r.randint(1, 9))}
    fillings = packing.solve(counts, 2048)
    assert sum(f.uses for f in fillings) <= 1.001 * packing.lower_bound(counts, 2048)
    assert all(sum(f.uses * f.lengths.count(x) for f in fillings) == n for x, n in counts.items())


def test_fillings_waste_least_and_are_not_dominated():
    r = random.Random(7)
    for _ in range(300):
        items = sorted((r.randint(1, 25) for _ in range(r.randint(1, 9))), reverse=True)
        counts = {x: items.count(x) for x in items}
        room = r.randint(1, 60)
        chosen = packing.complete(sorted(counts), counts, room)
        reached = {0}
        for x in items:
            reached |= {s + x for s in reached if s + x <= room}
        assert sum(chosen) == max(reached) and all(chosen.count(x) <= n for x, n in counts.items())
        for f in packing.fillings_around((26, *items), 60, 60):
            rest = list(items)
            for x in f[1:]:
                rest.remove(x)
            assert f[0] == 26 and sum(f) <= 60 and (not rest or sum(f) + min(rest) > 60)


def test_word_by_word_ids_are_the_text_s_ids():
    r = random.Random(1)
    tokenizer, encode = Tokenizer.from_file(PATH), packing._Encoder(PATH, kept=50)
    alphabet = "ÀÉßñÿ×÷ªº.,$%!abcABCD'sS t́éÉΣςİ<|> \x85\x1c　_1٣ⅷ’\n\t\x0b​ﬁ"
    parts = [*alphabet, "<|endoftext|>", "<|startoftext|>", "'ll"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(800)]
    for _ in range(2):
        for lo, hi, data, offsets in steps(pa.array(texts), 300):
            ids, first = encode(data, offsets)
            for k, text in enumerate(texts[lo:hi]):
                assert ids[first[k] : first[k + 1]].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END]
    assert len(encode.hash) < 300


def test_units_that_share_a_hash_keep_their_ids(monkeypatch):
    """With a first hash of two values only the second one tells units apart."""
    tokenizer, encode = Tokenizer.from_file(PATH), packing._Encoder(PATH)
    whole = packing.Prefixes

    class Poor(whole):
        def __init__(self, data, base=packing.OTHER_BASE - np.uint64(2), values=packing._count):
            super().__init__(data, base, values)
            self.poor = base != packing.OTHER_BASE

        def hashes(self, start, end):
            found = super().hashes(start, end)
            return found & np.uint64(1) if self.poor else found

    monkeypatch.setattr(packing, "Prefixes", Poor)
    for texts in (["one two three four"], ["two five"], ["six one, seven two", "", "one"]):
        for _, _, data, offsets in steps(pa.array(texts)):
            ids, first = encode(data, offsets)
            for k, text in enumerate(texts):
                assert ids[first[k] : first[k + 1] - 1].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
