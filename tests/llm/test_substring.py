import numpy as np
import pytest

from shelfrank.llm import substring
from shelfrank.llm.words import steps
from tests.llm.frames import frame, odd_rows, prose


def cuts(text):
    import pyarrow as pa

    _, _, data, offsets = next(steps(pa.array([text])))
    row, start, stop, word, word_stop = substring.cut_chunks(data, offsets)
    return [(a, b) for a, b in zip(start.tolist(), stop.tolist(), strict=True)]


def test_cuts_resist_insertions():
    text = prose(3, 400)
    raw = text.encode()
    whole = {raw[a:b] for a, b in cuts(text)}
    for at in (0, 700, 2000):
        changed = text[:at] + "inserted words here " + text[at:]
        again = {changed.encode()[a:b] for a, b in cuts(changed)}
        assert len(whole - again) <= 12
    a, b = zip(*cuts(text), strict=True)
    assert a[0] == 0 and b[-1] == len(raw) and list(a) == sorted(a)


def test_rolling_hash_is_the_plain_one():
    import pyarrow as pa

    texts = ["", "ab", prose(1, 50), "ñ é"]
    _, _, data, offsets = next(steps(pa.array(texts)))
    got = substring.gear_hashes(data, offsets)
    at = 0
    for text in texts:
        h = 0
        for byte in text.encode():
            h = ((h << 1) + int(substring._gear[byte])) & 0xFFFF
            assert got[at] == h
            at += 1


def test_places_are_packed_and_unpacked():
    import pyarrow as pa

    texts = ["", prose(1, 300), "   " + prose(2, 9), "x" * 70_000 + " " + prose(3, 40), "few words", prose(4, 2000, 1)]
    _, _, data, offsets = next(steps(pa.array(texts)))
    row, *places = substring.cut_chunks(data, offsets)
    places = [places[0] - offsets[row], places[1] - offsets[row], *places[2:]]
    cuts_ = np.searchsorted(row, np.arange(len(texts) + 1))
    packed = substring._packed(*places, cuts_).to_pylist()
    for i, raw in enumerate(packed):
        for got, want in zip(substring._unpacked(raw), places, strict=True):
            assert got.tolist() == want[row == i].tolist()


def planted(n=40):
    """Documents of their own words; every fourth holds one of two passages of 60 words, at different places."""
    passages = [prose(1000 + k, 60, 9999) for k in range(2)]
    rows = []
    for i in range(n):
        own = prose(i, 80, 9999).split()
        if i % 4 == 0:
            own[i : i] = passages[i // 4 % 2].split()
        rows.append((i, " ".join(own)))
    return rows, passages


@pytest.mark.parametrize("parts", [1, 7])
def test_passages_are_found_and_others_left_alone(spark, parts):
    rows, passages = planted()
    got = substring.repeated_passages(frame(spark, rows).repartition(parts)).collect()
    assert {r.doc_id for r in got} == {i for i, _ in rows if i % 4 == 0}
    texts = dict(rows)
    for r in got:
        piece = texts[r.doc_id].encode()[r.start : r.stop].decode()
        passage = passages[r.doc_id // 4 % 2]
        assert piece in passage and len(piece.split()) == r.n_words >= 25
        assert passage in texts[r.first_doc_id] and r.n_places == 5
    assert sum(r.kept for r in got) == 2


def test_odd_rows_and_empty_table(spark):
    assert substring.repeated_passages(frame(spark, [])).count() == 0
    rows = odd_rows()
    got = substring.repeated_passages(frame(spark, rows)).collect()
    # the base text stands in five rows, one text of id 11 in two
    assert sorted(r.doc_id for r in got if r.doc_id != 4) == [1, 2, 3, 11, 11, 12]
    assert sum(r.kept for r in got if r.doc_id == 11) == 1


def test_passages_are_cut_out(spark):
    rows, passages = planted()
    docs = frame(spark, rows)
    out = substring.remove_passages(docs, substring.repeated_passages(docs))
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    for i, text in rows:
        if i % 4 or texts[i] == text:
            assert texts[i] == text
        else:
            assert passages[i // 4 % 2] not in texts[i] and len(texts[i].split()) >= 80
    assert sum(p in t for t in texts.values() for p in passages) == 2
    assert np.mean([len(t.split()) for t in texts.values()]) < 90


def test_documents_that_share_an_id_or_have_none_are_cut_by_row(spark):
    rows, passages = planted()
    same = [(None if i % 8 == 0 else 2, "é ü " * (i % 3) + text) for i, text in rows]
    docs = frame(spark, same)
    before, after = ([r.text for r in df.collect()] for df in (docs, substring.remove_passages(docs, substring.repeated_passages(docs))))
    assert len(after) == len(before) and sum(p in t for t in after for p in passages) == 2
    assert sum(p in t for t in before for p in passages) >= 10
    # what is left of a text are words of one of the texts, in their order
    words = [set(t.split()) for t in before]
    assert all(any(set(t.split()) <= own for own in words) for t in after)


def test_every_chunk_keeps_its_first_place(spark):
    own = [prose(50 + i, 40, 9999) for i in range(9)]
    a, b, c, d = (prose(2000 + k, 60, 9999) for k in range(4))
    late = " ".join(d.split()[:40])
    rows = [
        (0, f"{own[0]} {b} {d}"),
        (1, f"{own[1]} {a} {b} {own[2]}"),
        (2, f"{a} {own[3]}"),
        (3, f"{own[4]} {b} {c} {late} {own[5]}"),
        (4, f"{own[6]} {c} {a}"),
        (5, f"{' '.join(c.split()[30:])} {own[7]}"),
        (6, f"{own[8]} {b} {c} {b} {a}"),
    ]
    docs = frame(spark, rows).coalesce(1)
    left = {r.doc_id: r.text for r in substring.remove_passages(docs, substring.repeated_passages(docs)).collect()}
    holders = {}
    for i, text in rows:
        for lo, hi in cuts(text):
            holders.setdefault(text.encode()[lo:hi].decode(), set()).add(i)
    shared = [piece for piece, where in holders.items() if len(where) > 1]
    assert len(shared) > 30 and [p for p in shared if not any(p in text for text in left.values())] == []
    assert a in left[1] and c in left[3] and b in left[0]
    assert sum(len(text.split()) for text in left.values()) < 800
    assert all(set(left[i].split()) <= set(text.split()) for i, text in rows)
