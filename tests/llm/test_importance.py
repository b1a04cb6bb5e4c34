import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from shelfrank.llm import importance
from tests.llm.frames import OWN, frame, lower, odd_rows, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TARGET = [(1, prose(50, 80)), (2, None), (3, ""), (4, "Alpha1 beta2 ALPHA1 beta2")]


def features(text):
    words = WORD.findall(lower(text))
    return words, [*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))]


def counts(rows):
    out = Counter(zlib.crc32(f.encode()) % importance.BUCKETS for _, text, *_ in rows for f in features(text)[1])
    return out, sum(out.values())


def plainly(rows, target):
    (s, all_s), (t, all_t) = counts(rows), counts(target)
    out = []
    for doc_id, text, *_ in rows:
        words, own = features(text)
        gain = [
            math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))
            for b in (zlib.crc32(f.encode()) % importance.BUCKETS for f in own)
        ]
        weight = sum(gain) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(own), weight, score, None, len(words)])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(able[: len(able) * 25 // 100], 1):
        r[4] = k
    return sorted((tuple(r[:5]) for r in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("reach", [1, 4, 64])
def test_position_table_agrees_with_crc32(reach):
    r = random.Random(reach)
    raw = bytes(r.randrange(256) for _ in range(5000))
    spans = [(0, 1), (0, 5000), (4999, 5000)]
    for _ in range(400):
        start = r.randrange(5000)
        spans.append((start, min(5000, start + r.choice([1, 2, 3, 4, 5, 63, 64, 65, 128, 129, 1000, 3000]))))
    start, end = np.array(spans).T
    found = importance.PositionTable(reach).crc32(np.frombuffer(raw, np.uint8), start, end)
    assert [int(x) for x in found] == [zlib.crc32(raw[a:b]) for a, b in spans]
    none = np.zeros(0, np.int64)
    assert len(importance.PositionTable(reach).crc32(np.frombuffer(raw, np.uint8), none, none)) == 0


@pytest.mark.parametrize("together", [1_000_000, 7])
def test_draw_is_the_plain_one(spark, together):
    rows = [
        *odd_rows(),
        *((i, prose(i, i % 70)) for i in range(100, 400)),
        (500, "x" * 300 + " " + "ü" * 900 + " " + prose(9, 30)),
        (501, "TOKEN-42 don't stop_here " * 9),
        (502, prose(120, 50)),
        (503, prose(120, 50)),
    ]
    df = importance.draw(frame(spark, rows), frame(spark, TARGET), ranked_together=together)
    assert got(df) == plainly(rows, TARGET)
    again = importance.draw(frame(spark, rows[::-1]).repartition(5), frame(spark, TARGET))
    assert got(again) == plainly(rows, TARGET)


def test_ties_go_to_the_smaller_id_and_odd_tables_have_results(spark):
    one = prose(1, 40)
    rows = [(7, one)] * 5 + [(None, one)] * 3
    found = [r.rank for r in importance.draw(frame(spark, rows), frame(spark, TARGET), percent=100).collect()]
    assert sorted(found) == [1, 2, 3, 4, 5, 6, 7, 8]
    empty = frame(spark, rows).where("false")
    assert importance.draw(empty, frame(spark, TARGET)).count() == 0
    assert got(importance.draw(frame(spark, rows), empty)) == plainly(rows, [])
    short = [(1, "one two"), (2, None), (3, "")]
    assert got(importance.draw(frame(spark, short), frame(spark, TARGET))) == plainly(short, TARGET)


def test_drawn_documents_keep_their_columns(spark):
    rows = [(i, prose(i, 30)) for i in range(40)] + [(99, None)]
    docs = frame(spark, rows)
    kept = importance.resampled_documents(docs, frame(spark, TARGET))
    assert kept.columns == docs.columns and set(OWN) <= set(kept.columns)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in plainly(rows, TARGET) if r[4])


def test_a_document_like_the_target_gains(spark):
    rows = [(1, TARGET[0][1] + " " + prose(60, 5)), *((i, prose(1000 + i, 80)) for i in range(2, 30))]
    weight = {r.doc_id: r.weight for r in importance.score_documents(frame(spark, rows), frame(spark, TARGET)).collect()}
    assert max(weight, key=weight.get) == 1
