import hashlib
import random
import re

import numpy as np
import pytest

from shelfrank.llm import pii
from tests.llm.frames import OWN, frame, odd_rows, prose


def plain_base(text):
    """The base rules as they are stated: one pattern a kind, matches that fail dropped."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append(("ip", m))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits(m[0])))]
        if 16 <= len(twice) <= 19 and sum(v // 10 + v % 10 for v in twice) % 10 == 0:
            found.append(("card", m))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(digits(m[0])) <= 15:
            found.append(("phone", m))
    return [f"{k}:{m.start()}:{m.end()}" for k, m in found]


def card(r, n=16):
    head = "".join(str(r.randrange(10)) for _ in range(n - 1))
    return next(head + c for c in "0123456789" if pii.luhn(head + c))


def personal_rows(n):
    r = random.Random(n)
    out = []
    for i in range(n):
        parts = re.sub('[0-9]', '', prose(i, 40)).split()
        for own in (
            f"{r.choice('abc')}x.{r.randrange(99)}@mail{r.randrange(9)}.example.com",
            ".".join(str(r.randrange(256)) for _ in range(4)),
            card(r),
            f"+1 ({r.randrange(100, 999)}) 555-{r.randrange(1000, 9999)}",
            str(10**15 + r.randrange(10**15)),
            f"{r.randrange(256, 999)}.1.2.3",
        ):
            if r.random() < 0.7:
                parts.insert(r.randrange(len(parts)), own + r.choice(["", ",", ".", " and"]))
        out.append((1000 + i, " ".join(parts)))
    return out


ODD = [
    (1, "a@b.c@d.e.f x@y z@ @q.r é.ñ@host.example.org. a+b%c_d@x-y.z-"),
    (2, "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 001.002.0003.255 9.9.9.9.300.1 " + "1." * 5000),
    (3, "4111 1111 1111 1111 4111-1111-1111-1112 " + "4" * 5000 + " 12 " * 300),
    (4, "+1 (555) 123-4567 + 1 +12 +1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6 +49 30 1234567)( +1" + " " * 3000),
    (5, "+" * 500 + "1" + "@" * 500 + "." * 500),
    (6, "[at] (at) x[at]y z (at) host (dot) org"),
    (7, "x" * 20000 + "@" + "y" * 20000 + ".org"),
]


def test_base_spans_are_those_of_the_rules():
    r = random.Random(3)
    letters = ["0123456789" * 3 + "..@@+ -()aZ_é%", "0123456789 -.", "a1.@-é", "+1 ()-.2"]
    for n in range(8000):
        text = "".join(r.choice(letters[n % 4]) for _ in range(r.randrange(70)))
        found = sorted((p.kind, p.start, p.end) for p in pii.proposals(text) if p.base)
        assert [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in found] == plain_base(text)


def test_counterfeits_fail_and_labels_are_settled_by_the_rules():
    for _, text in personal_rows(60):
        for p in pii.proposals(text):
            own = text[p.start : p.end]
            assert (p.label == 1) == p.base
            if p.base:
                assert plain_base(own) == [f"{pii.KINDS[p.kind]}:0:{len(own)}"]
                assert not plain_base(pii.counterfeit(own, p.kind)), own


def test_trees_learn_what_no_single_cut_tells():
    r = np.random.default_rng(1)
    x = r.random((3000, 4)).astype(np.float32)
    y = ((x[:, 1] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    fitted = pii.grow(x[:2000], y[:2000])
    assert (((pii.boosted(x[2000:], *fitted) > 0) == (y[2000:] == 1)).mean()) > 0.95
    constant = pii.grow(np.ones((5, 2), np.float32), np.ones(5))
    assert (pii.boosted(np.ones((2, 2), np.float32), *constant) > 0).all()


def test_calibrated_threshold_has_the_precision_asked_for():
    r = np.random.default_rng(2)
    score = r.normal(size=4000)
    y = (r.random(4000) < 1 / (1 + np.exp(-3 * score))).astype(float)
    least = pii.calibrated(score, y, 0.9)
    assert 0.3 < least < 1.3 and y[score >= least].mean() > 0.9
    assert pii.calibrated(score, np.ones(4000)) == np.inf and pii.calibrated(score[:0], y[:0]) == np.inf
    assert pii.calibrated(np.zeros(40), np.r_[np.ones(20), np.zeros(20)]) == np.inf


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(frame(spark, personal_rows(600)))


def test_spans_of_all_rows(spark, model):
    rows = [*odd_rows(), *ODD, *personal_rows(80), *ODD[:2]]
    found = pii.digests(pii.find_spans(frame(spark, rows), model)).collect()
    assert len(found) == len(rows)
    have = sorted(((r.doc_id, *r[1:]) for r in found), key=str)
    want = []
    for doc_id, text, *_ in rows:
        text = text or ""
        own = plain_base(text)
        every = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b, _, _ in pii.chosen([text], model)[0]]
        assert set(own) <= set(every)
        counts = [sum(s.startswith(k) for s in own) for k in pii.KINDS]
        want.append((doc_id, *counts, hashlib.sha256(",".join(own).encode()).hexdigest(), ",".join(every)))
    assert have == sorted(want, key=str)


def test_numbers_that_the_rules_lose_with_their_neighbours_are_found(model):
    r = random.Random(8)
    number = card(r)
    cases = {
        f"zeta beta {number} 27.65.93.188 mu": [f"card:10:{10 + len(number)}", "ip:27:39"],
        f"mu +1 (578) 555-6437 {number} tau": ["phone:3:20", f"card:21:{21 + len(number)}"],
        "write to jane.doe [at] example [dot] com now": ["email:9:40"],
    }
    for text, want in cases.items():
        own = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b, _, _ in pii.chosen([text], model)[0]]
        assert sorted(own) == sorted(want), text
    clean = ["in 2001 2002 2003 2004 2005 2006 and 2007", "version 1.2.3 of 10.4", "see you at noon", "12 34 56 78 90 12 34 56 78 90"]
    assert pii.chosen(clean, model) == [[]] * len(clean)


def test_redacted_documents_keep_their_columns(spark, model):
    rows = [(1, "ü a.b@c.de, +1 (578) 555-6437 or 1.2.3.4"), (2, None), (3, ""), (None, "nothing here")]
    docs = frame(spark, rows)
    out = pii.redact(docs, model)
    assert out.schema == docs.schema and set(OWN) <= set(out.columns)
    assert {r.doc_id: r.text for r in out.collect()} == {1: "ü <email>, <phone> or <ip>", 2: None, 3: "", None: "nothing here"}


def test_tables_without_examples(spark):
    empty = frame(spark, []).where("false")
    none = pii.fit(empty)
    assert pii.find_spans(empty, none).count() == 0
    few = frame(spark, [(1, "mail a@b.co"), (2, None)])
    found = {r.doc_id: r for r in pii.digests(pii.find_spans(few, pii.fit(few))).collect()}
    assert found[1].spans == "email:5:11" and found[2].spans == "" and found[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.chosen([f"+1 (578) 555-6437 {card(random.Random(1))}"], none) == [[]]


def test_model_follows_from_the_rows_alone(spark, model):
    rows = personal_rows(600)
    again = pii.fit(frame(spark, rows[::-1]).repartition(7))
    same = lambda a, b: all(np.array_equal(p, q) for x, y in zip(a.trees, b.trees, strict=True) for p, q in zip(x, y, strict=True))
    assert same(again, model) and np.array_equal(again.least, model.least)
    drawn = pii.fit(frame(spark, rows), most_docs=300, most_rows=500)
    assert not same(drawn, model)
