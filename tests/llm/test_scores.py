import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shelfrank.llm import quality, toxicity
from tests.llm.frames import frame, lower, odd_rows, prose


def labelled(spark, n, spoil, label):
    """Documents of which every sixth is spoilt, and their labels; a few labels are null or twice there."""
    rows, labels = [], []
    for i in range(n):
        bad = i % 6 == 0
        rows.append((i, spoil(i, prose(i, 40)) if bad else prose(i, 40)))
        labels.append((i, int(bad) if label == "toxic" else int(not bad)))
    labels += [(3, None), (None, 1), labels[1]]
    return frame(spark, rows + odd_rows()), spark.createDataFrame(labels, f"doc_id long, {label} int"), rows, dict(labels[:n])


def shout(i, text):
    return " ".join(w.upper() + "!!" for w in text.split())


def insult(i, text):
    words = text.split()
    words.insert(random.Random(i).randrange(30), ["idiot", "glorpix", "glorpan", "glorpu"][i % 4])
    return " ".join(words)


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.mark.parametrize(
    ("module", "label", "spoil"), [(quality, "quality", shout), (toxicity, "toxic", insult)], ids=["quality", "toxicity"]
)
def test_scores_tell_held_out_labels_apart(spark, module, label, spoil):
    docs, labels, rows, known = labelled(spark, 900, spoil, label)
    out = module.classify(docs, labels).collect()
    assert len(out) == 900 + len(odd_rows())
    good = total = 0
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= module.THRESHOLD)
        assert r.held_out == held("" if r.doc_id is None else r.doc_id)
    for r in out[: len(rows)]:
        if r.held_out and r.doc_id >= 30:
            good += r.predicted == known[r.doc_id]
            total += 1
    assert total > 100 and good >= 0.97 * total
    texts = {}
    for r, (_, text, *_) in zip(out[len(rows) :], odd_rows(), strict=True):
        assert texts.setdefault(text, r.score) == r.score
    assert texts[None] == texts[""]


@pytest.mark.parametrize(("module", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_empty_tables_and_no_labels(spark, module, label):
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    assert module.classify(frame(spark, []), none).count() == 0
    assert module.classify(frame(spark, odd_rows()), none).count() == len(odd_rows())


def test_held_out_labels_are_not_learnt_from(spark):
    docs, labels, _, known = labelled(spark, 200, shout, "quality")
    ids = [i for i in known if held(i)]
    turned = spark.createDataFrame([(i, 1 - v if i in ids else v) for i, v in known.items()], "doc_id long, quality int")
    a, b = (quality.fit(docs, t) for t in (labels, turned))
    assert np.array_equal(a, b)


def test_weights_are_those_of_plain_updates():
    r = np.random.default_rng(1)
    rows = [(np.unique(r.integers(0, 30, 5)).astype(np.int32),) for _ in range(200)]
    rows = [(p, np.full(len(p), 0.5, np.float32)) for (p,) in rows]
    y = np.array([float(3 in p) for p, _ in rows])
    z, n = [0.0] * 31, [1e-3] * 31

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * quality.L1) / ((quality.BETA + n[i] ** 0.5) / quality.ALPHA + quality.L2)

    for _ in range(2):
        for (p, v), label in zip(rows, y, strict=True):
            x = [*zip(p.tolist(), v.tolist(), strict=True), (30, 1.0)]
            w = {i: weight(i) for i, _ in x}
            error = 1 / (1 + np.exp(-sum(w[i] * u for i, u in x))) - label
            for i, u in x:
                g = error * u
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / quality.ALPHA * w[i]
                n[i] += g * g
    got = quality.learn(rows, y, np.zeros(31), 2)
    assert got == pytest.approx([weight(i) for i in range(31)], abs=1e-5)


def evidence(text, **more):
    known = {toxicity.stretch_hash(w): (k, toxicity.PRIOR) for k, words in toxicity.FIXED.items() for w in words.split()}
    starts = {4: {toxicity.stretch_hash("glor"): 4.0}}
    return next(iter(toxicity.clause_evidence(pa.array([text], pa.string()), toxicity.Lexicon(known, starts))))


def test_clauses_not_words_are_scored():
    plain = evidence("an idiot was there")[1]
    assert plain == toxicity.PRIOR
    assert evidence("you are an idiot")[1] > plain
    assert evidence("he is not an idiot")[1] < plain
    assert evidence("she said that it was an idiot")[1] < plain
    # the negation of one clause does not reach the next
    assert evidence("this is not right. idiot")[1] == plain
    assert evidence("You idiot, I will hurt you")[0] == 1 and evidence("You idiot. I hurt you")[0] == 2
    assert evidence("GLORpish")[1] == 4.0 and evidence("glor")[1] == 0
    assert evidence("beat the eggs")[1] < toxicity.PRIOR == evidence("they beat him")[1] / 1.5
    assert evidence(None) == (0, 0.0, 0.0, 0) and evidence("")[0] == 0


def test_what_stands_behind_a_word_counts_too():
    assert evidence("i will kill you")[1] == evidence("you i will kill")[1] == 1.5 * toxicity.PRIOR
    assert evidence("you idiot, she said")[1] == evidence("she said you idiot")[1] == 0.75 * toxicity.PRIOR
    assert evidence("du bist dumm nicht")[1] == evidence("du bist nicht dumm")[1] == 0.375 * toxicity.PRIOR
    assert evidence("idiot, are you")[1] == 1.5 * toxicity.PRIOR and evidence("kill the process")[1] == 0.5 * toxicity.PRIOR
    assert evidence("idiot. she said")[1] == toxicity.PRIOR


def plain_clause(kinds, weights):
    """What a clause puts out, by looking at all words around each."""
    total = 0.0
    for i, (kind, w) in enumerate(zip(kinds, weights, strict=True)):
        if kind not in (toxicity.INSULT, toxicity.THREAT) or not w:
            continue
        near = toxicity.TARGET in kinds[max(0, i - 3) : i] + kinds[i + 1 : i + 4]
        w *= 1.5 if near else 0.5 if kind == toxicity.THREAT else 1.0
        w *= 0.25 if toxicity.NEGATION in kinds[max(0, i - 3) : i] + kinds[i + 1 : i + 2] else 1.0
        total += w * (0.5 if toxicity.REPORT in kinds[:i] + kinds[i + 1 :] else 1.0)
    return total


def test_readings_from_both_ends_settle_clauses():
    r, rules = random.Random(2), toxicity.grammar()
    for _ in range(400):
        kinds = [r.choice([0, 0, 0, 1, 2, 3, 4, 5]) for _ in range(r.randrange(14))]
        weights = [r.choice([1.0, 2.5]) if k in (1, 2) else 0.0 for k in kinds]
        assert rules.output(kinds, weights) == pytest.approx(plain_clause(kinds, weights))
    assert len(rules.ahead[0]) <= 4 * 4 * 2


def test_composed_table_equals_transducers_side_by_side():
    parts = [toxicity._emit(1), toxicity._window(4, 4), toxicity._latch(5, 8)]
    nexts, marks = toxicity.compose(parts)
    r = random.Random(2)
    for _ in range(50):
        states, state = [0] * len(parts), 0
        for word in [r.randrange(6) for _ in range(20)]:
            moved = [p.step(s, word) for p, s in zip(parts, states, strict=True)]
            assert marks[state, word] == sum(m[1] for m in moved)
            states, state = [m[0] for m in moved], nexts[state, word]


def plain_lexicon(rows):
    """Insults from labelled rows (text, y), counted word by word."""
    bad, good = Counter(), Counter()
    for text, y in rows:
        for word in set(re.split(r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))):
            (bad if y else good)[word] += 1
    toxic, clean = sum(y for _, y in rows), sum(not y for _, y in rows)
    odds = lambda b, g: np.log((b + 0.5) / (toxic + 1)) - np.log((g + 0.5) / (clean + 1))
    least = max(toxicity.LEAST_ROWS, toxicity.LEAST_SHARE * toxic)
    fixed = {w: (k, toxicity.PRIOR) for k, text in toxicity.FIXED.items() for w in text.split()}
    words = {}
    for word in {*bad, *good}:
        if len(word) > 1 and bad[word] >= least and odds(bad[word], good[word]) >= toxicity.LEAST_WEIGHT:
            words[word] = odds(bad[word], good[word])
        elif fixed.get(word, (0,))[0] == toxicity.INSULT:
            words[word] = max(0.0, min(toxicity.PRIOR, odds(bad[word], good[word])))
    starts = {}
    for n in toxicity.BEGINNINGS:
        of = {w: w.encode()[:n] for w in {*bad, *good} if len(w.encode()) > n}
        for start in set(of.values()):
            b, g = (sum(c[w] for w, x in of.items() if x == start) for c in (bad, good))
            if b >= 2 * least and odds(b, g) >= toxicity.LEAST_WEIGHT + 1:
                if not any(start[:k] in starts.get(k, {}) for k in toxicity.BEGINNINGS if k < n):
                    starts.setdefault(n, {})[start] = min(odds(b, g), 6.0)
    known = fixed | {w: (toxicity.INSULT, min(v, 6.0)) for w, v in words.items() if fixed.get(w, (toxicity.INSULT,))[0] == toxicity.INSULT}
    return known, starts


def test_lexicon_and_evidence_are_the_plain_ones(spark):
    r = random.Random(4)
    rows = []
    for i in range(500):
        text, bad = prose(i, 25), i % 4 == 0
        if bad:
            text = insult(i, text) + r.choice([" you fool.", "! kill them", " said she", ""])
        elif i % 9 == 0:
            text += r.choice([" fool the eye", ". Not stupid at all", " ÉCOLE"])
        rows.append((text, float(bad)))
    got = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, y double"))
    known, starts = plain_lexicon(rows)
    assert {h: (k, pytest.approx(w)) for h, (k, w) in got.words.items()} == {toxicity.stretch_hash(w): v for w, v in known.items()}
    want = {n: {toxicity._hash(b): v for b, v in own.items()} for n, own in starts.items()}
    assert got.beginnings.keys() == want.keys() and all(got.beginnings[n] == pytest.approx(want[n]) for n in want)
    assert any(starts.values())
    texts = [t for t, _ in rows] + [t for _, t, *_ in odd_rows()] + ["You idiot; I hurt you: fool\nglorpix. not dumb"]
    for text, found in zip(texts, toxicity.clause_evidence(pa.array(texts, pa.string()), got), strict=True):
        outs, n = [], 0
        for clause in re.split(r"[.!?;:\n]+", text or ""):
            kinds, weights = [], []
            for word in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(clause)):
                kind, w = 0, 0.0
                for b in [v for k, own in starts.items() for s, v in own.items() if len(word.encode()) > k and word.encode()[:k] == s]:
                    kind, w = toxicity.INSULT, max(w, b)
                kind, w = known.get(word, (kind, w))
                kinds.append(kind)
                weights.append(w if kind in (toxicity.INSULT, toxicity.THREAT) else 0.0)
            n += len(kinds)
            outs += [x for x in [plain_clause(kinds, weights)] if x > 0]
        assert found == pytest.approx((len(outs), sum(outs), max(outs, default=0.0), n))


def test_toxic_rows_go_with_all_their_columns(spark):
    docs, labels, rows, known = labelled(spark, 600, insult, "toxic")
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    predicted = {r.doc_id: r.predicted for r in toxicity.classify(docs, labels).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, p in predicted.items() if not p}
