"""Toxicity by a weighted finite-state pattern grammar.

Words are read as classes: insult, threat, target, negation, report, other. Five small transducers read a clause's
classes side by side: the insult and threat transducers mark words that put out their weight, the target transducer marks
what it raises, the negation and reported-speech transducers what they lower. They are composed into one table of states.
What bears on a word may stand behind it as well ("idiot, she said"), so the clause is also read from its end by a second
table, composed of the target, negation and report transducers: outputs stay pending until both readings have marked a word
and are settled then. Only clauses with an insult or threat can put anything out, so only those are run. A document's score
is a logistic function of what its clauses put out.

Weights of insults are learnt from labelled rows: whole words and word beginnings whose share among toxic rows is many
times that among the others. The fixed words below stand with a prior weight until the labels say otherwise.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.quality import held_out, training_rows
from shelfrank.llm.words import Prefixes, steps, stretch_hash, word_spans
from shelfrank.session import materialise

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
# Words of the classes in English, German, French and Spanish.
FIXED = {
    INSULT: "idiot idiots moron morons stupid pathetic worthless loser losers scum trash clown disgusting dumb fool "
    "idiota estúpido imbécil basura dummkopf abschaum widerlich dumm stupide crétin ordure minable",
    THREAT: "kill hurt destroy beat burn shoot stab punish töten umbringen schlagen tuer frapper brûler matar golpear quemar",
    TARGET: "you your yours he she they them him her his their du dich dir euch ihr tu te vous toi usted ustedes ti ellos",
    NEGATION: "not no never neither nor cannot isn aren wasn don doesn didn won nicht kein keine nie pas jamais aucun nunca jamás",
    REPORT: "said says say wrote writes quoted quote reported claimed called sagte sagt schrieb dit écrit dijo dice escribió",
}
#: Weight of a fixed insult and of a threat; least weight (a log of odds) and rows for a learnt one.
PRIOR = 2.0
LEAST_WEIGHT = 3.5
LEAST_ROWS = 4
LEAST_SHARE = 0.015
#: Bytes of the word beginnings that are tried.
BEGINNINGS = (3, 4, 5, 6)
#: Words that a negation or a target reaches, and those that a negation behind them reaches.
REACH = 3
REACH_BACK = 1
#: Marks of words, and factors: a target nearby, a threat without one, negation, reported speech.
OUT, NEAR, DENIED, QUOTED = 1, 2, 4, 8
TARGETED, UNTARGETED, NEGATED, REPORTED = 1.5, 0.5, 0.25, 0.5
MOST_ROWS = 12_000
THRESHOLD = 0.5

_between = np.ones(256, dtype=bool)
_between[65:91] = _between[97:123] = _between[128:] = False
_ends = np.zeros(256, dtype=np.int64)
_ends[list(b".!?;:\n")] = 1


@dataclass(frozen=True)
class Transducer:
    """States 0.., and for a state and a class the next state and the marks of the word read."""

    states: int
    step: Callable[[int, int], tuple[int, int]]


def _window(opener: int, mark: int, reach: int = REACH) -> Transducer:
    """After a word of a class, the next words within reach are marked."""

    def step(state: int, word: int) -> tuple[int, int]:
        return (reach if word == opener else max(0, state - 1)), mark if state else 0

    return Transducer(reach + 1, step)


def _latch(opener: int, mark: int) -> Transducer:
    """After a word of a class, all words of the clause are marked."""
    return Transducer(2, lambda state, word: (1 if state or word == opener else 0, mark if state else 0))


def _emit(kind: int, mark: int = OUT) -> Transducer:
    """Words of a class are marked."""
    return Transducer(1, lambda state, word: (0, mark if word == kind else 0))


def compose(parts: list[Transducer], classes: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """The product of transducers that read the same words: next states and all marks, reachable states only."""
    number = {(0,) * len(parts): 0}
    queue, nexts, marks = [(0,) * len(parts)], [], []
    for states in queue:
        row, own = [], []
        for word in range(classes):
            moved = [p.step(s, word) for p, s in zip(parts, states, strict=True)]
            to = tuple(m[0] for m in moved)
            if to not in number:
                number[to] = len(number)
                queue.append(to)
            row.append(number[to])
            own.append(functools.reduce(operator.or_, (m[1] for m in moved), 0))
        nexts.append(row)
        marks.append(own)
    return np.array(nexts), np.array(marks)


def settled(word: int, marks: int) -> float:
    """The share of its weight that a word of a class puts out, by its marks from both readings."""
    if not marks & OUT:
        return 0.0
    near = TARGETED if marks & NEAR else UNTARGETED if word == THREAT else 1.0
    return near * (NEGATED if marks & DENIED else 1.0) * (REPORTED if marks & QUOTED else 1.0)


@dataclass(frozen=True)
class Grammar:
    """Tables of the readings from the beginning and from the end, and what a class with marks puts out."""

    ahead: tuple[list[list[int]], list[list[int]]]
    back: tuple[list[list[int]], list[list[int]]]
    share: list[list[float]]

    def output(self, kinds: list[int], weights: list[float]) -> float:
        """What one clause puts out."""
        nexts, marks = self.back
        state, pending = 0, []
        for word in reversed(kinds):
            pending.append(marks[state][word])
            state = nexts[state][word]
        nexts, marks = self.ahead
        state, total = 0, 0.0
        for word, weight in zip(kinds, weights, strict=True):
            behind = pending.pop()
            if weight:
                total += weight * self.share[word][marks[state][word] | behind]
            state = nexts[state][word]
        return total


def grammar() -> Grammar:
    ahead = [_emit(INSULT), _emit(THREAT), _window(TARGET, NEAR), _window(NEGATION, DENIED), _latch(REPORT, QUOTED)]
    back = [_window(TARGET, NEAR), _window(NEGATION, DENIED, REACH_BACK), _latch(REPORT, QUOTED)]
    tables = [tuple(t.tolist() for t in compose(parts)) for parts in (ahead, back)]
    return Grammar(*tables, [[settled(word, marks) for marks in range(16)] for word in range(6)])


@dataclass
class Lexicon:
    """Hashes of known words and word beginnings (by their length in bytes) with class and weight."""

    words: dict[int, tuple[int, float]]
    beginnings: dict[int, dict[int, float]]

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
        keys = np.array(sorted(self.words), dtype=np.uint64)
        kinds = np.array([self.words[int(k)][0] for k in keys], dtype=np.int64)
        weights = np.array([self.words[int(k)][1] for k in keys])
        more = []
        for n, own in sorted(self.beginnings.items()):
            starts = np.array(sorted(own), dtype=np.uint64)
            more.append((n, starts, np.array([own[int(k)] for k in starts])))
        return keys, kinds, weights, more


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Insults from labelled texts (columns ``text, y``), counted in Spark; only the chosen units come to the driver."""
    fixed = {w: (kind, PRIOR) for kind, text in FIXED.items() for w in text.split()}
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    n = rows.agg(F.sum("y").alias("toxic"), F.count("*").alias("n")).first()
    toxic, clean = float(n.toxic or 0), float(n.n - (n.toxic or 0))
    tokens = F.array_distinct(F.split(F.translate("text", upper, upper.lower()), r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"))
    counted = materialise(
        rows.select(F.explode(tokens).alias("word"), "y")
        .groupBy("word")
        .agg(F.sum("y").alias("bad"), (F.count("*") - F.sum("y")).alias("good")),
        "toxic-words",
    )
    weight = F.log((F.col("bad") + 0.5) / (toxic + 1)) - F.log((F.col("good") + 0.5) / (clean + 1))
    least = max(LEAST_ROWS, LEAST_SHARE * toxic)
    sure = (F.col("bad") >= least) & (weight >= LEAST_WEIGHT)
    words = {
        r.word: r.weight
        for r in counted.where(sure & (F.length("word") > 1)).select("word", weight.alias("weight")).collect()
    }
    seen = counted.where(F.col("word").isin([w for w, (kind, _) in fixed.items() if kind == INSULT]))
    for r in seen.select("word", weight.alias("weight"), "good").collect():
        words.setdefault(r.word, max(0.0, min(PRIOR, r.weight)))
    raw = F.encode("word", "utf-8")
    begins = [
        counted.where((F.octet_length("word") > n) & (F.col("word") != "")).select(
            F.substring(raw, 1, n).alias("start"), F.lit(n).alias("n"), "bad", "good"
        )
        for n in BEGINNINGS
    ]
    stems = begins[0]
    for more in begins[1:]:
        stems = stems.unionByName(more)
    stems = stems.groupBy("start", "n").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    # a beginning speaks for words never seen, so it has to be surer than a word
    chosen = stems.where((F.col("bad") >= 2 * least) & (weight >= LEAST_WEIGHT + 1)).select("start", "n", weight.alias("w"))
    beginnings: dict[int, dict[bytes, float]] = {}
    for r in sorted(chosen.collect(), key=lambda r: (r.n, bytes(r.start))):
        start = bytes(r.start)
        if not any(start[:k] in beginnings.get(k, {}) for k in BEGINNINGS if k < r.n):
            beginnings.setdefault(r.n, {})[start] = min(r.w, 6.0)
    known = {stretch_hash(w): entry for w, entry in fixed.items()}
    known.update({stretch_hash(w): (INSULT, min(v, 6.0)) for w, v in words.items() if fixed.get(w, (INSULT,))[0] == INSULT})
    return Lexicon(known, {n: {_hash(b): v for b, v in own.items()} for n, own in beginnings.items()})


def _hash(data: bytes) -> int:
    array = np.frombuffer(data, np.uint8)
    return int(Prefixes(array).hashes(np.array([0]), np.array([len(array)]))[0])


def clause_evidence(column: pa.Array, lexicon: Lexicon) -> Iterator[tuple[int, float, float, int]]:
    """For every row: clauses that put anything out, the sum and the largest of their outputs, words."""
    keys, kinds, weights, beginnings = lexicon.tables()
    rules = grammar()
    for lo, hi, data, offsets in steps(column):
        if not len(data):
            yield from [(0, 0.0, 0.0, 0)] * (hi - lo)
            continue
        start, end = word_spans(data, offsets, _between)
        sums = Prefixes(data)
        hashes = sums.hashes(start, end)
        kind = np.zeros(len(start), dtype=np.int64)
        weight = np.zeros(len(start))
        for n, begin, own in beginnings:
            long = np.flatnonzero(end - start > n)
            found = sums.hashes(start[long], start[long] + n)
            at = np.minimum(np.searchsorted(begin, found), len(begin) - 1)
            hit = begin[at] == found
            kind[long[hit]] = INSULT
            weight[long[hit]] = np.maximum(weight[long[hit]], own[at[hit]])
        if len(keys):
            at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            hit = keys[at] == hashes
            kind[hit], weight[hit] = kinds[at[hit]], weights[at[hit]]
        first = np.searchsorted(start, offsets)
        out = [[0, 0.0, 0.0, int(first[i + 1] - first[i])] for i in range(hi - lo)]
        hot = np.flatnonzero((kind == INSULT) | (kind == THREAT))
        if len(hot):
            stops = np.concatenate([[0], np.cumsum(_ends[data])])
            fresh = np.zeros(len(start), dtype=bool)
            fresh[1:] = stops[start[1:]] > stops[end[:-1]]
            fresh[first[:-1][first[:-1] < len(start)]] = True
            clause = np.cumsum(fresh)
            row_of = np.searchsorted(first, hot, side="right") - 1
            ids, at = np.unique(clause[hot], return_index=True)
            begin, stop = np.searchsorted(clause, ids), np.searchsorted(clause, ids, side="right")
            for b, e, row in zip(begin.tolist(), stop.tolist(), row_of[at].tolist(), strict=True):
                total = rules.output(kind[b:e].tolist(), weight[b:e].tolist())
                if total > 0:
                    mine = out[row]
                    mine[0] += 1
                    mine[1] += total
                    mine[2] = max(mine[2], total)
        yield from (tuple(o) for o in out)


@dataclass
class Model:
    """The lexicon and the logistic function of a document's evidence."""

    lexicon: Lexicon
    weights: tuple[float, float, float]

    def scores(self, column: pa.Array) -> np.ndarray:
        found = np.array(list(clause_evidence(column, self.lexicon)), dtype=np.float64).reshape(-1, 4)
        a, b, c = self.weights
        return 1 / (1 + np.exp(-np.clip(a + b * found[:, 2] + c * np.log1p(found[:, 1]), -500, 500)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 30) -> np.ndarray:
    """Penalised logistic regression on a few columns by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += move
        if np.abs(move).max() < 1e-9:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Model:
    """Learn lexicon and logistic function from at most about ``most_rows`` labelled rows that are not held out.

    Without labelled rows, or with one class only, the fixed words and a fixed function stand.
    """
    rows = materialise(training_rows(docs, labels, "toxic", most_rows), "toxic-rows")
    lexicon = learn_lexicon(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(clause_evidence(batch.column(0), lexicon))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[2] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.float64()), batch.column(1)],
                names=["most", "total", "y"],
            )

    # three numbers a row of the bounded sample
    found = rows.select("text", "y").mapInArrow(run, "most double, total double, y double").toPandas()
    y = found["y"].to_numpy()
    if len(found) == 0 or y.min() == y.max():
        return Model(lexicon, (-2.0, 1.0, 1.0))
    x = np.column_stack([np.ones(len(found)), found["most"], np.log1p(found["total"])])
    order = np.lexsort((y, x[:, 1], x[:, 2]))
    a, b, c = _logistic(x[order], y[order])
    return Model(lexicon, (float(a), max(0.0, float(b)), max(0.0, float(c))))


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    A null or empty text has no clause, so its score is the function's at no evidence. Repeated rows are scored alike; a
    null doc_id is returned as such; an empty table gives an empty table; further columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.scores(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int"
    )


def classify(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    return score_documents(docs, fit(docs, labels, most_rows))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, with all their columns, decided in the scan."""
    model = fit(docs, labels)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column(at)) < threshold))

    return docs.mapInArrow(run, docs.schema)
