"""Personal data: generators propose spans, boosted trees judge them, calibrated thresholds choose.

Emails, IP addresses, card and phone numbers. The base rules take the leftmost matches of one pattern per kind and drop
those that fail a check, so a card number behind which another number stands is lost with the whole match. Generators go
further and propose every stretch of whole groups of a number, every window of a dotted chain and bracketed forms of
addresses; proposals overlap. Gradient-boosted trees learn from the proposals that the base rules settle (their spans;
what fails a check or lies across one of their spans; and counterfeits of their spans that fail) and score the others by
format and context. Scores are calibrated on proposals of other documents, and a proposal is chosen where its calibrated
probability is high enough. The spans of the base rules always stand.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.tables import text_key

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Documents in which proposals to learn from are looked for (drawn by a hash), and proposals that are learnt from at most.
MOST_DOCS = 200_000
MOST_ROWS = 40_000
#: One document in so many is kept for calibration.
FOLDS = 4
#: Trees, their depth, the step from one to the next, bins of a feature, ridge on leaves.
TREES, DEPTH, RATE, BINS, RIDGE = 30, 4, 0.3, 32, 2.0
#: Calibrated probability from which a proposal is chosen, and proposals of a kind that calibration needs of either label.
SURE = 0.95
CALIBRATED_ON = 5
#: Hashed words of the context, and how many examples a word's odds are held back by.
PLACES = 256
PRIOR = 30

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*+")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}+")
CHAIN = re.compile(r"[0-9](?:[ -]?[0-9]){12,}+")
PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
GROUP = re.compile(r"[0-9]+")
BRACKET = re.compile(r"[\[({][aA][tT][\])}]")
BEFORE_BRACKET = re.compile(r"[A-Za-z0-9._%+-]++ ?\Z")
BEHIND_BRACKET = re.compile(r" ?[A-Za-z0-9-]++(?: ?(?:\.|[\[({][dD][oO][tT][\])}]) ?[A-Za-z0-9-]++)++")
LAST_GROUP = re.compile(r"(?:[0-9]*[ -])?\Z")
FIRST_GROUP = re.compile(r"(?:[ -][0-9]*)?")
WORD = re.compile(r"[^\W\d_]+")

# ---- proposals -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Proposal:
    """A span, whether it is the base rules', and what it stands for in learning: 1, 0, or None where they don't settle it."""

    kind: int
    start: int
    end: int
    base: bool
    label: int | None


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) << (k & 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _small(part: str) -> bool:
    """Whether a number is at most 255, however long it is written."""
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _digits(text: str) -> str:
    return "".join(GROUP.findall(text))


def _emails(text: str) -> Iterator[Proposal]:
    at, free = text.find("@"), 0
    while at >= 0:
        # the run of its characters that ends at the sign, not before the end of the last match
        lo = at
        while lo > free and text[lo - 1] in LOCAL:
            lo -= 1
        domain = DOMAIN.match(text, at + 1)
        if lo < at and domain:
            good = "." in domain[0]
            yield Proposal(EMAIL, lo, domain.end(), good, int(good))
            if good:
                free = domain.end()
        at = text.find("@", at + 1)
    for m in BRACKET.finditer(text):
        before = BEFORE_BRACKET.search(text, max(0, m.start() - 100), m.start())
        behind = BEHIND_BRACKET.match(text, m.end())
        if before and behind:
            yield Proposal(EMAIL, before.start(), behind.end(), False, None)


def _ips(text: str) -> Iterator[Proposal]:
    for m in DOTTED.finditer(text):
        parts = [(g.start(), g.end()) for g in GROUP.finditer(text, m.start(), m.end())]
        good = [_small(text[a:b]) for a, b in parts]
        valid = [all(good[k : k + 4]) for k in range(len(parts) - 3)]
        own = {k for k in range(0, len(valid), 4) if valid[k]}
        for k, right in enumerate(valid):
            crossed = any(o in own for o in range(k - 3, k + 4))
            label = 1 if k in own else 0 if crossed or not right else None
            yield Proposal(IP, parts[k][0], parts[k + 3][1], k in own, label)


def _cards(text: str) -> Iterator[Proposal]:
    for m in CHAIN.finditer(text):
        groups = [(g.start(), g.end()) for g in GROUP.finditer(text, m.start(), m.end())]
        digits = _digits(m[0])
        own = 16 <= len(digits) <= 19 and luhn(digits)
        for i in range(len(groups)):
            n = 0
            for j in range(i, len(groups)):
                n += groups[j][1] - groups[j][0]
                if n > 19:
                    break
                if n < 13:
                    continue
                whole = (i, j) == (0, len(groups) - 1)
                right = n >= 16 and luhn(_digits(text[groups[i][0] : groups[j][1]]))
                label = 1 if own and whole else 0 if whole or not right else None
                yield Proposal(CARD, groups[i][0], groups[j][1], own and whole, label)


def _phones(text: str) -> Iterator[Proposal]:
    for m in PLUS.finditer(text):
        ends, n = [], 0
        for g in GROUP.finditer(text, m.start(), m.end()):
            n += g.end() - g.start()
            if n > 15:
                break
            ends.append((n, g.end()))
        own = bool(ends) and ends[-1][1] == m.end() and ends[-1][0] >= 8
        for n, end in ends:
            if n >= 6 and end - m.start() >= 4:
                whole = end == m.end()
                label = 1 if own and whole else 0 if own or whole or n < 8 else None
                yield Proposal(PHONE, m.start(), end, own and whole, label)


def proposals(text: str) -> list[Proposal]:
    """All proposals in a text, those of the base rules among them."""
    out: list[Proposal] = []
    if "@" in text or BRACKET.search(text):
        out += _emails(text)
    out += _ips(text)
    out += _cards(text)
    if "+" in text:
        out += _phones(text)
    return out


def counterfeit(text: str, kind: int) -> str:
    """A span's text changed so that it fails its check."""
    if kind == EMAIL:
        return text.partition("@")[0] + "@" + text.rpartition(".")[2]
    if kind == IP:
        return "7" + text if len(text.split(".")[0]) > 2 else "30" + text
    if kind == CARD:
        return text[:-1] + str((int(text[-1]) + 1) % 10)
    return text[: max(4, len(text) // 2)].rstrip(" ().-")


def bracketed(text: str) -> str:
    """An address as people write it to keep it from being found."""
    local, _, domain = text.partition("@")
    return f"{local} [at] {domain.replace('.', ' [dot] ')}"


# ---- features --------------------------------------------------------------------------------

CONTEXT = 3
WIDTH = 22 + CONTEXT


def in_fours(digits: str) -> str:
    return " ".join(digits[k : k + 4] for k in range(0, len(digits), 4))


def _near(c: str) -> int:
    """Kind of the character beside a span: none, blank, mark, letter, digit."""
    if not c:
        return 0
    return 1 if c.isspace() else 3 if c.isalpha() else 4 if c.isdigit() else 2


def features(kind: int, own: str, before: str, behind: str) -> tuple[list[float], list[int]]:
    """Numbers of a span's form, and the hashed words around it: two before, one behind (0 for none)."""
    groups = GROUP.findall(own)
    digits = "".join(groups)
    local = domain = ""
    if kind == EMAIL:
        local, _, domain = own.partition("@") if "@" in own else own.partition(" ")
    labels = GROUP.sub("", domain).split(".")
    marks = {c for c in own if not c.isalnum()}
    most = max(map(len, groups), default=0)
    form = [
        kind,
        len(own),
        len(digits),
        len(groups),
        len(groups[0]) if groups else 0,
        len(groups[-1]) if groups else 0,
        most,
        min(map(len, groups), default=0),
        int(kind == CARD and luhn(digits)),
        int(digits[0]) if digits else -1,
        max((min(999, int(g[-4:])) if _small(g) else 999 for g in groups), default=0) if kind == IP else 0,
        len(marks),
        sum(c.isalpha() for c in own),
        len(local),
        len(labels) if domain else 0,
        len(labels[-1]) if domain else 0,
        int(bool(BRACKET.search(own))),
        _near(before[-1:]),
        _near(behind[:1]),
        int(own[:1] == "+"),
        int(len(LAST_GROUP.search(before)[0]) == most + 1),
        int(len(FIRST_GROUP.match(behind)[0]) == most + 1),
    ]
    ahead = WORD.findall(before[-60:].casefold())[-2:]
    after = WORD.findall(behind[:40].casefold())[:1]
    words = [*[""] * (2 - len(ahead)), *ahead, *after, *[""] * (1 - len(after))]
    return form, [zlib.crc32(w.encode()) % (PLACES - 1) + 1 if w else 0 for w in words]


def _of(text: str, p: Proposal) -> tuple[list[float], list[int]]:
    return features(p.kind, text[p.start : p.end], text[max(0, p.start - 60) : p.start], text[p.end : p.end + 40])


# ---- trees -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """For each kind its boosted trees, its context words' learnt shares, and the least score chosen."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, float]]
    odds: np.ndarray
    least: np.ndarray

    def table(self, form: np.ndarray, words: np.ndarray) -> np.ndarray:
        kind = form[:, 0].astype(np.int64)
        return np.hstack([form, self.odds[kind[:, None], words]]).astype(np.float32)

    def score(self, form: np.ndarray, words: np.ndarray) -> np.ndarray:
        x = self.table(form, words)
        out = np.zeros(len(x))
        for k, own in enumerate(self.trees):
            at = form[:, 0] == k
            out[at] = boosted(x[at], *own)
        return out


def boosted(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray, start: float) -> np.ndarray:
    out = np.full(len(x), start)
    rows = np.arange(len(x))
    for f, c, value in zip(feature, cut, leaf, strict=True):
        node = np.zeros(len(x), dtype=np.int64)
        while (node < len(f)).any():
            node = 2 * node + 1 + (x[rows, f[node]] > c[node])
        out += value[node - len(f)]
    return out


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Trees for logistic loss: each level splits every node at the bin with the largest gain of second-order steps."""
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], axis=1)
    inner = 2**depth - 1
    feature, cut, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    score = np.full(len(y), start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, wide = 2**level - 1, 2**level
            local = node - first
            gain = np.zeros(wide)
            for k, c in enumerate(cuts):
                at = local * (BINS + 1) + binned[:, k]
                sums = [np.bincount(at, weights=w, minlength=wide * (BINS + 1)).reshape(wide, -1) for w in (g, h)]
                left_g, left_h = (np.cumsum(s, axis=1) for s in sums)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                own = left_g**2 / (left_h + RIDGE) + (all_g - left_g) ** 2 / (all_h - left_h + RIDGE) - all_g**2 / (all_h + RIDGE)
                own = own[:, : len(c)]
                for n in range(wide):
                    b = int(own[n].argmax()) if len(c) else 0
                    if len(c) and own[n, b] > gain[n] + 1e-9:
                        gain[n], feature[t, first + n], cut[t, first + n] = own[n, b], k, c[b]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[t][node]] > cut[t][node])
        at = node - inner
        leaf[t] = RATE * np.bincount(at, g, minlength=inner + 1) / (np.bincount(at, h, minlength=inner + 1) + RIDGE)
        score += leaf[t][at]
    return feature, cut, leaf, start


def calibrated(score: np.ndarray, y: np.ndarray, sure: float = SURE) -> float:
    """Score from which the probability, by the best rising step function through the labels, is ``sure`` or more: half way
    between the first such step and the one before."""
    if min((y == 1).sum(), (y == 0).sum()) < CALIBRATED_ON:
        return np.inf
    order = np.lexsort((-y, score))
    blocks: list[list[float]] = []
    for s, v in zip(score[order], y[order], strict=True):
        blocks.append([v, 1, s, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            total, n, _, top = blocks.pop()
            blocks[-1] = [blocks[-1][0] + total, blocks[-1][1] + n, blocks[-1][2], top]
    # one label more of the other kind keeps a step of a few from being sure
    first = next((k for k, b in enumerate(blocks) if b[0] / (b[1] + 1) >= sure), None)
    return np.inf if first is None else (blocks[first][2] + blocks[max(0, first - 1)][3 if first else 2]) / 2


def learn(form: np.ndarray, words: np.ndarray, y: np.ndarray, fold: np.ndarray, sure: float = SURE) -> Model:
    """Shares of context words and trees from all folds but 0, thresholds from fold 0; each kind for itself."""
    odds, fit = np.zeros((len(KINDS), PLACES)), fold != 0
    kinds = [form[:, 0] == k for k in range(len(KINDS))]
    for k, own in enumerate(kinds):
        own = own & fit
        at = words[own].ravel()
        hits = np.bincount(at, weights=np.repeat(y[own], CONTEXT), minlength=PLACES)
        share = y[own].mean() if own.any() else 0.5
        odds[k] = (hits + PRIOR * share) / (np.bincount(at, minlength=PLACES) + PRIOR)
    x = Model([], odds, np.zeros(0)).table(form, words)
    none = (np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2)), 0.0)
    trees = [grow(x[own & fit], y[own & fit]) if (own & fit).any() else none for own in kinds]
    least = [
        calibrated(boosted(x[own & ~fit], *tree), y[own & ~fit], sure) if len(tree[0]) else np.inf
        for own, tree in zip(kinds, trees, strict=True)
    ]
    return Model(trees, odds, np.array(least))


# ---- corpus ----------------------------------------------------------------------------------


def _examples(text: str) -> Iterator[tuple[list[float], list[int], int]]:
    """Settled proposals of a text, a counterfeit of each span of the base rules, bracketed forms of its addresses, and its
    card numbers in groups of four, alone (a card) and as a stretch of a list of such numbers (none)."""
    for p in proposals(text):
        if p.label is None:
            continue
        yield *_of(text, p), p.label
        if p.base:
            own, before, behind = text[p.start : p.end], text[max(0, p.start - 60) : p.start], text[p.end : p.end + 40]
            yield *features(p.kind, counterfeit(own, p.kind), before, behind), 0
            if p.kind == EMAIL:
                yield *features(p.kind, bracketed(own), before, behind), 1
            if p.kind == CARD:
                fours = in_fours(_digits(own))
                yield *features(p.kind, fours, before, behind), 1
                yield *features(p.kind, fours, f"{before} {fours[-4:]} ", behind), 0
                yield *features(p.kind, fours, before, f" {fours[:4]}{behind}"), 0
                yield *features(p.kind, fours, f"{before} {fours[:4]} ", f" {fours[-4:]}{behind}"), 0


def fit(docs: DataFrame, most_docs: int = MOST_DOCS, most_rows: int = MOST_ROWS, sure: float = SURE) -> Model:
    """A model from proposals of at most about ``most_docs`` documents, drawn by a hash of id and text.

    Of kinds without enough proposals of either label nothing is chosen beside the spans of the base rules.
    """
    n = docs.count()
    key = F.xxhash64(F.col("doc_id"), text_key(F.col("text")))
    drawn = docs.select(key.alias("key"), "text").where(F.col("text").isNotNull())
    if n > most_docs:
        drawn = drawn.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < int(1_000_000 * most_docs / n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows, words, labels = [], [], [], []
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for form, context, label in _examples(text):
                    keys.append(own)
                    rows.append(np.array(form, np.float32).tobytes())
                    words.append(np.array(context, np.int32).tobytes())
                    labels.append(label)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(rows, pa.binary()), pa.array(words, pa.binary()), pa.array(labels, pa.int32())],
                names=["key", "form", "words", "label"],
            )

    found = drawn.mapInArrow(run, "key long, form binary, words binary, label int")
    # bounded by ``most_rows``; equal examples count as often as they occur
    rows = found.orderBy(F.xxhash64("key", "form", "words"), "key", "form", "words", "label").limit(most_rows).collect()
    form = np.frombuffer(b"".join(r.form for r in rows), np.float32).reshape(len(rows), WIDTH - CONTEXT)
    words = np.frombuffer(b"".join(r.words for r in rows), np.int32).reshape(len(rows), CONTEXT)
    y = np.array([r.label for r in rows], dtype=np.float64)
    fold = np.array([zlib.crc32(str(r.key).encode()) % FOLDS for r in rows], dtype=np.int64)
    return learn(form, words, y, fold, sure)


def chosen(texts: list[str], model: Model) -> list[list[tuple[int, int, int, bool, float]]]:
    """Spans (kind, start, end, base, score) of each text, by kind and start.

    The base rules' spans stand. Of the other proposals above their kind's threshold the best are taken first, and none
    that shares a character with a span that stands.
    """
    found = [proposals(t) for t in texts]
    open_ = [(i, p) for i, own in enumerate(found) for p in own if p.label is None]
    out = [[(p.kind, p.start, p.end, True, 1.0) for p in own if p.base] for own in found]
    if open_:
        made = [_of(texts[i], p) for i, p in open_]
        score = model.score(np.array([f for f, _ in made], np.float32), np.array([w for _, w in made]))
        for s, (i, p) in sorted(zip(score, open_, strict=True), key=lambda x: (-x[0], x[1][0], x[1][1].start, -x[1][1].end)):
            if s >= model.least[p.kind] and all(p.end <= a or b <= p.start for _, a, b, _, _ in out[i]):
                out[i].append((p.kind, p.start, p.end, False, float(1 / (1 + np.exp(-s)))))
    return [sorted(own) for own in out]


SPANS = "array<struct<kind:string,start:long,end:long,base:boolean,score:double>>"
_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())])
)


def find_spans(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, spans`` (kind, start, end, base, score; code points, end exclusive).

    A null or empty text has no spans. Repeated rows have a result each, alike; a null doc_id is returned as such; an empty
    table gives an empty table; further columns are ignored.
    """
    kept = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                spans = [
                    [{"kind": KINDS[k], "start": a, "end": b, "base": base, "score": s} for k, a, b, base, s in own]
                    for own in chosen([t or "" for t in part.column(1).to_pylist()], kept.value)
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, _SPANS)], names=["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, spans {SPANS}")


def redacted(text: str, spans: list[tuple[int, int, int, bool, float]]) -> str:
    """The text with every stretch that spans cover replaced by the kind of its first span, in angle brackets."""
    out, at, lo = [], 0, None
    for kind, start, end, *_ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if lo is None or start >= at:
            out += [text[at if lo is not None else 0 : start], f"<{KINDS[kind]}>"]
            lo = start
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with all columns, their personal data replaced in ``text``; a null text stays null."""
    kept = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            spans = chosen([t or "" for t in texts], kept.value)
            new = [t if t is None else redacted(t, own) for t, own in zip(texts, spans, strict=True)]
            columns = [pa.array(new, batch.schema.field(k).type) if k == place else c for k, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    """``doc_id``, numbers of base spans by kind, ``base_sha256`` of their list, and ``spans``, the list of all."""
    base = F.filter("spans", lambda s: s["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(number, KINDS), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))
