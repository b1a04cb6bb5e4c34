"""Quality classifier: logistic regression over hashed word n-grams, learnt with follow-the-regularised-leader updates.

A document is the set of its words and word pairs and the bag of its runs of word forms (capitals, digits, marks,
repeats), each hashed to one of ``2 ** BITS`` places. Shards of the labelled rows are learnt side by side and their weights averaged, twice; scoring is one sparse dot
product a document in the scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.words import mix, shingle_hashes, steps, word_forms, word_hashes
from shelfrank.session import materialise

BITS = 18
WORD_GRAMS = (1, 2)
FORM_GRAMS = (1, 2, 3)
#: Labelled rows that the model is fitted on at most (drawn by a hash of doc_id), shards, passes of a shard, and rounds
#: after each of which the shards' weights are averaged.
MOST_ROWS = 12_000
SHARDS = 4
PASSES = 2
ROUNDS = 2
#: Step size, smoothing and penalties of the updates.
ALPHA, BETA, L1, L2 = 0.5, 0.5, 0.002, 0.01
THRESHOLD = 0.3
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text divides by 5; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def features(column: pa.Array, bits: int = BITS) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """Places and values of every row's n-grams, run by run of rows; none for a row without words.

    Words and word pairs count once each, runs of one to three word forms as often as they occur; either kind has unit
    length.
    """
    for lo, hi, data, offsets in steps(column):
        words, start, end, first = word_hashes(data, offsets)
        forms = word_forms(data, start, end, words, first)
        kinds = [[], []]
        for n in WORD_GRAMS:
            kinds[0].append((words, first) if n == 1 else shingle_hashes(words, first, n))
        for n in FORM_GRAMS:
            kinds[1].append((forms, first) if n == 1 else shingle_hashes(forms, first, n))
        keys = [
            [((mix(h + np.uint64(8 * k + j)) >> np.uint64(64 - bits)).astype(np.int32), at) for j, (h, at) in enumerate(own)]
            for k, own in enumerate(kinds)
        ]
        out = []
        for i in range(hi - lo):
            seen, (form, times) = (
                np.unique(np.concatenate([k[at[i] : at[i + 1]] for k, at in own]), return_counts=k == 1)
                for k, own in enumerate(keys)
            )
            value = np.concatenate([np.full(len(seen), 1 / np.sqrt(max(1, len(seen)))), times / max(1.0, np.sqrt((times * times).sum()))])
            out.append((np.concatenate([seen, form]), value.astype(np.float32)))
        yield out


def learn(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, weights: np.ndarray, passes: int = PASSES) -> np.ndarray:
    """FTRL-proximal updates in the order given, from the given weights; the last weight is the intercept."""
    size = len(weights)
    grad2 = np.full(size, 1e-3)
    z = -weights * ((BETA + np.sqrt(grad2)) / ALPHA + L2) - np.sign(weights) * L1
    for _ in range(passes):
        for (places, values), y in zip(rows, labels, strict=True):
            at, value = np.append(places, size - 1), np.append(values, np.float32(1))
            zi, ni = z[at], grad2[at]
            w = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            g = (1.0 / (1.0 + np.exp(-float(w @ value))) - y) * value
            # += would count a place once that two kinds share; the later value stands, which is as good
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            grad2[at] = ni + g * g
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(grad2)) / ALPHA + L2))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most_rows: int = MOST_ROWS) -> DataFrame:
    """Rows ``_key, text, y`` of labelled documents that may be learnt from, at most about ``most_rows`` of them.

    Null labels and texts are left out; of repeated label rows the largest counts. The draw depends on doc_id only.
    """
    usable = (
        labels.where(F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).cast("double").alias("y"))
    )
    n = usable.count()
    key = F.xxhash64(F.col("doc_id"), F.lit(label))
    if n > most_rows:
        usable = usable.where(F.pmod(key, F.lit(1_000_000)) < int(1_000_000 * most_rows / n))
    # bounded by ``most_rows``, so the texts are found without a shuffle
    drawn = F.broadcast(usable.select(F.col("doc_id").alias("_id"), key.alias("_key"), "y"))
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    return texts.join(drawn, F.col("doc_id") == F.col("_id")).select("_key", "text", "y")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = MOST_ROWS) -> np.ndarray:
    """Weights of ``2 ** BITS`` places and the intercept. Without labelled rows all are 0, and every score is 0.5."""
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for part in features(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(part)),
                        pa.array([p.tobytes() for p, _ in part], pa.binary()),
                        pa.array([v.tobytes() for _, v in part], pa.binary()),
                        batch.column(2).slice(row, len(part)),
                    ],
                    names=["key", "places", "values", "y"],
                )
                row += len(part)

    rows = materialise(
        training_rows(docs, labels, label, most_rows).mapInArrow(places, "key long, places binary, values binary, y double"),
        f"{label}-features",
    )
    shards = rows.withColumn("shard", F.pmod("key", F.lit(SHARDS)))
    weights = np.zeros((1 << BITS) + 1)
    for _ in range(ROUNDS):
        start = docs.sparkSession.sparkContext.broadcast(weights)

        def one(own: pd.DataFrame) -> pd.DataFrame:
            own = own.sort_values(["key", "y", "places"])
            found = learn(
                [(np.frombuffer(p, np.int32), np.frombuffer(v, np.float32)) for p, v in zip(own["places"], own["values"], strict=True)],
                own["y"].to_numpy(),
                start.value.copy(),
            )
            return pd.DataFrame({"weights": [found.astype(np.float32).tobytes()], "n": [len(own)]})

        # one row of a fixed size comes back from each of a fixed number of shards
        parts = shards.groupBy("shard").applyInPandas(one, "weights binary, n long").collect()
        if not parts:
            break
        total = sum(p.n for p in parts)
        parts = sorted(parts, key=lambda p: (p.n, bytes(p.weights)))
        weights = sum(np.frombuffer(p.weights, np.float32).astype(np.float64) * (p.n / total) for p in parts)
    return weights


def score_documents(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    A null or empty text has no places, so its score is that of the intercept. Repeated rows are scored alike; a null
    doc_id is returned as such; an empty table gives an empty table; further columns are ignored.
    """
    kept = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = kept.value
        for batch in batches:
            score = [w[-1] + w[p] @ v for part in features(batch.column(2)) for p, v in part]
            score = 1.0 / (1.0 + np.exp(-np.clip(np.array(score, dtype=np.float64), -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int"
    )


def classify(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """Fit on the labelled rows that are not held out and score every document."""
    return score_documents(docs, fit(docs, labels, "quality", most_rows))
