"""The corpus pipeline: toxic documents go, then copies, then near copies; the rest is mixed and packed.

``STAGES`` lists (name, function). Each function takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is
written and read again as the next one's documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfrank.llm import exact, jaccard, mixing, packing, toxicity
from shelfrank.llm.tables import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; the grammar's weights are learnt from the labels of the documents there are."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for blanks the longest stays, then the smallest doc_id."""
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays."""
    return jaccard.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents and parts of them, as often as the sources' targets ask."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of the mixed documents in sequences of 2,048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Tokenizer, shingle sets and the learnt grammar have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; what no stage reads any more goes."""
    docs, work = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline")
    for n, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, work.keep(stage(spark, docs, sf_dir))
        if n:
            work.done(before)
    return STAGES[-1][1](spark, docs, sf_dir)
