"""Licence scan with a positional index of rare licence words.

Templates of licence notices are cut into words with their places. Over the corpus the document frequency of every
template word is counted; the rarest words of each template, and those of its mandatory phrase, make its postings. A
file is looked up by its licence words only: a hit at place p of a word that stands at place q of a template votes for
the alignment p - q, and an alignment counts when the hit words carry enough of the template's IDF and its mandatory
phrase stands whole at the aligned place. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.session import materialise

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rare words of a template that are looked up, and the share of their IDF that an alignment must have.
RARE = 6
SHARE = 0.6

# Phrases whose places are always counted, with their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: str


# Wording of public licence notices, and the phrase that must be there.
TEMPLATES = (
    Template("mit", "released under the mit license", "mit license"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files",
        "permission is hereby granted free of charge",
    ),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template(
        "gpl-3.0",
        "this work is licensed under the gnu general public license version 3",
        "general public license version 3",
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license",
        "gnu general public license",
    ),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        "redistribution and use in source and binary forms",
    ),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "mozilla public license v 2 0",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted",
        "permission to use copy modify and or distribute this software",
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        "free and unencumbered software",
    ),
)


def lowered(text: Column) -> Column:
    """The text with A-Z, and only those, in lower case; null counts as empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())


def words(text: Column) -> Column:
    return F.filter(F.split(lowered(text), SEPARATOR), lambda w: w != "")


def _phrase_at(tokens: Column, place: Column, phrase: Sequence[str]) -> Column:
    """Whether the phrase starts at a place (from 0); false where it would pass the end."""
    found = F.lit(True)
    for k, word in enumerate(phrase):
        found = found & F.coalesce(F.get(tokens, place + k) == word, F.lit(False))
    return found


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def word_idf(split: DataFrame, vocabulary: Sequence[str], n_docs: int) -> dict[str, float]:
    """IDF over all rows of every vocabulary word; one row a word comes back."""
    seen = (
        split.select(F.explode(F.array_intersect("tokens", _strings(vocabulary))).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .withColumn("idf", F.log((F.lit(n_docs) + 1) / (F.col("n") + 1)) + 1)
        .collect()
    )
    most = split.sparkSession.range(1).select(F.log(F.lit(float(n_docs + 1))) + 1).first()[0]
    have = {r.word: r.idf for r in seen}
    return {w: have.get(w, most) for w in vocabulary}


def postings(templates: Sequence[Template], idf: dict[str, float], rare: int = RARE) -> list[tuple]:
    """Rows (template, label, word, place, weight, mandatory, weight of all, mandatory words)."""
    out = []
    for number, t in enumerate(templates):
        tokens, phrase = t.text.split(), t.phrase.split()
        first = next(i for i in range(len(tokens)) if tokens[i : i + len(phrase)] == phrase)
        must = set(range(first, first + len(phrase)))
        rarest = set(sorted(set(tokens), key=lambda w: (-idf[w], w))[:rare])
        use = [i for i, w in enumerate(tokens) if i in must or w in rarest]
        whole = sum(idf[tokens[i]] for i in use)
        out += [(number, t.label, tokens[i], i, idf[tokens[i]], int(i in must), whole, len(must)) for i in use]
    return out


def scan_licenses(
    docs: DataFrame, templates: Sequence[Template] = TEMPLATES, rare: int = RARE, share: float = SHARE
) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts all places where a base phrase stands, ``first_word`` and ``last_word`` are the smallest and
    largest start (null without any), the label lists are distinct, sorted and joined by commas (empty without any).
    ``score`` is the largest share of a template's IDF weight that a verified alignment has, at least 0.5 where a base
    phrase stands, else 0. A null text is empty; rows that repeat are answered each; a null doc_id is returned as such;
    an empty table gives an empty table; further columns are ignored.
    """
    spark = docs.sparkSession
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    split = docs.select(words(F.col("text")).alias("tokens"))
    idf = word_idf(split, vocabulary, docs.count())
    index = postings(templates, idf, rare)
    look = sorted({p[2] for p in index})
    # a template needs its mandatory phrase, so a file without the phrase's rarest word need not be looked at
    keys = sorted({_key(t, idf) for t in templates} | {p.split()[-1] for p in BASE})
    tokens = F.col("tokens")
    places = F.sequence(F.lit(0), F.size(tokens) - 1)
    starts = F.filter(
        places,
        lambda i: F.exists(
            F.array(*[_phrase_at(tokens, i, p.split()) for p in BASE]), lambda found: found
        ),
    )

    def anywhere(phrase: str) -> Column:
        return F.exists("starts", lambda i: _phrase_at(tokens, i, phrase.split()))

    labels = F.array_compact(F.array(*[F.when(anywhere(p), F.lit(label)) for p, label in BASE.items()]))
    hits = F.filter(
        F.transform(tokens, lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
        lambda h: F.array_contains(_strings(look), h["word"]),
    )
    rows = materialise(
        docs.select("doc_id", words(F.col("text")).alias("tokens"))
        .withColumn("row_no", F.monotonically_increasing_id())
        .withColumn("near", F.arrays_overlap("tokens", _strings(keys)))
        .withColumn("starts", F.when(F.col("near") & F.array_contains("tokens", "license"), starts))
        .withColumn("base", F.when(F.size("starts") > 0, labels))
        .withColumn("hits", F.when(F.col("near"), hits))
        .select("doc_id", "row_no", F.size("tokens").alias("n_words"), "starts", "base", "hits"),
        "license-rows",
    )
    table = spark.createDataFrame(
        index, "template int, label string, word string, place int, weight double, must int, whole double, musts int"
    )
    found = (
        rows.select("row_no", F.explode("hits").alias("hit"))
        .select("row_no", "hit.word", "hit.at")
        # the index holds the templates' own words: a few hundred rows whatever the corpus
        .join(F.broadcast(table), "word")
        .groupBy("row_no", "template", "label", (F.col("at") - F.col("place")).alias("shift"), "whole", "musts")
        .agg(F.sum("weight").alias("weight"), F.sum("must").alias("must"))
        .where((F.col("must") == F.col("musts")) & (F.col("weight") >= share * F.col("whole") - 1e-9))
        .groupBy(F.col("row_no").alias("found_no"))
        .agg(F.collect_set("label").alias("found"), F.max(F.least(F.lit(1.0), F.col("weight") / F.col("whole"))).alias("share"))
    )
    none = F.array().cast("array<string>")
    base = F.coalesce("base", none)
    return rows.join(found, F.col("row_no") == F.col("found_no"), "left").select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.greatest(F.coalesce(F.size("starts"), F.lit(0)), F.lit(0)).cast("long").alias("n_base"),
        F.get("starts", F.lit(0)).cast("long").alias("first_word"),
        F.element_at(F.when(F.size("starts") > 0, F.col("starts")), -1).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("found", none))), ",").alias("labels"),
        F.round(F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.size(base) > 0, 0.5).otherwise(0.0)), 6).alias("score"),
    )



def _key(template: Template, idf: dict[str, float]) -> str:
    """The mandatory word of the highest IDF."""
    return min(template.phrase.split(), key=lambda w: (-idf[w], w))
