"""Scalar expressions; all run inside the JVM but the Unicode normaliser."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def age_in_months(ts: Column, as_of: Column, days_per_month: float = 30.0) -> Column:
    """Calendar days between the event and ``as_of`` over the month length, in DOUBLE."""
    return F.datediff(as_of, ts).cast("double") / F.lit(float(days_per_month))


def decayed(base: Column, months: Column, lambda_rate: float) -> Column:
    return base * F.exp(F.lit(-float(lambda_rate)) * months)


def full_value(score: Column | str) -> Column:
    """A score to rank by: all digits but the last few, in which equal sums differ by their order."""
    return F.round(score, 12)


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def dot(u: Column, v: Column) -> Column:
    """Inner product of two float arrays, accumulated in DOUBLE."""
    products = F.zip_with(u, v, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def log2_discount(rank: Column) -> Column:
    """Gain of a hit at a 1-based rank."""
    return F.lit(1.0) / F.log2(rank.cast("double") + F.lit(1.0))


def ideal_gains(k: int) -> list[float]:
    """Best possible discounted gain for 1..k relevant items."""
    total, out = 0.0, []
    for rank in range(1, k + 1):
        total += 1.0 / math.log2(rank + 1)
        out.append(total)
    return out


def tokens(text: Column) -> Column:
    """Distinct lower-case alphanumeric words of a text."""
    words = F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " ")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two arrays without duplicates; 0 when both are empty."""
    common = F.size(F.array_intersect(a, b)).cast("double")
    union = F.size(a) + F.size(b) - common
    return F.when(union > 0, common / union).otherwise(F.lit(0.0))


def joined_line(label: str, items: Column) -> Column:
    """``label`` followed by the items, or null when there are none (``concat_ws`` skips it)."""
    return F.when(F.size(items) > 0, F.concat(F.lit(label), F.array_join(items, ", ")))


@F.pandas_udf(T.StringType())
def _nfc(text: pd.Series) -> pd.Series:
    return text.str.normalize("NFC")


def clean_text(text: Column, fallback: str = "Unknown") -> Column:
    """NFC form with white space runs as one blank; the fallback when nothing is left."""
    squeezed = F.trim(F.regexp_replace(_nfc(text), r"(?U)[\s\x1c-\x1f]+", " "))
    return F.coalesce(F.nullif(squeezed, F.lit("")), F.lit(fallback))
