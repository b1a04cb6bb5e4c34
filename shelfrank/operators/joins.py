"""Joins of a long table with a table that has one row per key.

One key (a best-seller, a bulk buyer) may own a third of the long side, so a plain hash join
would send a third of the data to one task. Three exact forms are used:

* a measured small side is broadcast, so the long side does not move at all;
* with a wide unique side (factors, a large catalogue) the frequent keys of the long side are found
  first, and only they are salted: their rows spread over ``spread`` tasks, and only their rows of
  the unique side are repeated;
* with a thin unique side (a list of ids) adaptive execution splits what a hot key makes too large.

A salt is a hash of the row, so a re-run of a lost task gives each row the salt it had before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
MIN_SPREAD, MAX_SPREAD = 64, 1000
# Share of the long side from which a key counts as hot.
SUPPORT = 0.001


def measured_bytes(df: DataFrame) -> int:
    """In-memory size of a table of scalars and strings, from one aggregate over it."""
    fixed = 16
    strings = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            strings.append(F.coalesce(F.octet_length(f.name), F.lit(0)) + 8)
        elif isinstance(f.dataType, T.ArrayType):
            strings.append(F.greatest(F.size(f.name), F.lit(0)) * 8 + 16)
        else:
            fixed += 8
    width = F.lit(fixed)
    for s in strings:
        width = width + s
    total = df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("b")).first()
    return int(total["b"])


def frequent_keys(df: DataFrame, columns: Sequence[str], support: float = SUPPORT) -> list[list]:
    """Per column, all values on more than ``support`` of the rows, and maybe some rarer ones.

    One pass with a sketch; each list has 1 / ``support`` values at most.
    """
    found = df.select(*columns).stat.freqItems(list(columns), support).first()
    return [[v for v in values or [] if v is not None] for values in found]


def _salt(columns: Sequence[str], spread: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(spread)).cast("int")


def join_hot(
    long: DataFrame,
    unique: DataFrame,
    on: str,
    how: str,
    salt_by: Sequence[str],
    hot: Sequence,
    spread: int | None = None,
) -> DataFrame:
    """Equi-join on ``on`` with a salt for the ``hot`` keys only.

    ``how`` is inner, left, left_semi or left_anti. Any list of hot keys gives the same result.
    """
    if not hot:
        return long.join(unique, on, how)
    if spread is None:
        wanted = int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        spread = min(max(wanted, MIN_SPREAD), MAX_SPREAD)
    is_hot = F.col(on).isin(list(hot))
    every = F.sequence(F.lit(0), F.lit(spread - 1))
    salted = long.withColumn("_salt", F.when(is_hot, _salt(salt_by, spread)).otherwise(F.lit(0)))
    copies = unique.withColumn("_salt", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0)))))
    return salted.join(copies, [on, "_salt"], how).drop("_salt")


def join_listed(long: DataFrame, unique: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join with a ``unique`` side of ids and little else.

    Nothing is copied: adaptive execution broadcasts a side that turns out small, and cuts the
    partitions of the long side that a hot key makes too large.
    """
    return long.join(unique, list(on), how)


def fits_broadcast(df: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a small-side table may be broadcast, by its measured size.

    Costs a scan of ``df``: meant for stored tables, once for all joins with them.
    """
    return measured_bytes(df) <= limit_bytes


def join_unique(
    long: DataFrame,
    unique: DataFrame,
    on: str,
    how: str,
    salt_by: Sequence[str],
    small: bool | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Broadcast ``unique`` if it was measured ``small``, else join with a salt for hot keys.

    ``small`` is the result of ``fits_broadcast`` on a table that bounds ``unique``; None measures
    ``unique`` itself. ``keys_from`` is a stored table with the keys of a derived ``long``.
    """
    if small is None:
        small = fits_broadcast(unique)
    if small:
        return long.join(F.broadcast(unique), on, how)
    (hot,) = frequent_keys(long if keys_from is None else keys_from, [on])
    return join_hot(long, unique.hint("merge"), on, how, salt_by, hot)
