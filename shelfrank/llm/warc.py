"""WARC fixity: Merkle trees over the records of two replicas.

Pages become WARC response records, laid out one behind the other in segments. A leaf of a replica's tree is an ordered
range of offsets of a segment and hashes the offsets, lengths and digests of the records that start there; each further
level hashes eight neighbours below. Two replicas are compared from their roots down, level by level along the
mismatching branches only, and records are compared in the mismatching ranges alone. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.session import materialise

#: Bytes of records in a segment, bytes of a leaf's range, children of a node.
SEGMENT_BYTES = 8 << 20
RANGE_BYTES = 1 << 16
CHILDREN = 8
#: Places that a segment's ranges have in the order of all leaves; a segment that grows longer goes on in the next places,
#: where the segment number in the leaf's hash keeps it apart.
PLACES = 1 << 12


def record(page_id: Column, url: Column, body: Column) -> Column:
    """A WARC/1.1 response record as bytes; nulls are empty."""
    html = F.encode(F.coalesce(body, F.lit("")), "UTF-8")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(F.encode(head, "UTF-8"), html, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def segment_of(page_id: Column, url: Column, segments: int) -> Column:
    key = F.md5(F.concat_ws(" ", F.coalesce(page_id.cast("string"), F.lit("")), F.coalesce(url, F.lit(""))))
    return F.pmod(F.conv(F.substring(key, 1, 8), 16, 10).cast("long"), F.lit(segments))


def manifest(pages: DataFrame, replica: Column | None = None, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Rows ``page_id, segment, offset, length, sha256, copy_length, copy_sha256`` of the archive of a page table.

    Inside a segment records stand by page_id, url and digest. ``replica``, a column of bytes (null: not there), is what
    a second store holds in the place of each record, as a function of the page's columns and ``payload``; without it
    the second store is alike. Page columns that are null are empty in the record; repeated rows are records of their
    own; an empty table gives an empty table; further columns are ignored.
    """
    copy = F.col("payload") if replica is None else replica
    rows = materialise(
        pages.select("page_id", "url", record(F.col("page_id"), F.col("url"), F.col("html")).alias("payload"))
        .withColumn("copy", copy)
        .select(
            "page_id",
            "url",
            F.octet_length("payload").cast("long").alias("length"),
            F.sha2("payload", 256).alias("sha256"),
            F.octet_length("copy").cast("long").alias("copy_length"),
            F.sha2("copy", 256).alias("copy_sha256"),
        ),
        "warc-rows",
    )
    total = rows.agg(F.sum("length")).first()[0] or 0
    segments = max(1, -(-total // segment_bytes))
    order = Window.partitionBy("segment").orderBy("page_id", "url", "sha256").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("segment", segment_of(F.col("page_id"), F.col("url"), segments))
        .withColumn("offset", F.sum("length").over(order) - F.col("length"))
        .select("page_id", "segment", "offset", "length", "sha256", "copy_length", "copy_sha256")
    )


def leaves(records: DataFrame) -> DataFrame:
    """Leaf ranges ``place, hash`` of a replica's records ``segment, offset, length, sha256``."""
    entry = F.struct("segment", "offset", "length", "sha256")
    line = F.transform(F.array_sort(F.collect_list(entry)), lambda r: F.concat_ws(":", r["segment"], r["offset"], r["length"], r["sha256"]))
    return records.groupBy(place()).agg(F.sha2(F.array_join(line, ","), 256).alias("hash"))


def place() -> Column:
    """The range in which a record starts, in the order of segments and offsets."""
    return (F.col("segment") * PLACES + F.floor(F.col("offset") / RANGE_BYTES)).alias("place")


def parents(nodes: DataFrame) -> DataFrame:
    """The level above: eight neighbours' places and hashes hashed in their order."""
    line = F.transform(F.array_sort(F.collect_list(F.struct("place", "hash"))), lambda r: F.concat_ws(":", r["place"], r["hash"]))
    return nodes.groupBy(F.floor(F.col("place") / CHILDREN).alias("place")).agg(F.sha2(F.array_join(line, ","), 256).alias("hash"))


def tree(records: DataFrame, levels: int, name: str) -> list[DataFrame]:
    """All levels of a replica's tree, leaves first, each written once."""
    out = [materialise(leaves(records), f"{name}-0")]
    for k in range(1, levels):
        out.append(materialise(parents(out[-1]), f"{name}-{k}"))
    return out


def mismatches(ours: list[DataFrame], theirs: list[DataFrame]) -> DataFrame:
    """Places of the leaves that differ, found by descending from the roots along differing nodes only."""
    branch = None
    for a, b in zip(reversed(ours), reversed(theirs), strict=True):
        if branch is not None:
            above = F.floor(F.col("place") / CHILDREN)
            a = a.join(branch, above == F.col("parent"), "left_semi")
            b = b.join(branch, above == F.col("parent"), "left_semi")
        both = a.select("place", F.col("hash").alias("a")).join(b.select("place", F.col("hash").alias("b")), "place", "full")
        branch = materialise(both.where(~F.col("a").eqNullSafe(F.col("b"))).select(F.col("place").alias("parent")), "branch")
    return branch.withColumnRenamed("parent", "place")


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """One row per record of either replica: ``segment, offset, status``.

    Both have ``segment, offset, length, sha256``, one row per segment and offset. The status is ``ok``, ``altered`` (the
    place holds other bytes), ``missing`` (nothing starts there in the second replica) or ``added``. Empty replicas are
    equal; records outside mismatching ranges are not compared, their ranges' hashes have proved them.
    """
    last = [r.agg(F.max(place())).first()[0] for r in (ours, theirs)]
    levels = 1
    top = max([p for p in last if p is not None], default=0)
    while top:
        top //= CHILDREN
        levels += 1
    bad = mismatches(tree(ours, levels, "ours"), tree(theirs, levels, "theirs"))
    a = ours.select("segment", "offset", F.struct("length", "sha256").alias("a"), place())
    b = theirs.select("segment", "offset", F.struct("length", "sha256").alias("b"), place())
    sound = a.join(bad, "place", "left_anti").select("segment", "offset", F.lit("ok").alias("status"))
    status = (
        F.when(F.col("b").isNull(), "missing")
        .when(F.col("a").isNull(), "added")
        .when(F.col("a") == F.col("b"), "ok")
        .otherwise("altered")
    )
    checked = (
        a.join(bad, "place", "left_semi")
        .drop("place")
        .join(b.join(bad, "place", "left_semi").drop("place"), ["segment", "offset"], "full")
        .select("segment", "offset", status.alias("status"))
    )
    return sound.unionByName(checked)


def fixity(pages: DataFrame, replica: Column | None = None) -> DataFrame:
    """One row per page: ``page_id, segment, offset, length, sha256, status`` of its record against the second store."""
    rows = materialise(manifest(pages, replica), "manifest")
    ours = rows.select("segment", "offset", "length", "sha256")
    theirs = rows.where(F.col("copy_sha256").isNotNull()).select(
        "segment", "offset", F.col("copy_length").alias("length"), F.col("copy_sha256").alias("sha256")
    )
    return rows.drop("copy_length", "copy_sha256").join(audit(ours, theirs), ["segment", "offset"]).select(
        "page_id", "segment", "offset", "length", "sha256", "status"
    )
