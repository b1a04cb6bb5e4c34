"""Embedding near-duplicates by NN-descent.

Equal vectors become one. Random-projection trees give every vector a first list of neighbours, and each round brings
fresh trees, whose number follows their depth, for pairs that no neighbour leads to; then neighbours of neighbours meet: the members of a vector's list and of the lists it is in are compared with each other, and every member
keeps its best and one possible link more. Where a vector has more possible links than a list, all vectors of its
component are compared block by block, so no link of a dense group is lost; a spanning forest of every meeting that left
out possible links keeps the components whole. The recall is audited on
drawn vectors against all, each vector counting alike, once among all and once among those outside components that are
counted exactly. Rounds go on until it is high enough; if it never is, all vectors are compared block by block. Rounds use
vectors rounded to bytes; the edges that may reach the threshold are decided in double precision.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.tables import Scratch, components, groups
from shelfrank.session import materialise

LEAST = 0.9
#: Neighbours of a list, and of an enlarged one, which holds possible links only; what rounding to bytes may take from a
#: similarity.
LIST, ENLARGED = 10, 40
MARGIN = 0.03
#: Projection trees of a round at least, vectors of a tree's leaf, and vectors that are compared together in a crowded leaf.
TREES, LEAF, SLICE = 8, 32, 128
#: Rounds at least, and before all vectors are compared; vectors of an audit, and the recall that ends the rounds.
ROUNDS, MOST_ROUNDS = 2, 5
AUDITED, RECALL = 2048, 0.98
#: Vectors of a dense component that one task compares with each other.
BLOCK = 1024
SEED = 29


def usable(vector: Column) -> Column:
    """Neither null nor zero, all components there and finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column of doubles as unit vectors; scaled by the largest component first, so nothing overflows."""
    out = column.values.to_numpy()[column.offsets[0].as_py() : column.offsets[-1].as_py()].reshape(-1, size)
    out = out / np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def _codes(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(-1, size).astype(np.float32)


def _forest(near: np.ndarray, floor: float) -> np.ndarray:
    """Edges of a maximum spanning forest: above any similarity from ``floor`` on it connects what all pairs connect."""
    best, via = near[0].copy(), np.zeros(len(near), np.int64)
    free = np.arange(len(near)) > 0
    edges = []
    for _ in range(len(near) - 1):
        j = int(np.where(free, best, -2).argmax())
        if best[j] >= floor:
            edges.append((via[j], j))
        free[j] = False
        closer = near[j] > best
        best[closer], via[closer] = near[j][closer], j
    return np.array(edges, np.int64).reshape(-1, 2)


def _best(rows: np.ndarray, code: np.ndarray, most: int = LIST) -> pa.RecordBatch:
    """Neighbours of each of a few vectors among themselves, as rows ``a, b, s, tie``.

    The best ``most`` and, up to one more than ``LIST``, further possible links, so a list that is short of them shows.
    Where more are left out, the ties are the meeting's spanning forest.
    """
    # sums of whole numbers are exact, so a pair has the same similarity in every meeting
    near = code @ code.T / np.float32(127 * 127)
    np.fill_diagonal(near, -1)
    k = min(LIST + 1, len(rows) - 1)
    at = np.argpartition(-near, k - 1, axis=1)[:, :k]
    at = np.take_along_axis(at, np.argsort(-np.take_along_axis(near, at, axis=1), axis=1), axis=1)
    s = np.take_along_axis(near, at, axis=1)
    i, j = np.nonzero((s >= LEAST - MARGIN) | (np.arange(k) < most))
    a, b = i, at[i, j]
    tie = np.zeros(len(a), bool)
    if ((near >= LEAST - MARGIN).sum(axis=1) > k).any():
        forest = _forest(near, LEAST - MARGIN)
        a, b = np.append(a, forest[:, 0]), np.append(b, forest[:, 1])
        tie = np.append(tie, np.ones(len(forest), bool))
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[a]), pa.array(rows[b]), pa.array(near[a, b]), pa.array(tie)], names=["a", "b", "s", "tie"]
    )


def _depth(n: int) -> int:
    return max(0, int(np.ceil(np.log2(max(1, n) / LEAF))))


def tree_count(n: int) -> int:
    """Trees of a round, so that by the least number of rounds the share ``RECALL`` of pairs at the threshold has met: two
    vectors have the same sign of a projection with a chance of one less their angle over pi."""
    same = min(0.9, (1 - np.arccos(LEAST) / np.pi) ** _depth(n))
    return max(TREES, int(np.ceil(np.log(1 - RECALL) / np.log(1 - same) / (ROUNDS + 1))))


def _filled(leaves: Iterator[pa.Table]) -> Iterator[pa.Table]:
    """Leaves that follow each other in a tree, put together until they have ``LEAF`` vectors."""
    held: list[pa.Table] = []
    for leaf in leaves:
        if held and (sum(x.num_rows for x in held) >= LEAF or held[0]["leaf"][0].as_py() >> 48 != leaf["leaf"][0].as_py() >> 48):
            yield pa.concat_tables(held)
            held = []
        held.append(leaf)
    if held:
        yield pa.concat_tables(held)


def tree_neighbours(points: DataFrame, size: int, n: int, turn: int = 0) -> DataFrame:
    """Rows ``a, b, s, tie``: neighbours within the leaves of a round's random-projection trees over ``row_no, unit, code``.

    A leaf is a sign pattern of projections; small ones are put together, a crowded one is cut into slices along a
    further projection. The first trees give the best neighbours whatever their similarity, later ones possible links.
    """
    depth, trees, most = _depth(n), tree_count(n), 0 if turn else LIST
    normals = np.random.default_rng([SEED, size, turn]).standard_normal((trees, depth + 1, size))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(batch.column(1), size)
            for t in range(trees):
                along = unit @ normals[t].T
                leaf = ((along[:, :depth] > 0) @ (1 << np.arange(depth, dtype=np.int64))) + (t << 48)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf.astype(np.int64)), pa.array(along[:, depth]), batch.column(0), batch.column(2)],
                    names=["leaf", "along", "row_no", "code"],
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _filled(groups(batches, 1)):
            rows = table["row_no"].to_numpy()
            cuts = np.linspace(0, len(rows), -(-len(rows) // SLICE) + 1).astype(int).tolist()
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if hi - lo > 1:
                    yield _best(rows[lo:hi], _codes(table["code"][lo:hi], size), most)

    leaves = points.select("row_no", "unit", "code").mapInArrow(place, "leaf long, along double, row_no long, code binary")
    # ranges of leaf and projection, so a crowded leaf is spread over tasks
    return leaves.repartitionByRange("leaf", "along").sortWithinPartitions("leaf", "along").mapInArrow(
        meet, "a long, b long, s float, tie boolean"
    )


def best_lists(edges: DataFrame) -> DataFrame:
    """Rows ``a, b, s, tie, listed``: the best ``LIST`` neighbours of every vector, and all possible links up to
    ``ENLARGED``, are listed; ties stay beyond that, for the components, but meet no one."""
    pairs = edges.groupBy("a", "b").agg(F.max("s").alias("s"), F.max("tie").alias("tie"))
    ranked = F.reverse(F.array_sort(F.collect_list(F.struct("s", "b", "tie"))))
    lists = pairs.groupBy("a").agg(ranked.alias("near")).select("a", F.posexplode("near").alias("i", "x"))
    listed = (F.col("i") < LIST) | ((F.col("i") < ENLARGED) & (F.col("x.s") >= LEAST - MARGIN))
    return lists.select("a", "x.b", "x.s", "x.tie", listed.alias("listed")).where("listed OR tie")


def descend(lists: DataFrame, points: DataFrame, size: int, fresh: DataFrame) -> DataFrame:
    """One round: the members of every vector's list and of the lists it is in are compared with each other, and the
    possible links of fresh trees come in."""
    near = lists.where("listed")
    back = best_lists(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "s", F.lit(False).alias("tie")))
    members = (
        near.select(F.col("a").alias("v"), F.col("b").alias("u"))
        .unionByName(back.select(F.col("a").alias("v"), F.col("b").alias("u")))
        .unionByName(near.select(F.col("a").alias("v"), F.col("a").alias("u")))
        .distinct()
        .join(points.select(F.col("row_no").alias("u"), "code"), "u")
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, 1):
            if table.num_rows > 1:
                yield _best(table["u"].to_numpy(), _codes(table["code"], size))

    found = (
        members.select("v", "u", "code").repartition("v").sortWithinPartitions("v", "u").mapInArrow(
            meet, "a long, b long, s float, tie boolean"
        )
    )
    return best_lists(found.unionByName(fresh).unionByName(lists.drop("listed")))


def exact_links(lists: DataFrame, points: DataFrame, size: int, least: float = LEAST) -> DataFrame:
    """Pairs ``a < b`` of the lists whose cosine in double precision reaches the threshold."""
    pairs = (
        lists.where(F.col("s") >= least - MARGIN)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    unit = points.select("row_no", "unit")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cosine = (_unit(batch.column(2), size) * _unit(batch.column(3), size)).sum(axis=1)
                yield batch.select([0, 1]).filter(pa.array(cosine >= least))

    joined = pairs.join(unit.toDF("a", "x"), "a").join(unit.toDF("b", "y"), "b")
    return joined.select("a", "b", "x", "y").mapInArrow(decide, "a long, b long")


def _block_pairs(members: DataFrame, size: int, least: float, links: bool) -> DataFrame:
    """``row_no, n, other`` from comparing all vectors of each component ``component, row_no, copies, unit, n``: counts of
    links, weighted by copies, in parts and without other; and, if asked for, links that connect what links connect.

    A component is cut into blocks, and every pair of blocks is one matrix product; only counts and few links leave it.
    """
    slices = F.ceil(F.col("n") / BLOCK).cast("long")
    cells = (
        members.withColumn("slices", slices)
        .withColumn("own", F.pmod(F.xxhash64("row_no"), F.col("slices")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
        .select("component", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "own", "row_no", "copies", "unit")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, 3):
            table = table.combine_chunks()
            left, right = table["left"][0].as_py(), table["right"][0].as_py()
            own, rows, copies = (table[k].to_numpy() for k in ("own", "row_no", "copies"))
            unit = _unit(table["unit"].chunk(0), size)
            x, y = own == left, own == right
            near = unit[x] @ unit[y].T >= least
            if left == right:
                np.fill_diagonal(near, False)
            yield out(rows[x], near @ copies[y])
            if left != right:
                yield out(rows[y], near.T @ copies[x])
            if links:
                i, j = np.nonzero(near)
                a, b = rows[x][i], rows[y][j]
                if len(a) > 2 * len(rows):
                    ids, at = np.unique(np.append(a, b), return_inverse=True)
                    joined = np.zeros((len(ids), len(ids)), np.float32)
                    joined[at[: len(a)], at[len(a) :]] = joined[at[len(a) :], at[: len(a)]] = 1
                    a, b = ids[_forest(joined, 1)].T
                yield out(a, np.zeros(len(a), np.int64), b)

    def out(row: np.ndarray, n: np.ndarray, other: np.ndarray | None = None) -> pa.RecordBatch:
        other = pa.nulls(len(row), pa.int64()) if other is None else pa.array(other)
        return pa.RecordBatch.from_arrays([pa.array(row), pa.array(n), other], names=["row_no", "n", "other"])

    key = ["component", "left", "right"]
    return cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(count, "row_no long, n long, other long")


def block_counts(members: DataFrame, size: int, least: float = LEAST) -> DataFrame:
    """``row_no, n``: links of all vectors of dense components ``component, row_no, copies, unit, n``."""
    return _block_pairs(members, size, least, False).groupBy("row_no").agg(F.sum("n").alias("n"))


def all_pairs(points: DataFrame, size: int, n: int, least: float = LEAST) -> tuple[DataFrame, DataFrame]:
    """Links ``a, b`` that connect all components, and ``row_no, n``, by comparing all vectors: exact, quadratic."""
    members = points.select(F.lit(0).cast("long").alias("component"), "row_no", "copies", "unit", F.lit(n).cast("long").alias("n"))
    pairs = materialise(_block_pairs(members, size, least, True), "nn-pairs")
    links = pairs.where("other IS NOT NULL").select(F.col("row_no").alias("a"), F.col("other").alias("b"))
    return links, pairs.where("other IS NULL").groupBy("row_no").agg(F.sum("n").alias("n"))


def audit(
    points: DataFrame, counts: DataFrame, size: int, least: float = LEAST, sample: int = AUDITED, among: DataFrame | None = None
) -> float:
    """Share of its links that was found for a vector that has some, on average over a sample drawn from ``among`` (all
    vectors, if not given), by comparing the sample with all vectors."""
    drawn = points if among is None else among
    drawn = drawn.orderBy(F.xxhash64("row_no", F.lit(SEED)), "row_no").limit(sample).select("row_no", "unit").collect()
    if not drawn:
        return 1.0
    rows = np.array([r.row_no for r in drawn])
    queries = _unit(pa.array([r.unit for r in drawn], pa.list_(pa.float64())), size)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(rows), dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                part = batch.slice(lo, BLOCK)
                near = queries @ _unit(part.column(1), size).T >= least
                near &= rows[:, None] != part.column(0).to_numpy()[None, :]
                total += near @ part.column(2).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(total)], names=["row_no", "n"])

    # the sample's size bounds what is broadcast with the function and what comes back
    true = points.select("row_no", "unit", "copies").mapInArrow(count, "row_no long, n long")
    true = true.groupBy("row_no").agg(F.sum("n").alias("true"))
    both = true.join(counts.select("row_no", F.col("n").alias("found")), "row_no", "left")
    share = F.least("true", F.coalesce("found", F.lit(0))) / F.col("true")
    return both.where(F.col("true") > 0).agg(F.coalesce(F.avg(share), F.lit(1.0)).alias("recall")).first().recall


def _links(points: DataFrame, size: int, n: int, least: float) -> tuple[DataFrame, DataFrame]:
    """Links ``a, b`` that connect all components, and ``row_no, n`` links of every vector to others than its copies."""
    work = Scratch(points.sparkSession, "nn-rounds")
    lists = work.keep(best_lists(tree_neighbours(points, size, n)))
    for turn in range(1, MOST_ROUNDS + 1):
        lists = work.keep(descend(lists, points, size, tree_neighbours(points, size, n, turn)))
        if turn < ROUNDS:
            continue
        links = materialise(exact_links(lists, points, size, least), "nn-links")
        known = components(links, "nn")
        # more possible links than a list holds: a meeting may have left some out
        full = lists.where(F.col("s") >= least - MARGIN).groupBy("a").agg(F.count("*").alias("k")).where(F.col("k") > LIST)
        dense = known.join(full, F.col("node") == F.col("a"), "left_semi").select("component").distinct()
        dense = known.groupBy("component").agg((F.count("*")).alias("n")).join(dense, "component")
        members = known.join(dense, "component").join(points, F.col("node") == F.col("row_no"))
        counted = block_counts(members.select("component", "row_no", "copies", "unit", "n"), size, least)
        inside = known.join(dense, "component", "left_semi").select("node")
        ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        listed = (
            ends.join(inside, F.col("a") == F.col("node"), "left_anti")
            .join(points.select(F.col("row_no").alias("b"), "copies"), "b")
            .groupBy(F.col("a").alias("row_no"))
            .agg(F.sum("copies").alias("n"))
        )
        counts = materialise(counted.unionByName(listed), "nn-counts")
        outside = points.join(inside, F.col("row_no") == F.col("node"), "left_anti")
        recall = min(audit(points, counts, size, least), audit(points, counts, size, least, among=outside))
        logging.getLogger(__name__).info("recall after %d rounds: %.4f", turn, recall)
        if recall >= RECALL:
            break
    else:
        links, counts = all_pairs(points, size, n, least)
    work.drop()
    return links, counts


def near_vectors(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Vectors link when their cosine in double precision is ``least`` or more; null and zero vectors, and those with a null
    or non-finite component, link with nothing, nor do vectors of different lengths. ``component_id`` is the smallest
    vec_id reachable by links, itself included, ``n_links`` counts the other rows linked directly. Repeated rows are
    rows that link; a null vec_id is returned as such; an empty table gives an empty table; further columns are ignored.
    """
    rows = materialise(
        vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("unit")).select(
            "vec_id",
            F.monotonically_increasing_id().alias("row_no"),
            F.when(usable(F.col("unit")), F.col("unit")).alias("unit"),
        ),
        "nn-rows",
    )
    shape = rows.where("unit IS NOT NULL")
    # equal vectors are one point; its partial aggregates keep a very common vector from being one task
    points = shape.groupBy("unit").agg(F.min("row_no").alias("row_no"), F.count("*").alias("copies"))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [np.rint(_unit(batch.column(1).slice(i, 1), len(batch.column(1)[i])) * 127).astype(np.int8).tobytes() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary())], names=["row_no", "unit", "copies", "code"])

    points = materialise(
        points.select("row_no", "unit", "copies").mapInArrow(
            coded, "row_no long, unit array<double>, copies long, code binary"
        ),
        "nn-points",
    )
    links, counts = [], []
    for r in points.groupBy(F.size("unit").alias("size")).count().orderBy("size").collect():
        a, b = _links(points.where(F.size("unit") == r["size"]), r["size"], r["count"], least)
        links.append(a)
        counts.append(b)
    spark = vectors.sparkSession
    every = spark.createDataFrame([], "a long, b long")
    found = spark.createDataFrame([], "row_no long, n long")
    for a, b in zip(links, counts, strict=True):
        every, found = every.unionByName(a), found.unionByName(b)
    known = components(every, "nn-all")
    own = points.select(F.col("unit").alias("same"), F.col("row_no").alias("point"), "copies")
    placed = materialise(
        rows.join(own, F.col("unit") == F.col("same"), "left")
        .select("vec_id", "row_no", F.coalesce("point", "row_no").alias("point"), F.coalesce("copies", F.lit(1)).alias("copies"))
        .join(known, F.col("point") == F.col("node"), "left")
        .withColumn("component", F.coalesce("component", "point"))
        .join(found.toDF("of", "n"), F.col("point") == F.col("of"), "left")
        .select("vec_id", "component", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")),
        "nn-placed",
    )
    least_id = placed.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return placed.join(least_id, "component").select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
