"""N-gram Jaccard join with signature trees.

Every text is the set of its word shingles. Sets that are equal become one. Two sets that are similar enough share one of
their first shingles in an order that all sets agree on (shingles found to be frequent come last), so the sets that have
a shingle among their first form a block and no similar pair is outside all blocks. Inside a block the sets are the leaves
of a tree whose nodes hold the OR of their token bitmaps and the range of their sizes; two nodes are descended into
together only if the largest overlap that bitmaps and sizes allow is enough. Pairs that are left are counted exactly.

First every set is compared with the first set of its blocks. That ties most copies of a text together, and the trees are
then asked only for pairs across groups, so large groups are not expanded into pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.llm.tables import Scratch, components, groups, keep_rows, small, text_key
from shelfrank.llm.words import mix, shingle_hashes, steps, word_hashes
from shelfrank.session import materialise

WORDS = 5
#: Similarity, as a fraction, from which two sets link.
LEAST = (3, 4)
#: Least bits of a signature, and children of a node. Signatures have two bits an element or more, so that those of large
#: sets do not fill up.
BITS = 1024
FANOUT = 8
#: Bytes of signatures that one step of a descent compares; a step holds several arrays of that size.
STEP = 4 << 20
#: Bytes of text whose shingles are taken in one step; arrays of it are some sixty times as large.
TEXT_STEP = 1 << 18
#: Shingles that are put last in the common order: at most so many, from lists of so many that tasks give for every run
#: of so many shingles. Any list is right; a good one keeps frequent shingles from making blocks.
FREQUENT = 65_536
LISTED = 4096
RUN = 2_000_000
#: Sets of a block that one task compares with each other; larger blocks are cut into slices that meet pairwise.
SLICE = 1024
#: Elements that the sets of one part of a region have together; larger regions are cut into parts that meet pairwise.
ELEMENTS = 1 << 20
#: Pairs that the trees of a cell leave until their whole sets are compared.
PAIRS = 1 << 20


def _unique(column: pa.Array, size: int = WORDS) -> Iterator[list[np.ndarray]]:
    """Sorted distinct shingles of every row, run by run of rows."""
    for lo, hi, data, offsets in steps(column, TEXT_STEP):
        words, _, _, first = word_hashes(data, offsets)
        runs, at = shingle_hashes(words, first, size)
        yield [np.unique(runs[at[i] : at[i + 1]]) for i in range(hi - lo)]


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles that many rows have, sorted by their number: a bounded list, summed up from bounded lists of the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def listed(parts: list[np.ndarray]) -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(parts), return_counts=True)
            often = np.flatnonzero(n >= 3)
            often = often[np.lexsort((found[often], -n[often]))][:LISTED]
            return pa.RecordBatch.from_arrays(
                [pa.array(found[often].view(np.int64)), pa.array(n[often].astype(np.int64))], names=["token", "n"]
            )

        held, many = [], 0
        for batch in batches:
            for part in _unique(batch.column(0)):
                held += part
                many += sum(map(len, part))
                if many >= RUN:
                    yield listed(held)
                    held, many = [], 0
        if held:
            yield listed(held)

    counted = docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = counted.orderBy(F.desc("n"), "token").limit(FREQUENT).collect()
    return np.array([r.token for r in reversed(rows)], dtype=np.int64).view(np.uint64)


def first_shingles(n: int) -> int:
    """Shingles of a set of n, one of which any similar set has among its own first ones."""
    return n - -(-LEAST[0] * n // LEAST[1]) + 1


def width(n: int) -> int:
    """Bits of the signature of a set of n: a power of two, ``BITS`` at least."""
    return max(BITS, 1 << (2 * n - 1).bit_length())


def signature(tokens: np.ndarray, bits: int = BITS) -> bytes:
    """A bit for every element; the widths are powers of two, so halves laid over each other are the narrower one."""
    marks = np.zeros(bits, dtype=bool)
    marks[(mix(tokens) & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(marks).tobytes()


def folded(raw: bytes, bits: int) -> np.ndarray:
    """A signature narrowed to so many bits."""
    return np.bitwise_or.reduce(np.frombuffer(raw, np.uint64).reshape(-1, bits // 64), axis=0)


def set_table(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Rows ``row_no, doc_id, text_key, n, digest, rare, often, bits``: a row's set, its first shingles, its signature."""
    order = np.argsort(frequent)
    kept = docs.sparkSession.sparkContext.broadcast((frequent[order], order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, rank = kept.value
        for batch in batches:
            row = 0
            for part in _unique(batch.column(3)):
                size, digest, rare, often, bits = [], [], [], [], []
                for tokens in part:
                    first = first_shingles(len(tokens)) if len(tokens) else 0
                    a = b = tokens[:0]
                    if first:
                        a = tokens
                        if len(hot):
                            at = np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)
                            is_hot = hot[at] == tokens
                            a = tokens[~is_hot]
                            b = tokens[is_hot][np.argsort(rank[at[is_hot]])][: max(0, first - len(a))]
                        a = a[:first]
                    size.append(len(tokens))
                    digest.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                    rare.append(a.view(np.int64))
                    often.append(b.view(np.int64))
                    bits.append(signature(tokens, width(len(tokens))))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).slice(row, len(part)) for k in range(3)),
                        pa.array(size, pa.int64()),
                        pa.array(digest, pa.binary()),
                        pa.array(rare, pa.list_(pa.int64())),
                        pa.array(often, pa.list_(pa.int64())),
                        pa.array(bits, pa.binary()),
                    ],
                    names=["row_no", "doc_id", "text_key", "n", "digest", "rare", "often", "bits"],
                )
                row += len(part)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(
        F.monotonically_increasing_id().alias("row_no"), "doc_id", text_key(F.col("text")).alias("text_key"), "text"
    ).mapInArrow(
        run,
        f"row_no long, doc_id {kind}, text_key long, n long, digest binary, rare array<long>, often array<long>, "
        "bits binary",
    )


def _enough(overlap: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether an overlap makes two sets similar, given the sum of their sizes: overlap / (sizes - overlap) >= LEAST."""
    return LEAST[1] * overlap >= LEAST[0] * (sizes - overlap)


def overlap_bound(bits_a: np.ndarray, n_a: np.ndarray, bits_b: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The most elements two sets can share: a bit that only one has is an element that the other lacks."""
    only_a = np.bitwise_count(bits_a & ~bits_b).sum(axis=-1, dtype=np.int64)
    only_b = np.bitwise_count(bits_b & ~bits_a).sum(axis=-1, dtype=np.int64)
    return np.minimum(n_a - only_a, n_b - only_b)


class SignatureTree:
    """Sets of a block in order of size, and above them nodes of eight with the OR of their bitmaps and their sizes."""

    def __init__(self, bits: np.ndarray, n: np.ndarray, group: np.ndarray):
        self.order = np.lexsort((group, n))
        bits, n, group = bits[self.order], n[self.order], group[self.order]
        # what the bitmap hides of a set: elements beyond its bits
        extra = n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(bits, n, n, extra, group, group)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, extra, first, last = self.levels[-1]
            cut = np.arange(0, len(bits), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, cut),
                    np.minimum.reduceat(low, cut),
                    np.maximum.reduceat(high, cut),
                    np.maximum.reduceat(extra, cut),
                    np.minimum.reduceat(first, cut),
                    np.maximum.reduceat(last, cut),
                )
            )

    def may_match(self, level: int, a: np.ndarray, other: SignatureTree, b: np.ndarray) -> np.ndarray:
        """Pairs of nodes below which two sets of different groups may be similar enough."""
        x, low_x, high_x, extra_x, first_x, last_x = (v[a] for v in self.levels[level])
        y, low_y, high_y, extra_y, first_y, last_y = (v[b] for v in other.levels[level])
        good = (LEAST[1] * high_x >= LEAST[0] * low_y) & (LEAST[1] * high_y >= LEAST[0] * low_x)
        good &= ~((first_x == last_x) & (first_y == last_y) & (first_x == first_y))
        if level == 0:
            most = overlap_bound(x, low_x, y, low_y)
        else:
            # an element of both lies in a bit of both unions, or is one that its own bitmap hides
            common = np.bitwise_count(x & y).sum(axis=1, dtype=np.int64)
            most = np.minimum(common + np.minimum(extra_x, extra_y), np.minimum(high_x, high_y))
        return good & _enough(most, np.maximum(low_x + low_y, 0))

    def pairs(self, other: SignatureTree | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of the pairs that are left after both trees have been descended together; within one tree once each."""
        step = max(64, STEP // (8 * self.levels[0][0].shape[1]))
        alone = other is None
        other = self if alone else other
        top = max(len(self.levels), len(other.levels)) - 1
        for tree in (self, other):
            while len(tree.levels) <= top:
                tree.levels.append(tree.levels[-1])
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, a, b = stack.pop()
            good = self.may_match(level, a, other, b)
            a, b = a[good], b[good]
            if not len(a):
                continue
            if level == 0:
                yield self.order[a], other.order[b]
                continue
            lo, n_lo = self._children(level, a)
            hi, n_hi = other._children(level, b)
            number = n_lo * n_hi
            at = np.repeat(np.arange(len(a)), number)
            k = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
            child_a, child_b = lo[at] + k // n_hi[at], hi[at] + k % n_hi[at]
            if alone:
                keep = child_a < child_b if level == 1 else child_a <= child_b
                child_a, child_b = child_a[keep], child_b[keep]
            stack += [(level - 1, child_a[i : i + step], child_b[i : i + step]) for i in range(0, len(child_a), step)]

    def bound(self, a: np.ndarray, other: SignatureTree, b: np.ndarray) -> np.ndarray:
        """The most elements that the sets at places ``a`` share with those of the other tree at places ``b``."""
        rank_a, rank_b = (np.empty_like(t.order) for t in (self, other))
        rank_a[self.order], rank_b[other.order] = np.arange(len(self.order)), np.arange(len(other.order))
        (x, n_x, *_), (y, n_y, *_) = self.levels[0], other.levels[0]
        step = max(64, STEP // (8 * x.shape[1]))
        parts = [
            overlap_bound(x[i], n_x[i], y[j], n_y[j])
            for i, j in ((rank_a[a[k : k + step]], rank_b[b[k : k + step]]) for k in range(0, len(a), step))
        ]
        return np.concatenate([*parts, np.zeros(0, np.int64)])

    def _children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        below = len(self.levels[level - 1][0])
        if below == len(self.levels[level][0]):
            return nodes, np.ones(len(nodes), dtype=np.int64)
        return nodes * FANOUT, np.minimum(below - nodes * FANOUT, FANOUT)


def size_class(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each size, and the least size of every class. Similar sets are of one class or of neighbouring ones."""
    starts = [1]
    while starts[-1] <= n.max(initial=1):
        starts.append(LEAST[1] * starts[-1] // LEAST[0] + 1)
    least = np.array(starts, dtype=np.int64)
    return np.searchsorted(least, n, side="right") - 1, least


def _narrowed(bits: list[bytes], at: np.ndarray, width_: int) -> np.ndarray:
    return np.stack([folded(bits[k], width_) for k in at])


def block_pairs(
    bits: list[bytes], n: np.ndarray, group: np.ndarray, side: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of the pairs of a block that its trees leave, and the most elements they can share; with ``side`` (0 or 1 per
    row) only pairs of unlike sides.

    One tree stands for a class of sizes, at the width of its smallest set, and is descended with itself and with that of
    the next class, so signatures are as wide as the sets they stand for and long sets do not fill them.
    """
    kind, least = size_class(n)
    for c in np.unique(kind):
        bits_c = width(int(least[c]))
        trees = {}

        def tree(k: int, s: int | None) -> tuple[SignatureTree, np.ndarray] | None:
            if (k, s) not in trees:
                at = np.flatnonzero((kind == k) if s is None else (kind == k) & (side == s))
                trees[k, s] = (SignatureTree(_narrowed(bits, at, bits_c), n[at], group[at]), at) if len(at) else None
            return trees[k, s]

        if side is None:
            meets = [((c, None), (c, None)), ((c, None), (c + 1, None))]
        else:
            meets = [((c, 0), (c, 1)), ((c, 0), (c + 1, 1)), ((c + 1, 0), (c, 1))]
        for x, y in meets:
            one, other = tree(*x), tree(*y)
            if one is None or other is None:
                continue
            for i, j in one[0].pairs(None if x == y else other[0]):
                yield one[1][i], other[1][j], one[0].bound(i, other[0], j)


def forest(pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs of a block those that tie its groups together, the likeliest first: fewer than it has groups."""
    a, b, most = (np.concatenate(x) for x in zip(*pairs, strict=True))
    order = np.lexsort((b, a, -most / (n[a] + n[b] - most)))
    names, own = np.unique(group, return_inverse=True)
    above, left, kept = list(range(len(names))), len(names) - 1, []

    def top(k: int) -> int:
        while above[k] != k:
            above[k] = above[above[k]]
            k = above[k]
        return k

    for k, x, y in zip(order.tolist(), own[a[order]].tolist(), own[b[order]].tolist(), strict=True):
        x, y = top(x), top(y)
        if x != y:
            above[x] = y
            kept.append(k)
            left -= 1
            if not left:
                break
    return a[kept], b[kept]


def tree_pairs(members: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that tie the groups together between which the trees leave pairs, of block members ``token, row_no,
    component, n, bits, n_rows``.

    A block larger than a slice is cut into slices by a hash of the row; each pair of slices meets in a task of its own, and
    hands on fewer pairs than it has groups, the likeliest ones.
    """
    slices = F.ceil(F.col("n_rows") / SLICE).cast("long")
    own = F.pmod(F.xxhash64("row_no"), F.col("slices"))
    cells = (
        members.withColumn("slices", slices)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
        .select(
            "token",
            F.least("own", "other").alias("left"),
            F.greatest("own", "other").alias("right"),
            "own",
            "row_no",
            "component",
            "n",
            "bits",
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, 3):
            if table.num_rows < 2:
                continue
            left, right = table["left"][0].as_py(), table["right"][0].as_py()
            own, rows, group, n = (table[k].to_numpy() for k in ("own", "row_no", "component", "n"))
            side = None if left == right else (own == right).astype(np.int8)
            found = list(block_pairs(table["bits"].to_pylist(), n, group, side))
            if found:
                yield _row_pairs(rows, *forest(found, n, group))

    key = ["token", "left", "right"]
    return cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a long, b long").distinct()


def _row_pairs(rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    a, b = rows[i], rows[j]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


class WholeSets:
    """Whole sets numbered among themselves: an element that two of them have is a bit, so overlaps of pairs are exact."""

    def __init__(self, sets: list[np.ndarray]):
        size = [len(s) for s in sets]
        _, name, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = often > 1
        kept = shared[name]
        self.row = np.repeat(np.arange(len(sets)), size)[kept]
        self.bit = (np.cumsum(shared) - 1)[name[kept]]
        order = np.argsort(self.bit, kind="stable")
        self.row, self.bit = self.row[order], self.bit[order]
        self.rows, self.bits = len(sets), int(shared.sum())
        #: Bits that are looked at together, and their bitmaps, which one slab after the other fills.
        self.slab = 64 * max(1, STEP // (8 * self.rows))

    def _slab(self, first: int) -> np.ndarray:
        last = min(first + self.slab, self.bits)
        lo, hi = np.searchsorted(self.bit, [first, last])
        marks = np.zeros((self.rows, -(-(last - first) // 64)), np.uint64)
        at = self.bit[lo:hi] - first
        np.add.at(marks, (self.row[lo:hi], at // 64), np.uint64(1) << (at % 64).astype(np.uint64))
        return marks

    def similar(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the sets at places ``i`` are similar to those at places ``j``."""
        both = np.zeros(len(i), np.int64)
        for first in range(0, self.bits, self.slab):
            marks = self._slab(first)
            step = max(64, STEP // (8 * marks.shape[1]))
            for k in range(0, len(i), step):
                one = marks[i[k : k + step]]
                one &= marks[j[k : k + step]]
                both[k : k + step] += np.bitwise_count(one).sum(axis=1, dtype=np.int64)
        return _enough(both, n[i] + n[j])


def set_links(sets: list[np.ndarray], group: np.ndarray, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs of similar sets that tie the groups together which such pairs tie, fewer than there are groups; with
    ``side`` only pairs of unlike sides count."""
    n = np.array([len(s) for s in sets], np.int64)
    whole, found = WholeSets(sets), []

    def decide(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        i, j, most = (np.concatenate(x) for x in zip(*held, strict=True))
        good = whole.similar(i, j, n)
        if good.any():
            tied = forest([(i[good], j[good], most[good])], n, group)
            found.append((*tied, np.zeros(len(tied[0]), np.int64)))

    held, many = [], 0
    for part in block_pairs([signature(s, width(len(s))) for s in sets], n, group, side):
        held.append(part)
        many += len(part[0])
        if many >= PAIRS:
            decide(held)
            held, many = [], 0
    if held:
        decide(held)
    return forest(found, n, group) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sizes and signatures, at the narrower one's width, allow enough overlap."""
    own = sets.select("row_no", "n", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            n_a, n_b = (batch.column(k).to_numpy().tolist() for k in (2, 4))
            for m, n, x, y in zip(n_a, n_b, batch.column(3).to_pylist(), batch.column(5).to_pylist(), strict=True):
                bits = 8 * min(len(x), len(y))
                most = overlap_bound(folded(x, bits), m, folded(y, bits), n)
                good.append(bool(_enough(most, m + n)))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    alike = (LEAST[1] * F.col("n_a") >= LEAST[0] * F.col("n_b")) & (LEAST[1] * F.col("n_b") >= LEAST[0] * F.col("n_a"))
    sizes = sets.select("row_no", "n")
    pairs = pairs.join(sizes.toDF("a", "n_a"), "a").join(sizes.toDF("b", "n_b"), "b").where(alike).select("a", "b")
    joined = pairs.join(own.toDF("a", "n_a", "bits_a"), "a").join(own.toDF("b", "n_b", "bits_b"), "b")
    return joined.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInArrow(run, "a long, b long")


def whole_sets(wanted: DataFrame, sets: DataFrame, docs: DataFrame, work: Scratch) -> DataFrame:
    """Rows ``row_no, tokens`` of the rows wanted (``row_no``, each once), taken anew from their texts and kept in ``work``."""
    rows = work.keep(wanted.join(sets.select("row_no", "doc_id", "text_key"), "row_no"))
    texts = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    ids = small(work.keep(rows.select("doc_id", "text_key").distinct()))
    same = texts["doc_id"].eqNullSafe(ids["doc_id"]) & (texts["text_key"] == ids["text_key"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for part in _unique(batch.column(2)):
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).slice(row, len(part)) for k in range(2)),
                        pa.array([t.tobytes() for t in part], pa.binary()),
                    ],
                    names=["_id", "_key", "tokens"],
                )
                row += len(part)

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = (
        texts.join(ids, same, "left_semi")
        .mapInArrow(whole, f"_id {kind}, _key long, tokens binary")
        .dropDuplicates(["_id", "_key"])
    )
    return work.keep(
        rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))).select(
            "row_no", "tokens"
        )
    )


def linked(pairs: DataFrame, sets: DataFrame, docs: DataFrame, store: Scratch) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar, counted on the whole sets, which are taken anew from the texts needed.

    The result is kept in ``store``.
    """
    work = Scratch(docs.sparkSession, "jaccard-whole-sets")
    wanted = pairs.select(F.col("a").alias("row_no")).unionByName(pairs.select(F.col("b").alias("row_no"))).distinct()
    tokens = whole_sets(wanted, sets, docs, work)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(bool(_enough(both, len(x) + len(y))))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(tokens.toDF("a", "x"), "a").join(tokens.toDF("b", "y"), "b")
    out = store.keep(joined.select("a", "b", "x", "y").mapInArrow(count, "a long, b long"))
    work.drop()
    return out


def region_cells(members: DataFrame, work: Scratch) -> DataFrame:
    """Cells ``region, left, right`` in which the rows of a region meet: ``own, row_no, component`` of every row in them.

    Takes ``region, component, row_no, n``. A region is cut into parts: a component with many rows or elements has parts of its
    own, the others are dealt out whole. Any two parts meet in one cell, but for parts of the same component, which is settled;
    so a large component meets the rest and not itself.
    """
    members = work.keep(members)
    sizes = members.groupBy("region", "component").agg(F.count("*").alias("rows"), F.sum("n").alias("elements"))
    need = F.greatest(F.ceil(F.col("rows") / SLICE), F.ceil(F.col("elements") / ELEMENTS)).cast("long")
    sizes = work.keep(sizes.withColumn("large", (F.col("rows") > SLICE // 2) | (F.col("elements") > ELEMENTS // 2)))
    open_ = sizes.groupBy("region").agg(F.count("*").alias("groups")).where("groups > 1").select("region")
    rest = sizes.where("not large").groupBy("region").agg(F.sum("rows").alias("rows"), F.sum("elements").alias("elements"))
    # parts of the rest of a region have no owner
    counts = sizes.where("large").select("region", F.col("component").alias("owner"), need.alias("parts"))
    counts = counts.unionByName(rest.select("region", F.lit(None).cast("long").alias("owner"), need.alias("parts")))
    numbers = Window.partitionBy("region").orderBy("owner").rowsBetween(Window.unboundedPreceding, -1)
    counts = work.keep(
        counts.join(open_, "region", "left_semi").withColumn("first", F.coalesce(F.sum("parts").over(numbers), F.lit(0)))
    )
    large = sizes.where("large").select("region", "component", F.col("component").alias("owner"))
    placed = (
        members.join(large, ["region", "component"], "left")
        .join(small(counts).withColumnsRenamed({"region": "_region", "owner": "_owner"}),
              (F.col("region") == F.col("_region")) & F.col("owner").eqNullSafe(F.col("_owner")))
        .withColumn(
            "own",
            F.col("first") + F.pmod(F.when(F.col("owner").isNull(), F.xxhash64("component")).otherwise(F.xxhash64("row_no")), F.col("parts")),
        )
        .select("region", "owner", "own", "component", "row_no")
    )
    other = counts.select(
        F.col("region").alias("_region"),
        F.col("owner").alias("_owner"),
        F.explode(F.sequence("first", F.col("first") + F.col("parts") - 1)).alias("other"),
    )
    other = small(work.keep(other))
    meets = (F.col("region") == F.col("_region")) & (F.col("owner").isNull() | F.col("_owner").isNull() | (F.col("owner") != F.col("_owner")))
    return placed.join(other, meets).select(
        "region", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "own", "component", "row_no"
    )


def region_links(members: DataFrame, sets: DataFrame, docs: DataFrame, store: Scratch) -> DataFrame:
    """Links ``a, b`` that tie the components of a region together which links tie, of ``region, component, row_no, n``.

    Whole sets come to the cells of their region and are counted there, so no pair leaves a cell but the ties; these are kept
    in ``store``.
    """
    work = Scratch(docs.sparkSession, "jaccard-regions")
    cells = work.keep(region_cells(members, work))
    tokens = whole_sets(cells.select("row_no").distinct(), sets, docs, work)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, 3):
            left, right = table["left"][0].as_py(), table["right"][0].as_py()
            own, rows, group = (table[k].to_numpy() for k in ("own", "row_no", "component"))
            if (group == group[0]).all():
                continue
            side = None if left == right else (own == right).astype(np.int8)
            kept = [np.frombuffer(v.as_buffer(), np.uint64) for v in table["tokens"]]
            a, b = set_links(kept, group, side)
            if len(a):
                yield _row_pairs(rows, a, b)

    key = ["region", "left", "right"]
    dealt = cells.join(tokens, "row_no").select(*key, "own", "row_no", "component", "tokens")
    out = store.keep(dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a long, b long").distinct())
    work.drop()
    return out


def open_pairs(blocks: DataFrame, known: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that tie the known components together between which the trees of a block (``token, row_no``) leave pairs."""
    grouped = blocks.join(known, F.col("row_no") == F.col("node"), "left").select(
        "token", "row_no", F.coalesce("component", "row_no").alias("component")
    )
    # blocks within one group are settled, and of blocks with the same rows one is enough
    open_ = (
        grouped.groupBy("token")
        .agg(
            F.min("component").alias("least"),
            F.max("component").alias("most"),
            F.count("*").alias("n_rows"),
            F.sum(F.xxhash64("row_no").cast("decimal(38,0)")).alias("rows_hash"),
            F.sum(F.xxhash64("row_no", F.lit(1)).cast("decimal(38,0)")).alias("rows_check"),
        )
        .where("least < most")
        .groupBy("n_rows", "rows_hash", "rows_check")
        .agg(F.min("token").alias("token"))
        .select("token", "n_rows")
    )
    return tree_pairs(grouped.join(open_, "token").join(sets.select("row_no", "n", "bits"), "row_no"))


def near_groups(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept, text_key``.

    A text's words are its runs of bytes other than the six ASCII blanks, A-Z as a-z; its set holds its distinct shingles
    of five words, the whole sequence where it has fewer, nothing without words (null and empty texts too). Rows link
    when 4 * intersection >= 3 * union; empty sets link with nothing. ``component_id`` is the smallest doc_id reachable
    by links, itself included (null only if no row of the component has an id), and ``kept`` is true for one row of each
    component, that of the smallest doc_id. Repeated rows are rows of one component; an empty table gives an empty
    table; further columns are ignored.
    """
    work = Scratch(docs.sparkSession, "jaccard")
    sets = work.keep(set_table(docs, frequent_shingles(docs)))
    classes = sets.where("n > 0").groupBy("digest").agg(F.min("row_no").alias("class"), F.count("*").alias("n_rows"))
    copies = work.keep(
        sets.where("n > 0")
        .select("row_no", "digest")
        .join(classes.where("n_rows > 1"), "digest")
        .where(F.col("row_no") != F.col("class"))
        .select("row_no", "class")
    )
    distinct = sets.where("n > 0").join(small(copies.select("row_no")), "row_no", "left_anti")
    # frequent shingles are few by their list's bound: counted with partial sums, then broadcast
    often = distinct.select("row_no", F.explode("often").alias("token"))
    ends = often.groupBy("token").agg(F.min("row_no").alias("first"), F.max("row_no").alias("last")).where("first < last")
    hot = often.join(F.broadcast(ends), "token")
    # the others are dealt out once, for counting and for the join
    rare = distinct.select("row_no", F.explode("rare").alias("token")).repartition("token")
    ends = rare.groupBy("token").agg(F.min("row_no").alias("first"), F.max("row_no").alias("last")).where("first < last")
    cold = rare.join(ends.hint("merge"), "token")
    blocks = work.keep(hot.select("token", "row_no", "first").unionByName(cold.select("token", "row_no", "first")))

    starts = blocks.where("first < row_no").groupBy(F.col("row_no").alias("b")).agg(F.min("first").alias("a"))
    near = work.keep(possible(starts.select("a", "b"), distinct))
    links = linked(near, distinct, docs, work)
    work.done(near)
    known = components(links, "jaccard-first", work)

    # The likeliest pairs that tie groups together, fewer than there are rows. Whatever the trees leave lies within what these
    # pairs and the links tie, so every pair that may still be one lies in a region of them.
    tied = work.keep(open_pairs(blocks, known, distinct))
    work.done(blocks)
    regions = components(links.unionByName(tied), "jaccard-regions", work)
    work.done(tied)
    members = (
        regions.select(F.col("node").alias("row_no"), F.col("component").alias("region"))
        .join(known.select(F.col("node").alias("row_no"), "component"), "row_no", "left")
        .join(distinct.select("row_no", "n"), "row_no")
        .select("region", F.coalesce("component", "row_no").alias("component"), "row_no", "n")
    )
    rest = region_links(members, distinct, docs, work)
    work.done(regions, known)
    whole = components(links.unionByName(rest), "jaccard-all", work)

    node = F.coalesce("class", "row_no")
    rows = (
        sets.select("row_no", "doc_id", "text_key", "n")
        .join(copies.select(F.col("row_no").alias("copy"), "class"), F.col("row_no") == F.col("copy"), "left")
        .withColumn("set_no", node)
        .join(whole, F.col("set_no") == F.col("node"), "left")
        .select("row_no", "doc_id", "text_key", "n", F.coalesce("component", "set_no").alias("component"))
    )
    rows = materialise(rows, "jaccard-rows")
    work.drop()
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_no"))
    least = rows.groupBy("component").agg(F.min(order).alias("best"))
    return rows.join(least, "component").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("best.doc_id").alias("component_id"),
        (F.col("best.row_no") == F.col("row_no")).alias("kept"),
        "text_key",
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, with all their columns."""
    return keep_rows(docs, materialise(near_groups(docs), "jaccard-decided"))
