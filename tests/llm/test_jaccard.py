import itertools
import random

import numpy as np
import pytest

from shelfrank.llm import jaccard
from shelfrank.llm.words import shingle_hashes, steps, word_hashes
from tests.llm.frames import frame, lower, odd_rows, prose, split


def shingles(text):
    w = split(lower(text))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            root[find(j)] = find(i)
    best = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            best[find(i)] = min(doc_id, best.get(find(i), doc_id))
    return sorted(str((r[0], len(sets[i]), best.get(find(i)))) for i, r in enumerate(rows)), len({find(i) for i in range(len(rows))})


def near_copies(n, seed=7):
    """A chain and a crowd of edited texts, some similar only by way of others."""
    r = random.Random(seed)
    words = prose(seed, 120).split()
    rows = []
    for i in range(n):
        if i % 5 == 0:
            words = list(words)
            words[r.randrange(len(words))] = f"edit{i}"
        own = list(words)
        for _ in range(r.randrange(5)):
            own[r.randrange(len(own))] = f"own{i}"
        rows.append((1000 + i, " ".join(own)))
    return rows


def check(spark, rows):
    got = jaccard.near_groups(frame(spark, rows)).collect()
    want, components = brute(rows)
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == want
    assert sum(r.kept for r in got) == components


@pytest.mark.parametrize("cut", [1024, 8])
def test_components_match_brute_force(spark, cut, monkeypatch):
    monkeypatch.setattr(jaccard, "SLICE", cut)
    monkeypatch.setattr(jaccard, "RUN", 500)
    common = prose(99, 50)
    rows = odd_rows() + near_copies(60) + [(2000 + i, prose(50 + i, 30) + " " + common) for i in range(20)]
    check(spark, rows)


def test_empty_table_and_kept_rows(spark):
    assert jaccard.near_groups(frame(spark, [])).count() == 0
    rows = odd_rows()
    kept = jaccard.drop_near_copies(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    assert kept.count() == brute(rows)[1]


def test_trees_lose_no_pair():
    r = np.random.default_rng(3)
    pool = r.integers(0, 2**63, 300).astype(np.uint64)
    sets = [np.unique(r.choice(pool, r.integers(1, 40))) for _ in range(70)]
    sets += [np.unique(np.append(s[: len(s) - 1], r.choice(pool, 1))) for s in sets[:40]]
    bits = np.array([np.frombuffer(jaccard.signature(s), np.uint64) for s in sets])
    n, group = np.array([len(s) for s in sets]), np.arange(len(sets))
    similar = {
        (i, j)
        for i, j in itertools.combinations(range(len(sets)), 2)
        if 4 * len(np.intersect1d(sets[i], sets[j])) >= 3 * len(np.union1d(sets[i], sets[j]))
    }
    found = {(min(a, b), max(a, b)) for x, y in jaccard.SignatureTree(bits, n, group).pairs() for a, b in zip(x, y, strict=True)}
    assert similar and similar <= found and len(found) < 70 * 110 / 4
    half = [np.arange(len(sets)) % 2 == k for k in (0, 1)]
    trees = [jaccard.SignatureTree(bits[h], n[h], group[h]) for h in half]
    found = {
        tuple(sorted((group[half[0]][a], group[half[1]][b]))) for x, y in trees[0].pairs(trees[1]) for a, b in zip(x, y, strict=True)
    }
    assert {p for p in similar if (p[0] + p[1]) % 2} <= found


def found_pairs(sets, side=None):
    bits, n = [jaccard.signature(s, jaccard.width(len(s))) for s in sets], np.array([len(s) for s in sets])
    pairs = jaccard.block_pairs(bits, n, np.arange(len(sets)), side)
    found = [(min(a, b), max(a, b)) for x, y, _ in pairs for a, b in zip(x.tolist(), y.tolist(), strict=True)]
    assert len(found) == len(set(found))
    return set(found)


def test_blocks_of_all_sizes_lose_no_pair():
    r = np.random.default_rng(4)
    pool = r.integers(0, 2**63, 40_000).astype(np.uint64)
    sets = [np.unique(r.choice(pool, n)) for n in (1, 1, 2, 3, 4, 7, 30, 31, 300, 700, 1500, 4000, 9000, 9000)]
    # subsets just over and just under three quarters
    sets += [s[: max(1, -(-3 * len(s) // 4) + k)] for s in sets for k in (-1, 0, 3)]
    similar = {
        (i, j)
        for i, j in itertools.combinations(range(len(sets)), 2)
        if 4 * len(np.intersect1d(sets[i], sets[j])) >= 3 * len(np.union1d(sets[i], sets[j]))
    }
    assert len(similar) > 40 and similar <= found_pairs(sets)
    side = np.arange(len(sets)) % 2
    assert {p for p in similar if (p[0] + p[1]) % 2} <= found_pairs(sets, side)
    assert all((a + b) % 2 for a, b in found_pairs(sets, side))


@pytest.mark.parametrize("size", [200, 1000, 5000])
def test_unrelated_sets_of_a_block_are_pruned_whatever_their_size(size):
    """All share one shingle, none is similar to another."""
    r = np.random.default_rng(size)
    sets = [np.unique(np.append(r.integers(0, 2**63, size).astype(np.uint64), np.uint64(7))) for _ in range(300)]
    assert found_pairs(sets) == set()


def test_a_forest_ties_the_groups_that_pairs_tie():
    r = np.random.default_rng(5)
    for _ in range(60):
        size = int(r.integers(2, 30))
        group, n = r.integers(0, 9, size), r.integers(5, 50, size)
        a, b = r.integers(0, size, (2, int(r.integers(1, 60))))
        most = r.integers(1, 5, len(a))
        x, y = jaccard.forest([(a[:7], b[:7], most[:7]), (a[7:], b[7:], most[7:])], n, group)
        assert len(x) < len(np.unique(group)) and {*zip(x, y)} <= {*zip(a, b)}

        def parts(p, q):
            own = {g: g for g in group.tolist()}
            for i, j in zip(group[p].tolist(), group[q].tolist()):
                low, high = sorted((own[i], own[j]))
                own = {g: low if v == high else v for g, v in own.items()}
            return own

        assert parts(x, y) == parts(a, b)


def test_a_worker_holds_bounded_steps():
    """Texts of 4 MB, and a descent that 600 sets of 1,000 elements are left in: what a worker holds besides."""
    import tracemalloc

    import pyarrow as pa

    def peak(work):
        tracemalloc.start()
        try:
            work()
            return tracemalloc.get_traced_memory()[1] >> 20
        finally:
            tracemalloc.stop()

    texts = pa.array([prose(k, 400) for k in range(1 << 22 >> 11)])
    jaccard.word_hashes(np.zeros(1, np.uint8), np.array([0, 1]))  # the tables of powers stay
    assert peak(lambda: [None for _ in jaccard._unique(texts)]) < 12
    r = np.random.default_rng(8)
    base = r.integers(0, 2**63, 1000).astype(np.uint64)
    sets = [np.unique(np.append(base[150:], r.integers(0, 2**63, 150).astype(np.uint64))) for _ in range(600)]
    bits, n = [jaccard.signature(x, jaccard.width(len(x))) for x in sets], np.full(600, 1000)
    assert peak(lambda: [None for _ in jaccard.block_pairs(bits, n, np.arange(600))]) < 32


def test_steps_are_removed_when_read(spark):
    from shelfrank.llm.tables import Scratch

    work = Scratch(spark, "scratch")
    kept = [work.keep(spark.range(n)) for n in (3, 4)]
    path = spark._jvm.org.apache.hadoop.fs.Path(work.folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    work.done(kept[0])
    assert [f.getPath().getName() for f in files.listStatus(path)] == ["1"] and kept[1].count() == 4
    work.drop()
    assert not files.exists(path)


def test_hashes_stand_for_words():
    import pyarrow as pa

    texts = [t for _, t, *_ in odd_rows()] + [prose(k, 40, 3) for k in range(5)]
    for limit in (64, 1 << 20):
        seen = {}
        for lo, hi, data, offsets in steps(pa.array(texts), limit):
            words, start, end, first = word_hashes(data, offsets)
            runs, at = shingle_hashes(words, first, 5)
            for i in range(lo, hi):
                own = split(lower(texts[i]))
                mine = words[first[i - lo] : first[i - lo + 1]]
                assert len(mine) == len(own)
                for w, h in zip(own, mine, strict=True):
                    assert seen.setdefault(w, h) == h
                assert len(np.unique(runs[at[i - lo] : at[i - lo + 1]])) == len(shingles(texts[i]))
        assert len(set(seen.values())) == len(seen)


def two_crowds(n, apart):
    """Two crowds of texts, each of near copies; ``apart`` words lie between the crowds."""
    words = prose(11, 200).split()
    other = words[:60] + [f"other{k}" for k in range(apart)] + words[60 + apart :]
    return [(100 + k, " ".join([*(words, other)[k % 2], f"own{k}"])) for k in range(2 * n)]


@pytest.mark.parametrize("apart", [22, 28])
def test_crowds_near_the_limit_are_not_expanded_into_pairs(spark, apart, monkeypatch):
    """Between the crowds every pair is left by the signatures: just linked (22) or just not (28)."""
    rows, seen, whole = two_crowds(40, apart), [], jaccard.linked

    def counted(pairs, *args):
        seen.append(pairs.count())
        return whole(pairs, *args)

    monkeypatch.setattr(jaccard, "linked", counted)
    check(spark, rows)
    assert sum(seen) < 2 * len(rows)


@pytest.mark.parametrize("limits", [{}, {"SLICE": 8}, {"SLICE": 8, "ELEMENTS": 700, "PAIRS": 5, "STEP": 512}])
def test_links_of_a_region_are_found_in_its_cells(spark, limits, monkeypatch):
    """Without the links of the pairs that the trees tie first, the cells have to find them."""
    for name, value in limits.items():
        monkeypatch.setattr(jaccard, name, value)
    whole, calls = jaccard.linked, []

    def first_only(pairs, *args):
        calls.append(1)
        return whole(pairs if len(calls) == 1 else pairs.where("a < 0"), *args)

    monkeypatch.setattr(jaccard, "linked", first_only)
    rows = two_crowds(12, 22) + [(k + 50, t.replace(" ", " x ", 1)) for k, t in two_crowds(4, 28)] + near_copies(40)
    check(spark, rows + [(None, None), (7, ""), (7, rows[0][1]), (7, rows[0][1])])
    assert len(calls) == 1


@pytest.mark.parametrize("step", [64, 1 << 20])
def test_links_between_whole_sets_match_brute_force(step, monkeypatch):
    monkeypatch.setattr(jaccard, "STEP", step)
    r = np.random.default_rng(6)
    pool = r.integers(0, 2**63, 500).astype(np.uint64)
    sets = [np.unique(r.choice(pool, int(k))) for k in r.integers(1, 60, 30)]
    sets += [np.unique(np.append(s[: max(1, len(s) - int(k))], r.choice(pool, 2))) for s in sets for k in (0, 2, 5)]
    n = np.array([len(s) for s in sets])
    pairs = np.array(list(itertools.combinations(range(len(sets)), 2)))
    similar = [4 * len(np.intersect1d(sets[i], sets[j])) >= 3 * len(np.union1d(sets[i], sets[j])) for i, j in pairs]
    assert jaccard.WholeSets(sets).similar(*pairs.T, n).tolist() == similar and 50 < sum(similar) < len(pairs) / 2
    for group in (np.arange(len(sets)), np.arange(len(sets)) % 9):
        for side in (None, np.arange(len(sets)) % 2):
            wanted = [(i, j) for (i, j), good in zip(pairs.tolist(), similar) if good and (side is None or side[i] != side[j])]
            a, b = jaccard.set_links(sets, group, side)
            assert {(min(x), max(x)) for x in zip(a.tolist(), b.tolist())} <= set(wanted)
            assert len(a) < len(set(group.tolist()))
            names = [group.copy(), group.copy()]
            for own, links in zip(names, (wanted, zip(a.tolist(), b.tolist()))):
                for i, j in links:
                    own[own == max(own[i], own[j])] = min(own[i], own[j])
            assert (names[0] == names[1]).all()
