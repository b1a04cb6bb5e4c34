import numpy as np
import pytest

from shelfrank.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, row_no long, unit string, component string, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, "a", "b", 2) for i, v in rows], SCHEMA)


def crowd(seed=1, n=400, size=24):
    """Vectors far apart, pairs, chains and two dense groups, one of which holds equal vectors."""
    r = np.random.default_rng(seed)
    out = list(r.standard_normal((n, size)))
    out += [out[i] + 0.12 * r.standard_normal(size) for i in range(0, n, 9)]
    out += [out[i] + 0.25 * r.standard_normal(size) for i in range(0, n, 5)]
    middle = r.standard_normal(size)
    out += [middle + 0.1 * r.standard_normal(size) for _ in range(120)]
    out += [out[7]] * 30 + [3 * out[7]]
    return [(1000 - i, v) for i, v in enumerate(out)]


def odd():
    return [
        (2000, None),
        (2001, [0.0] * 24),
        (2002, [float("nan")] + [1.0] * 23),
        (2003, [float("inf")] + [1.0] * 23),
        (2004, [None] + [1.0] * 23),
        (2005, []),
        (2006, [1.0, 2.0]),
        (2007, [2.0, 4.0]),
        (2008, [1e-30] * 24),
        (2009, [3e38] * 24),
        (2010, [1.0] * 23),
        (None, [5.0] * 24),
    ]


def brute(rows):
    good = [v is not None and len(v) and all(x is not None and np.isfinite(np.float32(x)) for x in v) and any(v) for _, v in rows]
    unit = [np.array(np.float32(v), float) if g else None for (_, v), g in zip(rows, good, strict=True)]
    unit = [None if u is None else u / np.abs(u).max() for u in unit]
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    near = [[j for j in range(len(rows)) if j != i and good[i] and good[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9] for i in range(len(rows))]
    label = list(range(len(rows)))
    ids = [float("inf") if i is None else i for i, _ in rows]
    label = [ids[i] for i in label]
    changed = True
    while changed:
        new = [min([label[i], *(label[j] for j in near[i])]) for i in range(len(rows))]
        changed, label = new != label, new
    return [(rows[i][0], len(near[i]), None if label[i] == float("inf") else label[i]) for i in range(len(rows))]


@pytest.mark.parametrize(("enlarged", "block"), [(40, 1024), (12, 50)])
def test_links_match_brute_force(spark, enlarged, block, monkeypatch):
    monkeypatch.setattr(neighbours, "ENLARGED", enlarged)
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rows = crowd() + odd() + [(3000, crowd()[0][1])] * 2
    got = neighbours.near_vectors(frame(spark, rows)).collect()
    want = brute(rows)
    assert len(got) == len(want)
    found = sum(r.n_links for r in got) / sum(w[1] for w in want)
    assert 0.97 <= found <= 1
    key = lambda r: (str(r[0]), r[1])
    pairs = list(zip(sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key), sorted(want, key=key), strict=True))
    assert all(g[0] == w[0] and g[1] <= w[1] for g, w in pairs)
    assert sum(g[2] == w[2] for g, w in pairs) >= 0.98 * len(pairs)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_empty_table(spark):
    assert neighbours.near_vectors(frame(spark, [])).count() == 0
    assert [tuple(r) for r in neighbours.near_vectors(frame(spark, [(4, [1, 2])])).collect()] == [(4, 0, 4, True)]


def test_audit_measures_recall(spark):
    points = spark.createDataFrame([(i, [1.0, i / 1000], 1) for i in range(10)], "row_no long, unit array<double>, copies long")
    counts = spark.createDataFrame([(i, 9 if i < 5 else 0) for i in range(10)], "row_no long, n long")
    assert neighbours.audit(points, counts, 2) == pytest.approx(0.5)


def clusters(sizes, seed=3, size=24, spread=0.05):
    """Tight groups around centres far apart."""
    r = np.random.default_rng(seed)
    out = []
    for n in sizes:
        middle = r.standard_normal(size)
        out += [middle + spread * r.standard_normal(size) for _ in range(n)]
    return list(enumerate(out))


def test_tight_groups_keep_all_links(spark):
    rows = clusters([15, 30, 38, 60] * 3)
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in neighbours.near_vectors(frame(spark, rows)).collect())
    assert got == brute(rows)


def test_forest_joins_groups_of_a_meeting():
    r = np.random.default_rng(5)
    x, y = np.linalg.qr(r.standard_normal((64, 2)))[0].T
    # two groups of 20 whose only link is the one between their last members
    unit = np.array([x] * 19 + [x + 0.1 * y] + [y] * 19 + [y + 0.1 * x])
    unit[[19, 39]] = [x * 0.88 + y * 0.47, x * 0.62 + y * 0.78]
    unit = unit + 0.002 * r.standard_normal(unit.shape)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    code = np.rint(unit * 127).astype(np.float32)
    out = neighbours._best(np.arange(40), code).to_pydict()
    ties = {(min(a, b), max(a, b)) for a, b, t in zip(out["a"], out["b"], out["tie"], strict=True) if t}
    near = unit @ unit.T >= neighbours.LEAST

    def parts(edges):
        label = list(range(40))
        for _ in range(40):
            for i, j in edges:
                label[i] = label[j] = min(label[i], label[j])
        return label

    every = [(i, j) for i in range(40) for j in range(i) if near[i, j]]
    assert parts([e for e in ties if near[e]]) == parts(every)


def test_isolated_pairs_are_found_in_deep_trees(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF", 4)
    r = np.random.default_rng(8)
    out = r.standard_normal((1800, 64))
    out[1500:] = out[:300] + 0.45 * out[1500:]
    rows = list(enumerate(out))
    got = sum(x.n_links for x in neighbours.near_vectors(frame(spark, rows)).collect())
    want = sum(x[1] for x in brute(rows))
    assert want > 300 and 0.97 * want <= got <= want


def test_trees_follow_their_depth():
    assert neighbours.tree_count(1000) == neighbours.TREES
    same = (1 - np.arccos(0.9) / np.pi) ** 17
    assert 1 - (1 - same) ** (neighbours.tree_count(3_000_000) * (neighbours.ROUNDS + 1)) >= neighbours.RECALL


def test_short_rounds_end_in_comparing_all(spark, monkeypatch):
    for name, value in {"LEAF": 4, "TREES": 1, "ROUNDS": 1, "MOST_ROUNDS": 1, "RECALL": 0.99999, "BLOCK": 100}.items():
        monkeypatch.setattr(neighbours, name, value)
    monkeypatch.setattr(neighbours, "tree_count", lambda n: 1, raising=False)
    rows = crowd()
    got = neighbours.near_vectors(frame(spark, rows)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == sorted(brute(rows))


def test_audit_counts_vectors_alike(spark):
    # a group of 200 that is found, ten pairs that are not
    rows = [(i, [1.0, 0.0], 1) for i in range(200)]
    rows += [(200 + i, [0.0] * (2 + i // 2) + [1.0] + [0.0] * (9 - i // 2), 1) for i in range(20)]
    rows = [(i, u + [0.0] * (12 - len(u)), c) for i, u, c in rows]
    points = spark.createDataFrame(rows, "row_no long, unit array<double>, copies long")
    counts = spark.createDataFrame([(i, 199) for i in range(200)], "row_no long, n long")
    assert neighbours.audit(points, counts, 12) == pytest.approx(200 / 220)
    assert neighbours.audit(points, counts, 12, among=points.where("row_no >= 200")) == 0
