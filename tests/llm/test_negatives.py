"""Hard negatives against brute force, on odd and on clustered vectors."""

import math

import numpy as np
import pytest

from panelyze.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int, rid long, cell string, rank int"


def brute_force(rows):
    taken = []
    for vec_id, v, label, *_ in rows:
        if vec_id is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(256 * float(np.float32(x))) for x in v]
        taken.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, v))
    out = []
    for i, (a, a_label, q) in enumerate(taken):
        if a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(q, v)), c, label) for j, (c, label, v) in enumerate(taken) if j != i and len(v) == len(q)]
        scored.sort()
        for minus, p, _ in [s for s in scored if s[2] == a_label][:5]:
            own = -minus
            fits = [s for s in scored if s[2] != a_label and 30 * own <= -100 * s[0] <= 90 * own][:10]
            out += [(a, p, r + 1, c, own, -s) for r, (s, c, _) in enumerate(fits)]
    return sorted(out)


def odd_vectors():
    rng = np.random.default_rng(3)
    rows = []
    centres = rng.normal(size=(6, 8))
    for i in range(700):
        v = centres[i % 6] + rng.normal(size=8) * 0.3
        rows.append((i, [float(x) for x in v * rng.uniform(0.1, 1.2)], int(rng.integers(0, 4)), 1, "x", 2))
    copy = [0.5] * 8
    rows += [(1000 + i, copy, i % 3, 1, "x", 2) for i in range(60)]
    # Repeated ids, other lengths, null and non-finite ones, no positives, zero and negative scores.
    rows += [(100, copy, 1, 0, "", 0), (100, copy, 1, 0, "", 0), (200, copy, 2, 0, "", 0)]
    rows += [(3000, [1.0, 2.0], 1, 0, "", 0), (3001, [1.0, 1.5], 1, 0, "", 0), (3002, [0.5, 0.75], 2, 0, "", 0)]
    rows += [(3100, [], 1, 0, "", 0), (3101, [], 1, 0, "", 0), (3102, [], 2, 0, "", 0)]
    rows += [(3200, [0.0] * 8, 3, 0, "", 0), (3300, [-3.0] * 8, 8, 0, "", 0), (3301, [3.0] * 8, 8, 0, "", 0)]
    rows += [(4000, None, 1, 0, "", 0), (4100, copy, None, 0, "", 0), (None, copy, 1, 0, "", 0)]
    rows += [(4200, [float("nan")] * 8, 1, 0, "", 0), (4300, [None] + [1.0] * 7, 1, 0, "", 0), (4400, [float("inf")] * 8, 1, 0, "", 0)]
    return rows


def mined(spark, rows):
    rows = N.prepared(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = N.hard_negatives(rows, rows.where(f"vec_id % {N.ANCHOR_STEP} = 0"))
    return sorted(tuple(r) for r in got.collect())


def test_equals_brute_force(spark, monkeypatch):
    # Many cells, blocks and tree levels, though the table is small.
    monkeypatch.setattr(N, "BLOCK", 64)
    monkeypatch.setattr(N, "LEAF", 3)
    rows = odd_vectors()
    want = brute_force(rows)
    assert len(want) > 100 and mined(spark, rows) == want


def test_one_block(spark):
    rows = odd_vectors()
    assert mined(spark, rows) == brute_force(rows)


def test_empty_table(spark):
    assert mined(spark, []) == []


def test_too_large_products_are_an_error(spark):
    with pytest.raises(ArithmeticError):
        mined(spark, [(0, [1e9], 1, 0, "", 0), (1, [1e9], 1, 0, "", 0)])


def clusters(n=1500):
    rng = np.random.default_rng(1)
    x = np.repeat(rng.normal(size=(15, 6)) * 500, n // 15, 0) + rng.normal(size=(n, 6)) * 20
    return np.floor(x)


def test_tree_covers_and_bounds():
    x = N.augmented(clusters(), 5e6)
    parent, radius = N.cover_tree(x)
    assert (parent[1:] >= 0).all() and parent[0] == -1
    for i in range(1, len(x)):
        at = i
        while parent[at] >= 0:
            at = parent[at]
            assert np.linalg.norm(x[i] - x[at]) <= radius[at] * (1 + 1e-12)


def test_search_skips_nodes():
    x = clusters()
    square = float((x * x).sum(1).max())
    parent, radius = N.cover_tree(N.augmented(x, square))
    ids = np.arange(len(x))
    tree = N.Tree(x, square, ids, ids % 2, ids, parent, radius)
    scored = []

    class Watched(np.ndarray):
        def __matmul__(self, q):
            scored.append(len(self))
            return np.asarray(self) @ q

    tree.vectors = tree.vectors.view(Watched)
    (rows, score), = tree.search(x[7], 7, 0, False, np.array([-np.inf]), np.array([np.inf]), 10)
    all_scores = [(-float(x[7] @ x[i]), i) for i in range(len(x)) if i % 2 == 1]
    assert [(-s, i) for s, i in zip(score, tree.ids[rows])] == sorted(all_scores)[:10]
    # Nodes outside are skipped with all that hangs below them.
    assert sum(scored) < 0.6 * len(x)
