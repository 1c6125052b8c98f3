"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from prospectra.llm import hard_negatives

SCHEMA = "vec_id bigint, embedding array<double>, label int, shard string, `my col` int"


def brute(rows, positives=5, negatives=10):
    usable = [
        (own, [math.floor(256 * v) for v in x], label)
        for own, x, label, *_ in rows
        if None not in (own, x, label) and x and None not in x and all(map(math.isfinite, x))
    ]
    usable = [r for r in usable if math.hypot(*r[1]) < hard_negatives.LONGEST]
    found = []
    for own, x, label in sorted({(o, tuple(x), n) for o, x, n in usable if o % 10 == 0}):
        scored = sorted((-sum(map(int.__mul__, x, y)), o, n) for o, y, n in usable if o != own)
        for p, positive, _ in [r for r in scored if r[2] == label][:positives]:
            far = [(s, o) for s, o, n in scored if n != label and 30 * -p <= 100 * -s <= 90 * -p][:negatives]
            found += [(own, positive, k, o, -p, -s) for k, (s, o) in enumerate(far, 1)]
    return sorted(found)


def check(spark, rows, **options):
    vectors = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA).repartition(4)
    found = hard_negatives.hard_negatives(vectors, F.col("vec_id") % 10 == 0, **options).collect()
    expected = brute(rows, options.get("positives", 5), options.get("negatives", 10))
    assert sorted(map(tuple, found)) == expected
    return expected


def made(rng, n, dimension=6):
    """Clusters, copies and lone vectors of very different lengths, under few labels."""
    rows = []
    for k in range(n):
        if rows and rng.random() < 0.6:
            x = np.array(rows[rng.integers(len(rows))][1])
            x = x if rng.random() < 0.3 else x + 0.1 * rng.standard_normal(dimension)
        else:
            x = rng.standard_normal(dimension) * rng.choice([0.05, 1, 20])
        rows.append((k, x.tolist(), int(rng.integers(4))))
    return rows


def test_against_all_pairs(spark):
    assert check(spark, made(np.random.default_rng(1), 300))


def test_many_shards_pieces_and_blocks(spark, monkeypatch):
    for name, value in (("SHARD", 16), ("PIECE", 4), ("LARGEST_PIECE", 8), ("BLOCK", 3)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert check(spark, made(np.random.default_rng(2), 200), positives=3, negatives=4)


def test_large_numbers(spark):
    rng = np.random.default_rng(3)
    rows = [(k, (rng.standard_normal(3) * 4e5).tolist(), k % 3) for k in range(60)]
    assert any(abs(r[5]) > 2**53 for r in check(spark, rows))


def test_tree_covers_and_separates():
    rng = np.random.default_rng(4)
    rows = np.floor(rng.standard_normal((900, 5)) * 40)
    tree = hard_negatives.CoverTree(rows)
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(900))
    inside = {}
    for depth in range(len(tree.levels) - 1, -1, -1):
        centres, radii = tree.levels[depth]
        for node, below in enumerate(tree.children[depth]):
            of = tree.leaves[-1 - below[0]] if below[0] < 0 else np.concatenate([inside[depth + 1, k] for k in below])
            inside[depth, node] = of
            assert np.linalg.norm(rows[of] - centres[node], axis=1).max() <= radii[node] + 1e-6
            if below[0] >= 0:
                kids, reach = tree.levels[depth + 1][0][below], tree.levels[depth + 1][1][below]
                apart = np.linalg.norm(kids[:, None] - kids[None], axis=2) + 1e9 * np.eye(len(kids))
                assert apart.min() >= reach.max() - 1e-6


@pytest.mark.parametrize("same", [True, False])
def test_search_skips_leaves(same):
    """Clusters far apart: a query verifies few rows and still finds the best in its window."""
    rng = np.random.default_rng(5)
    rows = np.floor(np.repeat(rng.standard_normal((40, 8)) * 2000, 60, axis=0) + rng.standard_normal((2400, 8)) * 20)
    ids, labels, queries = np.arange(2400), np.arange(2400) % 2, rows[::97]
    n = len(queries)
    low, high = np.full(n, -(2**62)), (queries**2).sum(axis=1).astype(np.int64) // 2
    asked = hard_negatives.Queries(queries, np.arange(n) * 97, np.zeros(n, np.int64), low, high, same, 3)
    seen = []
    offer = asked.offer
    asked.offer = lambda of, some, *rest: (seen.append(len(of) * len(some)), offer(of, some, *rest))
    longest = float((rows**2).sum(axis=1).max())
    tree = hard_negatives.CoverTree(hard_negatives.augmented(rows, longest))
    hard_negatives.search(asked, tree, longest, rows, ids, labels)
    scores = (queries @ rows.T).astype(np.int64)
    for k in range(n):
        fits = [i for i in range(2400) if (labels[i] == 0) == same and scores[k, i] <= high[k] and i != 97 * k]
        assert asked.ids[k].tolist() == sorted(fits, key=lambda i: (-scores[k, i], i))[:3]
    assert sum(seen) < n * 2400 / 3


def test_rows_of_any_kind(spark):
    x, y = [1.0, 2.0], [1.0, 1.0]
    rows = [(10, x, 1), (10, x, 1), (11, x, 1), (12, y, 2), (12, y, 2), (13, y, None), (14, None, 2), (None, y, 2), (15, [], 2)]
    rows += [(16, [1.0, None], 2), (17, [float("nan"), 1.0], 2), (18, [float("inf"), 1.0], 2), (19, [1e200, 1.0], 2)]
    rows += [(20, [0.0, 0.0], 2), (21, [-1.0, -2.0], 2), (22, y, 3)]
    assert [r[:4] for r in check(spark, rows) if r[0] == 10] == [(10, 11, 1, 12), (10, 11, 2, 12), (10, 11, 3, 22)]
    assert check(spark, [(10, x, 1)]) == [] and check(spark, [(11, x, 1), (12, y, 2)]) == []
    assert check(spark, [(10, x, 1), (20, y, 2), (30, y, 3)]) == []
    nothing = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.hard_negatives(nothing, F.col("vec_id") % 10 == 0).columns[:2] == ["anchor_id", "positive_id"]
