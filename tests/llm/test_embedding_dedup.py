"""Linked vectors against all pairs, and the recall of pairs at the threshold."""

import math

import numpy as np
import pytest

from prospectra.llm import embedding_dedup

SCHEMA = "vec_id bigint, embedding array<double>, label int, node bigint, `my col` string"


def brute(rows, cosine=0.95):
    """Links and smallest id reachable per row, by position."""
    unit = []
    for own, x, *_ in rows:
        ok = own is not None and x and None not in x and all(map(math.isfinite, x)) and any(x)
        unit.append([v / math.hypot(*x) for v in x] if ok else None)
    links = [[] for _ in rows]
    for i, a in enumerate(unit):
        for j, b in enumerate(unit):
            if i != j and a and b and len(a) == len(b) and sum(v * w for v, w in zip(a, b, strict=True)) >= cosine:
                links[i].append(j)
    found = []
    for i in range(len(rows)):
        seen, stack = {i}, [i]
        while stack:
            new = set(links[stack.pop()]) - seen
            seen |= new
            stack += new
        own = rows[i][0]
        root = None if own is None else min(rows[j][0] for j in seen)
        found.append((own, len(links[i]), root, own is not None and own == root))
    return found


def check(spark, rows, parts=5):
    rows = [(own, x, 1, 7, None) for own, x in rows]
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = [tuple(r) for r in embedding_dedup.near_duplicate_vectors(vectors).collect()]
    assert sorted(found, key=str) == sorted(brute(rows), key=str)


def near(rng, x, angle):
    other = rng.standard_normal(len(x))
    other -= x * (other @ x) / (x @ x)
    return x / np.linalg.norm(x) * math.cos(angle) + other / np.linalg.norm(other) * math.sin(angle)


def made(rng, n, dimension=24):
    """Random vectors, chains of near ones, and copies; some scaled."""
    vectors = []
    for _ in range(n):
        if vectors and rng.random() < 0.5:
            old = vectors[rng.integers(len(vectors))]
            vectors.append(old if rng.random() < 0.3 else near(rng, old, rng.uniform(0, 0.2)) * rng.choice([0.01, 1, 90]))
        else:
            vectors.append(rng.standard_normal(dimension))
    return [(3 * k, v.tolist()) for k, v in enumerate(vectors)]


def test_one_leaf(spark):
    check(spark, made(np.random.default_rng(1), 150))


def test_many_leaves_and_tables(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "LEAF", 8)
    check(spark, made(np.random.default_rng(2), 250))


@pytest.mark.parametrize("leaf", [16, 10_000])
def test_crowded_leaves(spark, monkeypatch, leaf):
    """Chunks, and balls that are counted as a group."""
    monkeypatch.setattr(embedding_dedup, "LEAF", leaf)
    monkeypatch.setattr(embedding_dedup, "CHUNK", 20)
    rng = np.random.default_rng(3)
    rows = made(rng, 80)
    centre = rng.standard_normal(24)
    # none at the threshold, where a pair may be missed
    rows += [(1000 + k, near(rng, centre, 0.17 if k % 6 == 0 else rng.uniform(0, 0.1)).tolist()) for k in range(120)]
    rows += [(2000 + k, rows[90][1]) for k in range(30)]
    check(spark, rows)


def test_recall_at_the_threshold():
    """Pairs of cosine 0.9501 meet in a table and pass the windows, whatever the number of vectors."""
    rng = np.random.default_rng(4)
    sample = rng.standard_normal((4096, 64))
    sample /= np.linalg.norm(sample, axis=1)[:, None]
    a = sample[:1500]
    b = np.array([near(rng, x, math.acos(0.9501)) for x in a])
    for rows in (1000, 50_000, 10_000_000):
        layout = embedding_dedup.Layout(sample, rows, 64, 0.95)
        (below, above), (below_b, above_b) = layout.sides(a), layout.sides(b)
        met = ((below & below_b | above & above_b) == (1 << layout.depth) - 1).any(axis=1)
        wide = np.abs((a - b) @ embedding_dedup.directions(embedding_dedup.WIDE, 64).T)
        met &= (wide <= embedding_dedup.WIDE_WINDOW * layout.deviation).all(axis=1)
        both, size = np.concatenate([a, b]), np.full(3000, 64)
        linked = embedding_dedup._linked_pairs(both, size, layout, np.arange(1500), np.arange(1500, 3000))
        assert (met & linked).mean() >= 0.98
        copies = len(layout.leaves(below, above)[0]) / len(a)
        assert copies <= 60


def test_near_equal_vectors_need_no_tables_without_end():
    rng = np.random.default_rng(6)
    sample = np.array([near(rng, np.ones(16), 0.01) for _ in range(500)])
    layout = embedding_dedup.Layout(sample, 10**9, 16, 0.95)
    assert layout.tables <= embedding_dedup.TABLES


def test_rows_of_any_kind(spark):
    x, y = [1.0, 2.0, 3.0], [3.0, -2.0, 0.5]
    rows = [(1, x), (1, x), (2, [2.0, 4.0, 6.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 2.0])]
    rows += [(7, [1.0, float("nan"), 2.0]), (8, [float("inf"), 1.0, 1.0]), (None, x), (9, y), (10, [1.0, 2.0]), (11, [-0.0, 0.0])]
    rows += [(12, [1e300, 2e300, 3e300]), (13, [1.0, 2.0, 3.0, 0.0]), (14, [-1.0, -2.0, -3.0])]
    check(spark, rows)
    floats = spark.createDataFrame([(1, x), (2, x)], "vec_id int, embedding array<float>")
    assert sorted(map(tuple, embedding_dedup.near_duplicate_vectors(floats).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]
    assert embedding_dedup.near_duplicate_vectors(floats.limit(0)).count() == 0
