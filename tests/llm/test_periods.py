"""Periodic runs against a plain scan over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from prospectra.llm import periods
from prospectra.llm.queries import op13_periodic_runs

SCHEMA = "doc_id bigint, text string, runs int, collapsed string, `my col` string"


def brute(words, shortest=12):
    """Every stretch whose words stand again `p` later, for every period p; of equal stretches the smallest p."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i + p - start >= max(shortest, 2 * p):
                found.setdefault((start, i + p - start), p)
            i += 1
    return sorted((s, length, p) for (s, length), p in found.items())


def brute_kept(words, runs):
    out = set()
    for start, length, period in runs:
        out |= set(range(start + period, start + length))
    return [w for k, w in enumerate(words) if k not in out]


def random_texts(rng, n):
    made = []
    for _ in range(n):
        size, kinds = rng.choice([0, 5, 11, 12, 40, 300]), rng.choice([1, 2, 3, 50])
        text = [b"%d" % rng.randrange(kinds) for _ in range(size)]
        if size and rng.random() < 0.6:
            a = rng.randrange(size)
            p = 1 + rng.randrange(max(1, (size - a) // 3))
            text = text[:a] + [text[a + (i - a) % p] for i in range(a, size)]
        made.append(text)
    return made


@pytest.mark.parametrize("together", [1, 100, 1 << 17])
def test_runs_of_random_texts(monkeypatch, together):
    monkeypatch.setattr(periods, "TOGETHER", together)
    rng = random.Random(together)
    for _ in range(40):
        texts = random_texts(rng, 6)
        for words, runs in zip(texts, periods.runs_of(texts), strict=True):
            expected = brute(words)
            assert sorted(map(tuple, runs.tolist())) == expected
            assert periods.collapsed(words, runs) == brute_kept(words, expected)


def test_cover_holds_every_difference():
    pairs = {(a - b) % periods.V for a in periods.COVER for b in periods.COVER}
    assert pairs == set(range(periods.V))


def test_extensions_beyond_the_samples():
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 2, 3000).astype(np.int32)
    codes[1700:2900] = codes[200:1400]
    codes[-1] = -1
    a, b = rng.integers(0, 1500, 500), rng.integers(1500, 3000, 500)
    a[:200], b[:200] = np.arange(200, 400), np.arange(1700, 1900)
    found = periods.Extensions(codes, np.array([0])).of(a, b)
    for x, y, n in zip(a.tolist(), b.tolist(), found.tolist(), strict=True):
        expected = 0
        while y + expected < 3000 and codes[x + expected] == codes[y + expected]:
            expected += 1
        assert n == expected
    assert found.max() > 1000


def test_one_word_all_along():
    words = [b"a"] * 3000
    assert periods.runs_of([words])[0].tolist() == [[0, 3000, 1]]


def test_rows_of_any_kind(spark):
    long = " ".join(["x y z"] * 30_000)
    rows = [(1, None), (2, ""), (3, " \t"), (4, "a b " * 6), (4, "a b " * 6), (None, "q " * 12), (5, long), (6, "Ä\u00a0b " * 12)]
    docs = spark.createDataFrame([(i, t, 1, "z", "y") for i, t in rows], SCHEMA).repartition(3)
    found = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in periods.periodic_runs(docs).collect()]
    expected = [(1, [], ""), (2, [], ""), (3, [], ""), (4, [(0, 12, 2)], "a b"), (4, [(0, 12, 2)], "a b")]
    expected += [(None, [(0, 12, 1)], "q"), (5, [(0, 90_000, 3)], "x y z"), (6, [(0, 12, 1)], "Ä\u00a0b")]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert periods.periodic_runs(docs.limit(0)).count() == 0


def test_query(spark, tmp_path):
    rng = random.Random(9)
    rows = [(k, b" ".join(text).decode(), 1, None, None) for k, text in enumerate(random_texts(rng, 200))] + [(900, None, 0, "", "")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in op13_periodic_runs(spark, str(tmp_path)).collect()}
    planted = 0
    for doc_id, text, *_ in rows:
        words, h = (text or "").split(), zlib.crc32(str(doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = sorted(brute(words), key=lambda r: (r[0], r[2]))
        row, best = found[doc_id], min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        text = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        assert row.runs_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(" ".join(brute_kept(words, runs)).encode()).hexdigest()
    assert planted > 10 and len(found) == len(rows)
