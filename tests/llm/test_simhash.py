"""SimHash classes against brute force over all pairs."""

import random

import numpy as np
import xxhash

from prospectra.llm import simhash


def brute_fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(marks, bits):
    root = list(range(len(marks)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(marks))]


def texts(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    made = []
    for _ in range(n):
        if made and rng.random() < 0.5:
            old = (rng.choice(made) or "").split(" ")
            if old:
                old[rng.randrange(len(old))] = rng.choice(words)
            made.append(" ".join(old))
        else:
            made.append(" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 4, 30, 200]))))
    return made


def test_fingerprint_of_slices(monkeypatch):
    from prospectra.llm import batches

    for text in [None, "", " \t", "One two", "a b c d", "Straße É  x y z w", *texts(40, 1)]:
        assert simhash.simhash((text or "").encode(), 4) % 2**64 == brute_fingerprint(text)
    text = " ".join(texts(20, 2)).encode()
    assert [w for c in batches.word_chunks(text, 7) for w in c] == text.split()


def check_groups(spark, rows, bits=4):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fingerprint string, shard int").repartition(4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicate_groups(docs, bits=bits).collect()}
    ids = sorted({r[0] for r in rows if r[0] is not None})
    text = {r[0]: r[1] for r in rows}
    marks = [brute_fingerprint(text[i]) for i in ids]
    roots = brute_roots(marks, bits)
    assert {i: got[i] for i in ids} == {i: (f"{m:016x}", ids[r]) for i, m, r in zip(ids, marks, roots)}


def test_groups(spark):
    rows = [(i * 3, t, "x", 1) for i, t in enumerate(texts(300, 3))] + [(1000, None, None, None), (None, "a b", "", 0)]
    check_groups(spark, rows)


def test_groups_with_deep_tree_and_chunks(spark, monkeypatch):
    for name, value in (("SHARD", 8), ("CHUNK", 16), ("LEAF", 4), ("SAMPLE", 256)):
        monkeypatch.setattr(simhash, name, value)
    check_groups(spark, [(i, t, "x", 1) for i, t in enumerate(texts(400, 4))])


def test_spanning_links_of_dense_sets(monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 8)
    rng = random.Random(5)
    for spread in (3, 8, 20, 64):
        base = rng.getrandbits(64)
        marks = sorted({base ^ sum(1 << rng.randrange(spread) for _ in range(4)) % 2**64 for _ in range(300)})
        marks += sorted({rng.getrandbits(64) for _ in range(200)} - set(marks))
        a, b = simhash.spanning_links(np.array(marks, np.uint64), 4)
        assert simhash._roots(len(marks), a, b).tolist() == brute_roots(marks, 4)


def test_long_chains(spark):
    links = [(i + 1, i) for i in range(100)] + [(500, 300), (500, 200), (300, 250)]
    found = simhash.components(spark.createDataFrame(links, "node bigint, parent bigint")).collect()
    expected = {i: 0 for i in range(1, 101)} | {500: 200, 300: 200, 250: 200}
    assert {r.node: r.root for r in found} == expected


def test_empty_table_and_kept_rows(spark):
    schema = "doc_id bigint, text string, row string"
    assert simhash.near_duplicate_groups(spark.createDataFrame([], schema)).count() == 0
    long = " ".join(f"v{i}" for i in range(300))
    rows = [(5, long, "a"), (2, long, "b"), (2, long, "b"), (9, long + " v", "c"), (None, "q", "d"), (7, "z", None)]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, schema).repartition(3))
    assert kept.columns == ["doc_id", "text", "row"]
    assert sorted((r.doc_id or -1, r.row or "") for r in kept.collect()) == [(-1, "d"), (2, "b"), (7, "")]
