"""One-pass counts against greedy longest match."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from prospectra.llm import wordpiece


def greedy(word, vocabulary):
    at, found = 0, 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocabulary), at)
        if end == at:
            return 0
        at, found = end, found + 1
    return found


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=5), max_size=12), st.lists(st.text("abcd", max_size=14), max_size=8))
def test_counts(vocabulary, words):
    pieces = {piece.encode() for piece in vocabulary}
    automaton = wordpiece.LongestMatch(pieces)
    assert [automaton.count(w.encode()) for w in words] == [greedy(w.encode(), pieces) for w in words]


def test_documents(spark):
    rng = random.Random(2)
    vocabulary = {b" ", b" a", b"a", b"b", b"ab", b"abc", b" abca", b"ca", "é".encode()}
    texts = [" ".join("".join(rng.choices("abcé", k=rng.randint(1, 9))) for _ in range(20)) for _ in range(30)]
    rows = [(i, t, "x") for i, t in enumerate([*texts, None, "", " \t "])] + [(None, "ab", "y"), (0, "z", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)
    got = wordpiece.token_counts(docs, vocabulary).collect()
    expected = []
    for i, text, _ in rows:
        counts = [greedy(b" " + w, vocabulary) for w in (text or "").encode().split()]
        expected.append((str(i), len(counts), sum(c or 1 for c in counts), counts.count(0)))
    assert sorted((str(r.doc_id), r.n_words, r.n_tokens, r.n_unknown) for r in got) == sorted(expected)
    assert wordpiece.token_counts(spark.createDataFrame([], docs.schema), vocabulary).count() == 0
