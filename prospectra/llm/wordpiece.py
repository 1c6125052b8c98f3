"""Token counts by greedy longest match, in one pass over the bytes of a word.

The vocabulary is a trie. A node from which the next byte leads nowhere has a failure link: where matching goes
on after the longest pieces that the bytes so far are sure to give have been popped, and how many pieces those
are. So a word is counted without being cut and without looking at a byte twice; no piece is built.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prospectra.llm.batches import slices, text_bytes, word_chunks

#: Words whose counts a task remembers; beyond that it starts over.
REMEMBERED = 1 << 19


class LongestMatch:
    """Trie of the vocabulary with failure links and the number of pieces that each link pops."""

    def __init__(self, vocabulary: Iterable[bytes]):
        self.child: dict[int, int] = {}
        terminal, parents = [False], [(0, 0)]
        for piece in vocabulary:
            node = 0
            for byte in piece:
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(terminal)
                    terminal.append(False)
                    parents.append((node, byte))
                node = self.child[key]
            terminal[node] = bool(piece)
        below: list[list[int]] = [[] for _ in terminal]
        for node, (parent, _) in enumerate(parents[1:], 1):
            below[parent].append(node)
        self.link: list[int] = [-1] * len(terminal)  # -1: no way on
        self.pops = [0] * len(terminal)
        waiting = deque(below[0])
        while waiting:
            node = waiting.popleft()
            waiting.extend(below[node])
            if terminal[node]:
                self.link[node], self.pops[node] = 0, 1
                continue
            parent, byte = parents[node]
            at, popped = self.link[parent], self.pops[parent]
            while at >= 0 and at << 8 | byte not in self.child:
                popped += self.pops[at]
                at = self.link[at]
            if at >= 0:
                self.link[node], self.pops[node] = self.child[at << 8 | byte], popped

    def count(self, word: bytes) -> int:
        """Number of pieces of greedy longest match; 0 if the word cannot be cut into pieces."""
        child, link, pops = self.child, self.link, self.pops
        node, found = 0, 0
        for byte in word:
            while (following := child.get(node << 8 | byte)) is None:
                found += pops[node]
                node = link[node]
                if node < 0:
                    return 0
            node = following
        while node:
            found += pops[node]
            node = link[node]
            if node < 0:
                return 0
        return found


def token_counts(
    docs: DataFrame, vocabulary: Iterable[bytes], before: bytes = b" ", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id`, `n_words`, `n_tokens`, `n_unknown` of every row.

    Words stand between ASCII white space; `before` is put in front of each, so that pieces that begin with it
    only match at the start of a word. A word that cannot be cut into pieces is one unknown token. Null and
    empty texts have no words; repeated and null ids stay rows of their own; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(LongestMatch(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared.value.count

        class Counts(dict):
            def __missing__(self, word: bytes) -> int:
                if len(self) >= REMEMBERED:
                    self.clear()
                pieces = self[word] = count(before + word)
                return pieces

        counts = Counts()
        for piece in slices(batches):
            words, tokens, unknown = [], [], []
            for text in text_bytes(piece.column(1)):
                n = found = none = 0
                for chunk in word_chunks(text):
                    own = list(map(counts.__getitem__, chunk))
                    n, found, none = n + len(own), found + sum(own), none + own.count(0)
                words.append(n)
                tokens.append(found + none)
                unknown.append(none)
            columns = [piece.column(0), *(pa.array(c, pa.int64()) for c in (words, tokens, unknown))]
            yield pa.record_batch(columns, ["doc_id", "n_words", "n_tokens", "n_unknown"])

    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "doc_id bigint, n_words bigint, n_tokens bigint, n_unknown bigint")
