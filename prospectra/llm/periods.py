"""Periodic runs of words: all maximal repetitions of a text, and the text with each run cut to one period.

A run of period p that is long enough covers a place i of the grid of step `max(p, shortest - p)` whose word
stands again at i + p (the steps of all periods are a harmonic series). From such a place the run is extended both
ways by longest common extensions (LCE) of i and i + p. A difference cover D modulo V holds, for every two places,
a shift below V that brings both into D: at most that many words are compared one by one. From there
the suffixes at sampled places (those in D modulo V) answer: only these are sorted, by doubling blocks of V words, and
a sparse table of minima over the common prefixes of neighbours gives the rest.

Texts are taken many at a time, longest first, with a code of its own behind each, so that no repetition crosses
from one to the next and a period only looks at texts long enough for it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prospectra.llm.batches import slices, text_bytes

#: A perfect difference set; each difference modulo V is that of exactly one pair.
V, COVER = 31, (0, 1, 3, 8, 12, 18)
#: Words of a run, at the least; it also spans its period twice.
SHORTEST = 12
#: Words of the texts that are searched together; a longer text is searched alone.
TOGETHER = 1 << 17

_IN_COVER = np.isin(np.arange(V), COVER)
#: By difference: the member of the cover whose sum with the difference is a member too.
_MEMBER = np.array([next(d for d in COVER if (d + k) % V in COVER) for k in range(V)])


def _common(codes: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Equal words from `a` and `b` on, up to `most`, one by one."""
    equal = np.zeros(len(a), np.int64)
    active = np.flatnonzero(most > 0)
    while len(active):
        x, y = a[active] + equal[active], b[active] + equal[active]
        inside = np.maximum(x, y) < len(codes)
        active, x, y = active[inside], x[inside], y[inside]
        active = active[codes[x] == codes[y]]
        equal[active] += 1
        active = active[equal[active] < most[active]]
    return equal


class SampledSuffixes:
    """The suffixes at places in the cover, sorted, with the common prefixes of neighbours below a table of minima."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        at = np.flatnonzero(_IN_COVER[np.arange(n) % V])
        padded = np.concatenate([codes, np.full(V, -1, codes.dtype)])
        rows = at[np.lexsort([padded[at + k] for k in range(V - 1, -1, -1)])]
        differs = np.zeros(len(at), bool)
        for k in range(V):
            differs[1:] |= padded[rows[1:] + k] != padded[rows[:-1] + k]
        rank = np.full(n + 1, -1, np.int32)  # by place; -1 beyond the end
        rank[rows] = np.cumsum(differs)
        levels, step = [rank], V
        while len(at) and rank[rows[-1]] < len(at) - 1:
            ahead = rank[np.minimum(at + step, n)]
            key = rank[at].astype(np.int64) * (len(at) + 1) + ahead + 1
            order = np.argsort(key, kind="stable")
            rows, key = at[order], key[order]
            rank = np.full(n + 1, -1, np.int32)
            rank[rows] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
            levels.append(rank)
            step *= 2
        a, b = rows[:-1].copy(), rows[1:].copy()
        common = np.zeros(len(a), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            same = np.flatnonzero(np.maximum(a, b) < n)
            same = same[levels[level][a[same]] == levels[level][b[same]]]
            common[same] += V << level
            a[same] += V << level
            b[same] += V << level
        common += _common(codes, a, b, np.full(len(a), V))
        self.rank, self.minima = levels[-1], [common.astype(np.int32)]
        while 2 << (len(self.minima) - 1) <= len(common):
            width, last = 1 << (len(self.minima) - 1), self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words from sampled places `a` and `b` on, which differ."""
        left, right = self.rank[a], self.rank[b]
        low, high = np.minimum(left, right).astype(np.int64), np.maximum(left, right).astype(np.int64)
        level, found = np.frexp(high - low)[1] - 1, np.empty(len(a), np.int64)
        for k in np.unique(level).tolist():
            some, table = level == k, self.minima[k]
            found[some] = np.minimum(table[low[some]], table[high[some] - (1 << k)])
        return found


class Extensions:
    """Longest common extensions to the right of two places of one text; each text ends with a code of its own.

    Suffixes are sampled and sorted for the texts that need it: those with a comparison that gets to a sample.
    """

    def __init__(self, codes: np.ndarray, starts: np.ndarray):
        self.codes, self.starts = codes, starts
        self.sampled = np.zeros(len(starts), bool)

    def _sample(self, texts: np.ndarray) -> None:
        self.sampled[texts] = True
        ends = np.append(self.starts[1:], len(self.codes))
        sizes = np.where(self.sampled, ends - self.starts, 0)
        self.moved = np.cumsum(sizes) - sizes - self.starts
        self.suffixes = SampledSuffixes(self.codes[np.repeat(self.sampled, ends - self.starts)])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        text = np.searchsorted(self.starts, a, side="right") - 1
        if self.sampled.any():
            moved = np.where(self.sampled, self.moved, 0)[text]
        else:
            moved = np.zeros(len(a), np.int64)
        shift = (_MEMBER[(b - a) % V] - a - moved) % V
        found = _common(self.codes, a, b, shift)
        rest = np.flatnonzero(found == shift)
        if not len(rest):
            return found
        if not self.sampled[text[rest]].all():  # the places of samples move with the texts before
            self._sample(np.unique(text[rest]))
            return self.of(a, b)
        found[rest] += self.suffixes.common((a + moved + shift)[rest], (b + moved + shift)[rest])
        return found


def _grid_hits(codes: np.ndarray, lengths: np.ndarray, shortest: int) -> Iterator[tuple[np.ndarray, int]]:
    """Places of the grid, and the period at which their word stands again.

    `lengths` are those of the texts in `codes`, descending, each followed by a code of its own.
    """
    ends = np.cumsum(lengths + 1)
    long_enough = len(lengths)
    for period in range(1, int(lengths[0]) // 2 + 1 if len(lengths) else 0):
        needed = max(shortest, 2 * period)
        while long_enough and lengths[long_enough - 1] < needed:
            long_enough -= 1
        if not long_enough:
            return
        end, step = int(ends[long_enough - 1]), max(period, shortest - period)
        hits = np.flatnonzero(codes[: end - period : step] == codes[period:end:step])
        if len(hits):
            yield hits * step, period


def find_runs(codes: np.ndarray, lengths: np.ndarray, shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of all runs, by start and period; texts as in `_grid_hits`."""
    last, found = len(codes) - 1, []
    ends = np.cumsum(lengths + 1)
    forward = Extensions(codes, ends - lengths - 1)
    backward = Extensions(np.append(codes[-2::-1], -1), len(codes) - ends[::-1])

    def extend(places: list[np.ndarray], periods: list[np.ndarray]) -> None:
        at, period = np.concatenate(places), np.concatenate(periods)
        within = np.searchsorted(ends, at, side="right") == np.searchsorted(ends, at + period, side="right")
        at, period = at[within], period[within]
        ahead = forward.of(at, at + period)
        behind = np.zeros(len(at), np.int64)
        inner = np.flatnonzero(at > 0)
        behind[inner] = backward.of(last - at[inner] - period[inner], last - at[inner])
        kept = ahead + behind >= np.maximum(period, shortest - period)
        start, end = at[kept] - behind[kept], at[kept] + period[kept] + ahead[kept]
        order = np.lexsort([period[kept], end, start])
        start, end, period = start[order], end[order], period[kept][order]
        first = np.ones(len(start), bool)  # the same stretch with a multiple of its period is no other run
        first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        found.append((start[first], end[first], period[first]))

    places, periods, held = [], [], 0
    for at, period in _grid_hits(codes, lengths, shortest):
        places.append(at)
        periods.append(np.full(len(at), period))
        held += len(at)
        if held > 1 << 20:
            extend(places, periods)
            places, periods, held = [], [], 0
    if held:
        extend(places, periods)
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    start, end, period = (np.concatenate(part) for part in zip(*found, strict=True))
    order = np.lexsort([period, end, start])
    start, end, period = start[order], end[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[first], end[first], period[first]
    order = np.lexsort([period, start])
    return start[order], end[order], period[order]


def runs_of(texts: list[list[bytes]], shortest: int = SHORTEST) -> list[np.ndarray]:
    """Per text of words its runs, as rows of start, length and period, by start and period."""
    made = [np.empty((0, 3), np.int64)] * len(texts)
    order = sorted((k for k in range(len(texts)) if len(texts[k]) >= shortest), key=lambda k: -len(texts[k]))
    at = 0
    while at < len(order):
        taken, words = [], 0
        while at < len(order) and (not taken or words + len(texts[order[at]]) <= TOGETHER):
            taken.append(order[at])
            words += len(texts[order[at]])
            at += 1
        lengths = np.array([len(texts[k]) for k in taken], np.int64)
        number, codes = defaultdict(count().__next__), np.empty(words + len(taken), np.int32)
        ends = np.cumsum(lengths + 1)
        for k, end, length in zip(taken, ends.tolist(), lengths.tolist(), strict=True):
            codes[end - 1 - length : end - 1] = np.fromiter(map(number.__getitem__, texts[k]), np.int32, length)
        codes[ends - 1] = -2 - np.arange(len(taken))
        start, end, period = find_runs(codes, lengths, shortest)
        owner = np.searchsorted(ends, start, side="right")
        cuts = np.searchsorted(owner, np.arange(len(taken) + 1))
        starts = ends - lengths - 1
        rows = np.stack([start - starts[owner], end - start, period], axis=1) if len(start) else made[0][:0]
        for j, k in enumerate(taken):
            made[k] = rows[cuts[j] : cuts[j + 1]]
    return made


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


_SCHEMA = "doc_id bigint, text string, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shortest: int = SHORTEST,
    prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """`doc_id`, `text`, `runs`, `collapsed` per row of `docs`.

    Words stand between ASCII white space. `runs` are all stretches of `shortest` words or more that repeat their
    smallest period at least twice and that no neighbouring word extends, by start and period, words numbered
    from 0. `text` and `collapsed` are the words joined by one space, all of them and those that no run holds after
    its first period. `prepare` may replace the words of a text by its id first. Null and empty texts have no words
    and no runs; repeated rows and null ids are rows like others. Other columns of `docs` are not read. A text is
    searched in one task, whatever its length, in memory in proportion to its words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            ids = piece.column(0).to_pylist()
            texts = [text.split() for text in text_bytes(piece.column(1))]
            if prepare is not None:
                texts = [prepare(own, words) for own, words in zip(ids, texts, strict=True)]
            runs = runs_of(texts, shortest)
            every = np.concatenate(runs) if runs else np.empty((0, 3), np.int64)
            values = pa.StructArray.from_arrays([pa.array(every[:, k]) for k in range(3)], fields=list(_RUN))
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
            whole = [b" ".join(words) for words in texts]
            short = [b" ".join(collapsed(words, r)) if len(r) else t for words, r, t in zip(texts, runs, whole, strict=True)]
            columns = [piece.column(0), pa.array(whole, pa.binary()).cast(pa.string())]
            columns += [pa.ListArray.from_arrays(offsets, values), pa.array(short, pa.binary()).cast(pa.string())]
            yield pa.record_batch(columns, ["doc_id", "text", "runs", "collapsed"])

    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, _SCHEMA)
