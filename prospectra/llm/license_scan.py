"""License notices: an exact set-similarity join of text blocks (lines) with notice templates.

A block meets a template if it holds at least a share of the template's distinct words. All blocks that do are
found, and only few are compared, by the three filters of prefix joins:

* length: a block must have at least as many template words as the template needs;
* prefix: with the words of both sides in one global order, the rarest first, two sets that share `o` words
  share one within all but the last `o - 1` of each;
* position: words shared so far, and the shorter of what is left of both, must still reach `o`.

Words that are in no template cannot be shared, so a block is reduced to its template words. The order counts
the blocks of the whole table. A notice wrapped over lines is sought in windows of consecutive lines, none of them
without words: the share must be reached by words in a row, no more than the template's over the share. Templates are a parameter; their index is as large as they are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prospectra.llm.batches import slices, text_bytes
from prospectra.sources.scratch import materialize

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: Phrases that name a license, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices as they are put into texts, and their labels.
TEMPLATES = [
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "Lesser General Public License as published by the Free Software Foundation"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the "
     "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("reserved", "Copyright. All rights reserved."),
]
#: What is looked for if nothing else is asked.
NOTICES = [*TEMPLATES, ("reserved", "All rights reserved.")]
#: Share of a template's distinct words that a block must hold.
CONTAINMENT = 0.8


@dataclass(frozen=True)
class Template:
    label: str
    words: frozenset[bytes]
    needed: int
    span: int


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def prepare(templates: list[tuple[str, str]], containment: float) -> list[Template]:
    if not 0 < containment <= 1:
        raise ValueError("containment must be above 0 and at most 1")
    lists = [(label, words_of(text.encode())) for label, text in templates]
    # the least whole number that reaches the share; the margin takes back what 0.8 is too large in binary
    return [
        Template(label, distinct, max(1, math.ceil(containment * len(distinct) - 1e-9)), math.ceil(len(words) / containment))
        for label, words in lists
        if (distinct := frozenset(words))
    ]


def _places(words: bytes, phrase: bytes) -> list[int]:
    """Places of a phrase in words that are each framed by spaces: the number of its first word."""
    found, sought, at = [], b" " + phrase + b" ", words.find(b" " + phrase + b" ")
    while at >= 0:
        found.append(words.count(b" ", 0, at))
        at = words.find(sought, at + 1)
    return found


_SCAN = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, "
    "blocks array<struct<block: bigint, lines: bigint, start: bigint, words: array<int>, span: array<int>>>"
)
_SCAN_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.list_(pa.string())),
        (
            "blocks",
            pa.list_(
                pa.struct(
                    [
                        ("block", pa.int64()),
                        ("lines", pa.int64()),
                        ("start", pa.int64()),
                        ("words", pa.list_(pa.int32())),
                        ("span", pa.list_(pa.int32())),
                    ]
                )
            ),
        ),
    ]
)
_MATCHES_TYPE = "array<struct<block: bigint, start: bigint, template: int, label: string, containment: double>>"
_WRAPPED_TYPE = _MATCHES_TYPE.replace("block: bigint", "block: bigint, lines: bigint")
_MATCH = pa.struct(
    [
        ("block", pa.int64()),
        ("start", pa.int64()),
        ("template", pa.int32()),
        ("label", pa.string()),
        ("containment", pa.float64()),
    ]
)


_WRAPPED = pa.struct([_MATCH.field(0), ("lines", pa.int64()), *(_MATCH.field(i) for i in range(1, 5))])


def _windows(recent: list[tuple], block: int, head: list[int], least: int) -> Iterator[dict]:
    """Windows of lines that end with a line, and may meet a template better than with a line less at either end.

    Words are numbers, -1 for those of no template. `recent` has the lines before: number, first word, words and
    last words.
    """
    last = set(head) - {-1}
    between, span = set(), head
    for first, start, words, tail in reversed(recent):
        own = set(tail) - {-1}
        # The words in a row that meet a template hold all of the lines between, and a part of the first and the last
        # line. Either is needed only if it has a template word that the lines between lack.
        if not last <= between and not own <= between and len(found := own | between | last) >= least:
            yield {"block": first, "lines": block - first + 1, "start": start, "words": sorted(found), "span": tail + span}
        between.update(words)
        between.discard(-1)
        span = words + span


def _scan_text(text: bytes, phrases: dict[bytes, str], number: dict[bytes, int], least: int, reach: int = 0) -> dict:
    """Counts and phrases of a text, and its lines that have enough template words for some template.

    Windows of lines as well, of `reach` words of the first and the last line and of fewer between them.
    """
    recent: list[tuple] = []
    n, places, labels, blocks, tail = 0, [], set(), [], b" "
    longest = max((phrase.count(b" ") for phrase in phrases), default=0)
    for i, line in enumerate(text.lower().split(b"\n")):
        words = _WORD.findall(line)
        if not words:
            recent = []
            continue
        known = number.keys() & set(words)
        if len(known) >= least:
            blocks.append({"block": i, "lines": 1, "start": n, "words": sorted(number[word] for word in known)})
        if reach:
            head, end = ([number.get(word, -1) for word in part] for part in (words[:reach], words[-reach:]))
            if known and recent:
                blocks += _windows(recent, i, head, least)
            recent.append((i, n, head, end))
            while sum(len(some) for _, _, some, _ in recent[1:]) >= reach:
                del recent[0]
        # phrases may run over line ends: the last words of the lines before are looked at again
        before = tail.count(b" ") - 1
        joined = tail + b" ".join(words) + b" "
        for phrase, label in phrases.items():
            if b" " + phrase + b" " in joined:
                found = [n - before + at for at in _places(joined, phrase) if at + phrase.count(b" ") >= before]
                places += found
                if found:
                    labels.add(label)
        n += len(words)
        tail = b" " + b"".join(word + b" " for word in joined.rsplit(None, longest)[-longest:]) if longest else b" "
    return {
        "n_words": n,
        "n_base": len(places),
        "first_word": min(places, default=None),
        "last_word": max(places, default=None),
        "base_labels": sorted(labels),
        "blocks": blocks,
    }


class PrefixIndex:
    """Templates by the words of their prefixes, in the global order."""

    def __init__(self, templates: list[Template], number: dict[bytes, int], frequency: dict[int, int]):
        order = sorted(number.values(), key=lambda word: (frequency.get(word, 0), word))
        self.rank = {word: place for place, word in enumerate(order)}
        self.templates = templates
        self.sets = [frozenset(number[word] for word in t.words) for t in templates]
        self.by_word: dict[int, list[tuple[int, int]]] = {}
        for t, (template, words) in enumerate(zip(templates, self.sets, strict=True)):
            for place, word in enumerate(sorted(words, key=self.rank.__getitem__)[: len(words) - template.needed + 1]):
                self.by_word.setdefault(word, []).append((t, place))

    def matches(self, block: list[int]) -> Iterator[tuple[int, float]]:
        """Templates that the block meets, and the share of their words it holds."""
        shared: dict[int, int] = {}
        ordered = sorted(block, key=self.rank.__getitem__)
        for j, word in enumerate(ordered):
            for t, i in self.by_word.get(word, ()):
                needed, size = self.templates[t].needed, len(self.sets[t])
                if len(ordered) < needed or j > len(ordered) - needed:
                    continue
                so_far = shared.get(t, 0)
                if so_far >= 0:
                    reachable = so_far + 1 + min(size - i - 1, len(ordered) - j - 1)
                    shared[t] = so_far + 1 if reachable >= needed else -1
        for t, found in shared.items():
            if found > 0 and (both := len(self.sets[t].intersection(ordered))) >= self.templates[t].needed:
                yield t, both / len(self.sets[t])


def _most(span: list[int], words: frozenset[int], size: int) -> int:
    """The most distinct ones of some words that stand within `size` words in a row."""
    counts: dict[int, int] = {}
    most = 0
    for i, word in enumerate(span):
        if word in words:
            counts[word] = counts.get(word, 0) + 1
            most = max(most, len(counts))
        if i + 1 >= size and (out := span[i + 1 - size]) in words:
            counts[out] -= 1
            if not counts[out]:
                del counts[out]
    return most


def _unwrapped(found: list[dict], lines: list[dict]) -> list[dict]:
    """The best windows of each template that hold no line which meets it, none over another."""
    taken = [(m["template"], m["block"], m["block"]) for m in lines]
    best = []
    for m in sorted(found, key=lambda m: (-m["containment"], m["lines"], m["block"])):
        last = m["block"] + m["lines"] - 1
        if not any(t == m["template"] and first <= last and m["block"] <= end for t, first, end in taken):
            taken.append((m["template"], m["block"], last))
            best.append(m)
    return sorted(best, key=lambda m: (m["block"], m["template"]))


def scan(
    docs: DataFrame,
    templates: list[tuple[str, str]] | None = None,
    phrases: dict[str, str] | None = None,
    containment: float = CONTAINMENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`doc_id`, `n_words`, `n_base`, `first_word`, `last_word`, `base_labels`, `matches`, `wrapped` of every row.

    `matches` are the lines that meet a template: number of the line and of its first word, template, label and
    share of the template's words. `wrapped` are the notices that only a window of lines meets: with its first line
    and number of lines, the best windows that do not overlap one another or a line of `matches`. Words are counted from 0 over the whole text. Null and empty texts have no
    words and no matches; `first_word` and `last_word` are null without a phrase. Repeated and null ids stay
    rows of their own; other columns of `docs` are not read; an empty table gives no rows.
    """
    prepared = prepare(NOTICES if templates is None else templates, containment)
    sought = {p.lower().encode(): label for p, label in (PHRASES if phrases is None else phrases).items()}
    number = {word: i for i, word in enumerate(sorted(frozenset().union(*(t.words for t in prepared))))}
    least = min((t.needed for t in prepared), default=math.inf)
    reach = max((t.span for t in prepared), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            rows = zip(piece.column(0).to_pylist(), text_bytes(piece.column(1)), strict=True)
            found = [{"doc_id": i, **_scan_text(text, sought, number, least, reach)} for i, text in rows]
            yield pa.RecordBatch.from_pylist(found, schema=_SCAN_SCHEMA)

    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    scanned = materialize(chosen.mapInArrow(run, _SCAN), "license_blocks")
    words = scanned.select(F.explode(F.flatten("blocks.words")).alias("word"))
    index = PrefixIndex(prepared, number, dict(map(tuple, words.groupBy("word").count().collect())))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            matches, wrapped = [], []
            for blocks in piece.column(6).to_pylist():
                lines, windows = [], []
                for b in blocks:
                    for t, share in index.matches(b["words"]):
                        m = {**b, "template": t, "label": prepared[t].label, "containment": share}
                        if b["lines"] == 1:
                            lines.append(m)
                        elif (most := _most(b["span"], index.sets[t], prepared[t].span)) >= prepared[t].needed:
                            windows.append({**m, "containment": most / len(index.sets[t])})
                matches.append([{name: m[name] for name in _MATCH.names} for m in lines])
                wrapped.append([{name: m[name] for name in _WRAPPED.names} for m in _unwrapped(windows, lines)])
            columns = [*piece.columns[:6], pa.array(matches, pa.list_(_MATCH)), pa.array(wrapped, pa.list_(_WRAPPED))]
            yield pa.record_batch(columns, [*_SCAN_SCHEMA.names[:6], "matches", "wrapped"])

    schema = _SCAN[: _SCAN.index("blocks")] + f"matches {_MATCHES_TYPE}, wrapped {_WRAPPED_TYPE}"
    return scanned.mapInArrow(join, schema)
