"""Documents as Arrow batches inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa

_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of a few rows: Python objects exist for one piece at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes per row; a null text is empty."""
    return [b"" if text is None else text for text in column.cast(pa.binary()).to_pylist()]


def word_chunks(text: bytes, step: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words between ASCII white space, in lists that cover about `step` bytes of the text each."""
    start = 0
    while start < len(text):
        cut = len(text)
        if cut - start > step and (space := _SPACE.search(text, start + step)):
            cut = space.start()
        yield text[start:cut].split()
        start = cut
