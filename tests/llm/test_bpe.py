"""Byte-level BPE against the library that the ranks are made for, and round trips."""

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from prospectra.llm import bpe
from prospectra.llm.varints import pack, unpack

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
TEXTS = [
    None,
    "",
    " ",
    "it's  two  spaces\n\n\tand tabs \x1c x\x85y　z ",
    "naïve ÉCOLE 12345 ... <|endoftext|> 日本語テキスト 👩‍👩‍👧 é",
    "the same the same the same" * 500,
    "x" * 30_000 + " " * 5_000,
]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_numbers_survive_packing():
    for numbers in ([], [0], [127, 128, 16383, 16384, 2**21, 2**28 - 1, 2**34, 0]):
        assert unpack(pack(np.array(numbers, np.int64))).tolist() == numbers


@pytest.mark.parametrize("block_bytes", [1, 200, 1 << 26])
def test_as_the_library(spark, library, block_bytes):
    rows = [(i, text, "de") for i, text in enumerate(TEXTS)] + [(None, "a b", "x"), (3, TEXTS[3], "y"), (3, "c", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string").repartition(3)
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, block_bytes=block_bytes)
    got = sorted((str(r.doc_id), list(r.ids), bytes(r.bytes)) for r in bpe.decode(encoded, RANKS).collect())
    expected = [(str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows]
    assert got == sorted(expected)


def test_long_texts_in_portions(monkeypatch):
    import regex

    monkeypatch.setattr(bpe, "LONG_TEXT", 10)
    pattern = regex.compile(public_tokenizers.PATTERN)
    text = TEXTS[3] * 3
    assert sum(bpe.pretokens(text, pattern, portion=4), []) == pattern.findall(text)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.encode(docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: list(r.ids) for r in bpe.encode(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert got == {r.doc_id: library.encode_ordinary(r.text or "") for r in docs.select("doc_id", "text").collect()}


def test_unknown_ids_are_refused(spark):
    rows = spark.createDataFrame([(1, [10**6])], "doc_id bigint, ids array<int>")
    with pytest.raises(Exception, match="no token"):
        bpe.decode(rows, RANKS).collect()
    empty = spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>")
    assert bytes(bpe.decode(empty, RANKS).agg(F.first("bytes")).first()[0]) == b""
