"""Files against the tokenizer on whole texts, and random access."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from prospectra.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Hello, WORLD!! it's 12.5km",
    None,
    "",
    " 　 tabs\tÉcole; éÉ. ÄÖ,x 'S don't ´` “a” ́x \x1c y\xa0z",
    "<|endoftext|> <|STARTOFTEXT|> a<|startoftext|>b İıſ Σς",
    "word, word. word " * 3000,
]


def write(spark, rows, folder, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(3)
    return token_files.write_token_files(docs, PATH, 2, folder=str(folder), **options)


def test_as_the_tokenizer(spark, tmp_path):
    library = Tokenizer.from_file(PATH)
    rows = [(7 - i, text, "x") for i, text in enumerate(TEXTS)] + [(None, "no id", "x"), (40, "b", "x"), (40, "a", "x")]
    files = write(spark, rows, tmp_path / "out", sequence=64)
    got = sorted(token_files.read_documents(files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, *range(2, 8), 40, 40]
    texts = {i: t for i, t, _ in rows}
    start = 0
    for r in got[:-2]:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens) == (start, len(ids)), r
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_random_access_without_copies(spark, tmp_path):
    files = write(spark, [(i, "w " * (i % 50), "x") for i in range(300)], tmp_path / "out", sequence=16, batch=4)
    for file in files.collect():
        shard = token_files.TokenShard(file["folder"], file["name"])
        stream = np.concatenate([ids for _, _, ids in shard.documents()])
        assert len(stream) == file.n_tokens
        n = -(-len(stream) // 16)
        assert sum(shard.file.get_batch(i).num_rows for i in range(shard.file.num_record_batches)) == n
        for number in range(n):
            real = stream[number * 16 : number * 16 + 16]
            ids = shard.ids(number)
            assert not ids.flags.owndata and len(ids) == 16
            assert (ids[: len(real)] == real).all() and not ids[len(real) :].any()
            assert np.unpackbits(shard.mask(number), bitorder="little").sum() == len(real)


def test_limits(spark, tmp_path):
    assert token_files.read_documents(write(spark, [], tmp_path / "none")).count() == 0
    with pytest.raises(ValueError, match="multiple of 8"):
        write(spark, [], tmp_path / "odd", sequence=12)
    with pytest.raises(Exception, match="does not fit"):
        write(spark, [(1, "hello there", "x")], tmp_path / "small", dtype="uint8")
