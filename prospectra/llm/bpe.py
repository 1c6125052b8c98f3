"""Byte-level BPE by a global shuffle of distinct words, and its decoding by the table of token bytes.

1. Texts are split by the pattern. A task numbers the distinct pre-tokens of a block of documents by their
   frequency in it; a document becomes the numbers of its pre-tokens, in order. Blocks are closed at a size.
2. The distinct words of all blocks are dealt by hash, so that all places of a word meet in one task, which
   encodes it once. A block sends the words of a hash bucket as one packed row, not as a row each.
3. The ids go back to the blocks as a dictionary file each, with which a task replaces the pre-tokens of the
   block's documents by position. The documents are not shuffled.

The blocks are a written table: numbering is done once, whatever is retried later.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prospectra.llm.batches import slices, text_bytes
from prospectra.llm.shared_files import file_system
from prospectra.llm.varints import pack, ranges, unpack
from prospectra.sources.scratch import materialize, new_scratch_path

#: Bytes of text after which a block of documents is closed.
BLOCK_BYTES = 16 << 20
#: Characters of a text beyond which its pre-tokens are taken in portions.
LONG_TEXT = 4 << 20
#: Words a task remembers while it encodes a bucket; beyond that it starts over.
REMEMBERED = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Bytes and rank of each token: a line of base64, a space and the rank each."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def pretokens(text: str, pattern: regex.Pattern, portion: int = 1 << 18) -> Iterator[list[str]]:
    """The matches of the pattern, as lists of a bounded length."""
    if len(text) <= LONG_TEXT:
        yield pattern.findall(text)
        return
    matches = pattern.finditer(text)
    while words := [match.group() for match in islice(matches, portion)]:
        yield words


class _Block:
    """Documents and numbered distinct words that a task has gathered."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.ids: list[int | None] = []
        self.docs: list[np.ndarray] = []
        self.bytes = 0

    def add(self, doc_id: int | None, text: bytes, pattern: regex.Pattern) -> None:
        number, parts = self.number, []
        for words in pretokens(text.decode(), pattern):
            parts.append(np.array([number.setdefault(w, len(number)) for w in words], np.uint32))
        self.ids.append(doc_id)
        self.docs.append(np.concatenate(parts) if parts else np.empty(0, np.uint32))
        self.bytes += len(text)

    def rows(self, block: int, buckets: int) -> Iterator[dict]:
        """A row per document, then a row per bucket that has words; words are renumbered by frequency."""
        counts = np.zeros(len(self.number), np.int64)
        for doc in self.docs:
            counts += np.bincount(doc, minlength=len(counts))
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        for doc_id, doc in zip(self.ids, self.docs, strict=True):
            yield {"block": block, "doc_id": doc_id, "places": pack(rank[doc])}
        words = [word.encode() for word in self.number]
        bucket = np.fromiter((zlib.crc32(word) % buckets for word in words), np.int64, len(words))
        by_bucket = order[np.argsort(bucket[order], kind="stable")]
        ends = np.flatnonzero(np.diff(bucket[by_bucket], append=-1)) + 1
        compress = zstandard.ZstdCompressor(3).compress
        for start, end in zip([0, *ends[:-1]], ends, strict=True):
            part = by_bucket[start:end]
            chosen = [words[i] for i in part]
            yield {
                "block": block,
                "bucket": int(bucket[part[0]]),
                "numbers": pack(np.diff(rank[part], prepend=0)),
                "lengths": pack(np.fromiter(map(len, chosen), np.int64, len(chosen))),
                "words": compress(b"".join(chosen)),
            }


_BLOCKS = "block bigint, doc_id bigint, places binary, bucket int, numbers binary, lengths binary, words binary"
_FIELDS = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_id", pa.int64()),
        ("places", pa.binary()),
        ("bucket", pa.int32()),
        ("numbers", pa.binary()),
        ("lengths", pa.binary()),
        ("words", pa.binary()),
    ]
)


def _blocks(docs: DataFrame, pattern: str, buckets: int, block_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        first, closed, block = TaskContext.get().partitionId() << 32, 0, _Block()

        def written() -> Iterator[pa.RecordBatch]:
            rows = block.rows(first + closed, buckets)
            while some := list(islice(rows, 1024)):
                yield pa.RecordBatch.from_pylist(some, schema=_FIELDS)

        for piece in slices(batches):
            for doc_id, text in zip(piece.column(0).to_pylist(), text_bytes(piece.column(1)), strict=True):
                block.add(doc_id, text, compiled)
                if block.bytes >= block_bytes:
                    yield from written()
                    closed, block = closed + 1, _Block()
        if block.docs:
            yield from written()

    return docs.mapInArrow(run, _BLOCKS)


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    finish: tuple[Callable[[pa.RecordBatch], pa.RecordBatch], str] | None = None,
) -> DataFrame:
    """`doc_id`, `ids` (array<int>) of every row, as the ranks' own library encodes ordinary text.

    `finish` is a function of such batches and the schema of what it makes of them; it runs in the task that
    has the ids, so that they need not travel to another worker.

    A null or empty text has no ids. Repeated ids and null ids stay rows of their own; other columns of `docs`
    are not read; an empty table gives no rows. A single text is never split between tasks.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(ranks)
    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    blocks = materialize(_blocks(chosen, pattern, buckets, block_bytes), "bpe_blocks")

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=shared.value, special_tokens={})
        known: dict[bytes, list[int]] = {}
        for piece in slices(batches, 64):
            columns = [piece.column(name).to_pylist() for name in ("block", "numbers", "lengths", "words")]
            sizes, found = [], []
            for lengths, packed in zip(columns[2], columns[3], strict=True):
                joined = zstandard.ZstdDecompressor().decompress(packed)
                ends = np.cumsum(unpack(lengths)).tolist()
                ids: list[int] = []
                size = []
                for start, end in zip([0, *ends], ends, strict=False):
                    word = joined[start:end]
                    own = known.get(word)
                    if own is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        own = known[word] = whole.encode_ordinary(word.decode())
                    ids += own
                    size.append(len(own))
                sizes.append(pack(np.array(size, np.int64)))
                found.append(pack(np.array(ids, np.int64)))
            yield pa.record_batch(
                [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in (columns[1], sizes, found))],
                ["block", "numbers", "sizes", "ids"],
            )

    words = blocks.where("words IS NOT NULL").select("block", "bucket", "numbers", "lengths", "words")
    dictionary = words.repartition(buckets, "bucket").mapInArrow(
        encode_words, "block bigint, numbers binary, sizes binary, ids binary"
    )
    folder = new_scratch_path(spark, "bpe_dictionaries")
    dictionary.repartition(buckets, "block").sortWithinPartitions("block").write.partitionBy("block").parquet(folder)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known = None, None
        for piece in slices(batches, 64):
            out = []
            for block, places in zip(piece.column(0).to_pylist(), piece.column(2).to_pylist(), strict=True):
                if block != current:
                    current, known = block, _Dictionary(folder, block)
                out.append(known.ids_of(unpack(places)))
            offsets = pa.array(np.cumsum([0, *map(len, out)]).astype(np.int32))
            ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(out)))
            yield last(pa.record_batch([piece.column(1), ids], ["doc_id", "ids"]))

    last, schema = finish or (lambda batch: batch, "doc_id bigint, ids array<int>")
    places = blocks.where("places IS NOT NULL").select("block", "doc_id", "places")
    return places.mapInArrow(replace, schema)


class _Dictionary:
    """Ids of a block's words by number, read from the shared folder."""

    def __init__(self, folder: str, block: int):
        fs, path = file_system(f"{folder}/block={block}")
        parts: list[list[np.ndarray]] = [[], [], []]
        for info in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
            if info.path.endswith(".parquet"):
                table = pq.read_table(info.path, filesystem=fs, columns=["numbers", "sizes", "ids"], partitioning=None)
                for i in range(3):
                    parts[i] += [unpack(value) for value in table.column(i).to_pylist()]
        empty = np.empty(0, np.int64)
        numbers = np.concatenate([empty, *map(np.cumsum, parts[0])])
        sizes = np.concatenate([empty, *parts[1]])
        self.ids = np.concatenate([empty, *parts[2]]).astype(np.int32)
        self.start, self.size = np.empty(len(numbers), np.int64), np.empty(len(numbers), np.int64)
        self.start[numbers], self.size[numbers] = np.cumsum(sizes) - sizes, sizes

    def ids_of(self, words: np.ndarray) -> np.ndarray:
        return self.ids[ranges(self.start[words], self.size[words])]


def decoder(spark: SparkSession, ranks: dict[bytes, int]) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """A function of batches of `doc_id` and `ids` that adds `bytes`, joining the ids with their tokens' bytes.

    The table of token bytes is broadcast: it has a row per token of the vocabulary.
    """
    size = max(ranks.values(), default=-1) + 1
    lengths = np.full(size, -1, np.int64)
    by_id = [b""] * size
    for token, rank in ranks.items():
        lengths[rank], by_id[rank] = len(token), token
    shared = spark.sparkContext.broadcast((lengths, b"".join(by_id)))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        length, joined = shared.value
        flat, start = np.frombuffer(joined, np.uint8), np.cumsum(np.maximum(length, 0)) - np.maximum(length, 0)
        texts = []
        for ids in batch.column(1):
            own = np.asarray(ids.values, np.int64) if ids.is_valid else np.empty(0, np.int64)
            if len(own) and (own.min() < 0 or own.max() >= len(length) or (length[own] < 0).any()):
                raise ValueError("an id has no token")
            texts.append(flat[ranges(start[own], length[own])].tobytes())
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.binary())]
        return pa.record_batch(columns, ["doc_id", "ids", "bytes"])

    return run


#: What `decoder` makes of its batches.
DECODED = "doc_id bigint, ids array<int>, bytes binary"


def decode(encoded: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """`doc_id`, `ids`, `bytes` (binary) of every row: the bytes of its tokens, in order.

    A null list counts as empty; an id without token is an error.
    """
    run = decoder(encoded.sparkSession, ranks)
    chosen = encoded.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).alias("ids"))
    return chosen.mapInArrow(lambda batches: map(run, slices(batches, 64)), DECODED)
