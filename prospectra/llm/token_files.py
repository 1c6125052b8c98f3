"""Token ids in Arrow files: fixed-size-list batches for random access without copying.

Documents are dealt to files by ranges of their id and written in that order. A file is the stream of its
documents' ids cut into sequences of equal length, all batches but the last of the same size; the last sequence
is filled up. Beside the ids stands a mask, one bit per place, 0 where the sequence is filled up. A second file
tells where in the stream each document starts. Both are uncompressed Arrow IPC files, so a reader that maps
them into memory finds any sequence by its number, without reading or copying the others.

A task writes under a name of its own and renames the file when it is complete: a retried or doubled task
replaces a file by the same one.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prospectra.llm.batches import slices, text_bytes
from prospectra.llm.shared_files import file_system
from prospectra.sources.scratch import materialize, new_scratch_path

#: Ids of a sequence, and sequences of a batch.
SEQUENCE, BATCH = 2048, 256
#: Distinct words a worker remembers the ids of; beyond that it starts over.
REMEMBERED = 600_000

#: Letters, then punctuation: two parts that a splitter by letters encodes apart.
_LETTERS_THEN_MARKS = re.compile(rb"((?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([,.;:!?]+)")


class WordEncoder:
    """A tokenizer that drops white space and case, run once per distinct word.

    White space is all that separates words, so the ids of a text are those of its words in a row. Texts in
    which a special token may stand keep their case, because special tokens are matched before case is dropped.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}

    def _learn(self, words: set[bytes]) -> None:
        parts = {word: match.groups() for word in words if (match := _LETTERS_THEN_MARKS.fullmatch(word))}
        new = [w for w in {p for pair in parts.values() for p in pair} | (words - parts.keys()) if w not in self.known]
        encodings = self.tokenizer.encode_batch_fast([word.decode() for word in new], add_special_tokens=False)
        for word, encoding in zip(new, encodings, strict=True):
            self.known[word] = np.array(encoding.ids, "<u4").tobytes()
        for word, (letters, marks) in parts.items():
            self.known[word] = self.known[letters] + self.known[marks]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        split = [(text if b"<|" in text else text.lower()).split() for text in texts]
        if unknown := set().union(*split).difference(self.known):
            self._learn(unknown)
        return [np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<u4") for words in split]


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """One per worker: what it has learned serves the next tasks as well."""
    return WordEncoder(path)


class _Writer:
    """One shard: `<name>.arrow` with the sequences and `<name>.docs.arrow` with the starts of documents."""

    def __init__(self, folder: str, name: str, dtype: str, sequence: int, batch: int):
        self.fs, self.folder = file_system(folder)
        self.names = [f"{name}.arrow", f"{name}.docs.arrow"]
        self.drafts = [f"{self.folder}/_{uuid.uuid4().hex}-{part}" for part in self.names]
        self.dtype, self.sequence, self.batch, self.written = np.dtype(dtype), sequence, batch, 0
        value = pa.from_numpy_dtype(self.dtype)
        self.schema = pa.schema(
            [("input_ids", pa.list_(value, sequence)), ("mask", pa.list_(pa.uint8(), sequence // 8))]
        )
        self.index_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.sinks = [self.fs.open_output_stream(draft) for draft in self.drafts]
        self.files = [
            pa.ipc.new_file(sink, schema) for sink, schema in zip(self.sinks, (self.schema, self.index_schema), strict=True)
        ]
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0

    def add(self, doc_ids: list[int | None], tokens: list[np.ndarray]) -> None:
        sizes = np.array([len(ids) for ids in tokens], np.int64)
        starts = self.written + self.n_waiting + np.cumsum(sizes) - sizes
        index = [pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(sizes)]
        self.files[1].write_batch(pa.record_batch(index, schema=self.index_schema))
        self.waiting += tokens
        self.n_waiting += int(sizes.sum())
        if self.n_waiting >= self.sequence * self.batch:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        stream = np.concatenate([np.empty(0, self.dtype), *(ids.astype(self.dtype) for ids in self.waiting)])
        whole = -(-len(stream) // self.sequence) if last else len(stream) // (self.sequence * self.batch) * self.batch
        used = min(len(stream), whole * self.sequence)
        for start in range(0, whole, self.batch):
            n = min(self.batch, whole - start)
            ids = np.zeros(n * self.sequence, self.dtype)
            real = stream[start * self.sequence : (start + n) * self.sequence]
            ids[: len(real)] = real
            mask = np.packbits(np.arange(len(ids)) < len(real), bitorder="little")
            columns = [
                pa.FixedSizeListArray.from_arrays(pa.array(ids), type=self.schema.field(0).type),
                pa.FixedSizeListArray.from_arrays(pa.array(mask), type=self.schema.field(1).type),
            ]
            self.files[0].write_batch(pa.record_batch(columns, schema=self.schema))
        self.written += used
        self.waiting, self.n_waiting = [stream[used:]], len(stream) - used

    def close(self) -> int:
        """Completes both files and gives them their names; the number of ids."""
        self._flush(True)
        for file, sink, draft, name in zip(self.files, self.sinks, self.drafts, self.names, strict=True):
            file.close()
            sink.close()
            self.fs.move(draft, f"{self.folder}/{name}")
        return self.written


class TokenShard:
    """A written shard. Sequences and masks are views of the mapped file where that is local."""

    def __init__(self, folder: str, name: str):
        fs, path = file_system(folder)

        def opened(file: str) -> pa.ipc.RecordBatchFileReader:
            local = isinstance(fs, pafs.LocalFileSystem)
            return pa.ipc.open_file(pa.memory_map(f"{path}/{file}") if local else fs.open_input_file(f"{path}/{file}"))

        self.file, self.index = opened(f"{name}.arrow"), opened(f"{name}.docs.arrow")
        self.sequence = self.file.schema.field(0).type.list_size
        self.batch = self.file.get_batch(0).num_rows  # of all batches but the last

    def _batch_values(self, batch: int, column: int) -> np.ndarray:
        array = self.file.get_batch(batch).column(column)
        return array.flatten().to_numpy(zero_copy_only=True).reshape(len(array), -1)

    def ids(self, number: int) -> np.ndarray:
        return self._located(number, 0)

    def mask(self, number: int) -> np.ndarray:
        """Bits of the sequence, one byte for eight places, the first place lowest."""
        return self._located(number, 1)

    def _located(self, number: int, column: int) -> np.ndarray:
        return self._batch_values(number // self.batch, column)[number % self.batch]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """`doc_id`, start in the shard's stream and ids of every document, in order; one batch at a time."""
        batch, first, values = -1, 0, np.empty(0, np.int64)
        for i in range(self.index.num_record_batches):
            rows = self.index.get_batch(i)
            for doc_id, start, n in zip(*(rows.column(c).to_pylist() for c in range(3)), strict=True):
                parts, at = [], start
                while True:
                    if at >= first + values.size and batch + 1 < self.file.num_record_batches:
                        first, batch = first + values.size, batch + 1
                        values = self._batch_values(batch, 0).reshape(-1)
                        continue
                    part = values[at - first : start + n - first]
                    parts.append(part)
                    at += len(part)
                    if at >= start + n or not len(part):
                        break
                yield doc_id, start, parts[0] if len(parts) == 1 else np.concatenate(parts)


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = SEQUENCE,
    dtype: str = "uint16",
    batch: int = BATCH,
) -> DataFrame:
    """Writes the files and returns their list: `shard`, `folder`, `name`, `n_tokens`, `n_docs`, `base`.

    `base` is the number of ids in the shards before. `dtype` must hold all ids. The tokenizer must drop case
    and white space (see `WordEncoder`). Documents stand in ascending order of id, null ids first, rows of equal
    ids in an order given by their texts; null texts are empty and only have the end id. Other columns are not
    read; an empty table gives no files. Without `folder`, a new one below the session's shared folder is used.
    """
    spark = docs.sparkSession
    if sequence % 8:
        raise ValueError("the length of a sequence must be a multiple of 8")
    folder = folder or new_scratch_path(spark, "tokens")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    dealt = chosen.repartitionByRange(files, *order).sortWithinPartitions(*order, "text")
    limit = np.iinfo(dtype).max

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, writer, n_docs, encoder = TaskContext.get().partitionId(), None, 0, _encoder(tokenizer_path)
        end = np.array([end_id], "<u4")
        for piece in slices(batches):
            if writer is None:
                file_system(folder)[0].create_dir(file_system(folder)[1])
                writer = _Writer(folder, f"shard-{shard:06d}", dtype, sequence, batch)
            tokens = [np.append(ids, end) for ids in encoder.encode(text_bytes(piece.column(1)))]
            if max(int(ids.max()) for ids in tokens) > limit:
                raise ValueError(f"an id does not fit {dtype}")
            writer.add(piece.column(0).to_pylist(), tokens)
            n_docs += len(tokens)
        if writer is not None:
            n_tokens = writer.close()
            row = {"shard": shard, "folder": folder, "name": f"shard-{shard:06d}", "n_tokens": n_tokens, "n_docs": n_docs}
            yield pa.RecordBatch.from_pylist([row], schema=fields)

    fields = pa.schema(
        [("shard", pa.int64()), ("folder", pa.string()), ("name", pa.string()), ("n_tokens", pa.int64()), ("n_docs", pa.int64())]
    )
    schema = "shard bigint, folder string, name string, n_tokens bigint, n_docs bigint"
    listed = materialize(dealt.mapInArrow(write, schema), "token_files")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return listed.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_documents(files: DataFrame) -> DataFrame:
    """`doc_id`, `start` (ids of all documents before), `n_tokens`, `ids_crc32` of every document in the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                rows = []
                for doc_id, start, ids in TokenShard(file["folder"], file["name"]).documents():
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append({"doc_id": doc_id, "start": file["base"] + start, "n_tokens": len(ids), "ids_crc32": crc})
                    if len(rows) == 8192:
                        yield pa.RecordBatch.from_pylist(rows, schema=fields)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=fields)

    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    fields = pa.schema([(name, pa.int64()) for name in names])
    dealt = files.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard")
    return dealt.mapInArrow(read, ", ".join(f"{name} bigint" for name in names))
