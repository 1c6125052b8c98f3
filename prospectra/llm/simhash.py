"""Near-duplicates by SimHash, linked through a vantage-point tree over the distinct fingerprints.

The top of the tree is laid out on a bounded sample of fingerprints. A node sends a fingerprint to its
inner child if its Hamming distance to the vantage point is at most the node's radius, else to the outer
one. Two fingerprints at most `r` bits apart differ by at most `r` in that distance (triangle inequality),
so an inner fingerprint less than `r` inside the radius is copied to the outer child as well, and every
pair to be linked meets in at least one leaf. Leaves are the shards; each goes on with the same tree in its
task. A shard only reports a spanning set of links, never all pairs of a group, and shards beyond a size are
cut into chunks that are compared two at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prospectra.llm.batches import slices, text_bytes, word_chunks
from prospectra.sources.scratch import materialize

#: Fingerprints that lay out the top of the tree; the driver holds 8 bytes of each.
SAMPLE = 65_536
#: Fingerprints a shard should own, without the copies of its border.
SHARD = 8_192
#: Fingerprints of a shard, copies included, beyond which it is cut into chunks.
CHUNK = 65_536
#: Fingerprints compared with one another, in strips that stay in a core's cache.
LEAF, STRIP = 1_024, 64
_SEED = 42


def simhash(text: bytes, words_per_shingle: int) -> int:
    """Signed 64-bit fingerprint of the lower-cased words; 0 without words."""
    ones, total, tail = np.zeros(64, np.int64), 0, []
    digest, n = xxhash.xxh64_digest, words_per_shingle
    for chunk in word_chunks(text.lower()):
        words = tail + chunk
        if len(words) >= n:
            shingles = map(b" ".join, zip(*(words[k:] for k in range(n)), strict=False))
            hashes = np.frombuffer(b"".join([digest(s, _SEED) for s in shingles]), np.uint8).reshape(-1, 8)
            ones += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
            total += len(hashes)
        tail = words[max(0, len(words) - n + 1) :]
    if not total:
        return int.from_bytes(digest(b" ".join(tail), _SEED), "big", signed=True) if tail else 0
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 4
) -> DataFrame:
    """`doc_id`, `fingerprint` (bigint) of every row; null texts count as empty, whose fingerprint is 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            marks = [simhash(text, words_per_shingle) for text in text_bytes(piece.column(1))]
            yield pa.record_batch([piece.column(0), pa.array(marks, pa.int64())], ["doc_id", "fingerprint"])

    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "doc_id bigint, fingerprint bigint")


def hex_fingerprint(column: Column) -> Column:
    return F.lpad(F.lower(F.hex(column)), 16, "0")


class VantageTree:
    """Complete binary tree: vantage point and radius of each inner node, in breadth-first order."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.points = np.zeros(2**depth - 1, np.uint64)
        self.radii = np.full(2**depth - 1, 32, np.int64)
        parts = {0: sample}
        for node in range(len(self.points)):
            part = parts.pop(node)
            if len(part):
                self.points[node] = part[len(part) // 2]
            distance = np.bitwise_count(part ^ self.points[node]).astype(np.int64)
            if len(part):
                self.radii[node] = int(np.median(distance))
            parts[2 * node + 1] = part[distance <= self.radii[node]]
            parts[2 * node + 2] = part[distance > self.radii[node]]

    def shards(self, marks: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and shards: the home of each fingerprint and the shards whose border it is near."""
        rows, nodes = np.arange(len(marks)), np.zeros(len(marks), np.int64)
        for _ in range(self.depth):
            inside = np.bitwise_count(marks[rows] ^ self.points[nodes]).astype(np.int64) - self.radii[nodes]
            outer = inside > -bits
            inner = inside <= 0
            rows = np.concatenate([rows[inner], rows[outer]])
            nodes = np.concatenate([2 * nodes[inner] + 1, 2 * nodes[outer] + 2])
        return rows, nodes - (2**self.depth - 1)


def _matrix_links(marks: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links of a small set: each fingerprint with those behind it, a strip of rows at a time."""
    links = []
    for start in range(0, len(marks), STRIP):
        strip = marks[start : start + STRIP, None] ^ marks[None, start:]
        a, b = np.divmod(np.flatnonzero(np.bitwise_count(strip) <= bits), len(marks) - start)
        links.append((a[a < b] + start, b[a < b] + start))
    a, b = np.concatenate([a for a, _ in links]), np.concatenate([b for _, b in links])
    if len(a) <= len(marks):
        return [(a, b)]
    root = _roots(len(marks), a, b)  # a dense set has more links than it needs
    moved = np.flatnonzero(root != np.arange(len(marks)))
    return [(moved, root[moved])]


def _ball_links(marks: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links of a set that does not fall apart: balls round one fingerprint after the other.

    All of a ball belongs to its centre's component. Fingerprints left outside can only be linked to a member
    if they are within twice the distance of the centre; one link of each is enough.
    """
    links, rest = [], np.arange(len(marks))
    while len(rest):
        centre = rest[0]
        distance = np.bitwise_count(marks[rest] ^ marks[centre])
        ball, near = rest[distance <= bits], rest[(distance > bits) & (distance <= 2 * bits)]
        links.append((ball[1:], np.full(len(ball) - 1, centre)))
        for start in range(0, len(near), step := max(1, 2_000_000 // len(ball))):
            some = near[start : start + step]
            met = (np.bitwise_count(marks[some][:, None] ^ marks[ball][None, :]) <= bits).any(axis=1)
            links.append((some[met], np.full(int(met.sum()), centre)))
        rest = rest[distance > bits]
    return links


def spanning_links(marks: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components as all pairs of distinct fingerprints at most `bits` apart."""
    links, stack = [], [np.arange(len(marks))]
    while stack:
        rows = stack.pop()
        part = marks[rows]
        if len(rows) <= LEAF:
            links += [(rows[a], rows[b]) for a, b in _matrix_links(part, bits)]
            continue
        distance = np.bitwise_count(part ^ part[len(part) // 2]).astype(np.int64)
        radius = int(np.median(distance))
        inner, outer = distance <= radius, distance > radius - bits
        if max(inner.sum(), outer.sum()) > 0.9 * len(rows) or inner.sum() + outer.sum() > 1.6 * len(rows):
            links += [(rows[a], rows[b]) for a, b in _ball_links(part, bits)]
        else:
            stack += [rows[inner], rows[outer]]
    if not links:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([a for a, _ in links]), np.concatenate([b for _, b in links])


def _roots(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row of each row's component."""
    label = np.arange(size)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def _links(distinct: DataFrame, bits: int) -> DataFrame:
    """`node`, `parent`: smallest ids of linked fingerprints, of which the components are those of all links."""
    n = distinct.count()
    picked = distinct.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(SAMPLE).select("fingerprint")
    sample = np.array([row[0] for row in picked.collect()], np.int64).view(np.uint64)
    depth = max(0, min(math.ceil(math.log2(max(1, n / SHARD))), int(math.log2(SAMPLE / 16))))
    tree = VantageTree(sample, depth)

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(0).to_numpy().view(np.uint64)
            rows, shards = tree.shards(marks, bits)
            yield pa.record_batch([pa.array(shards, pa.int64())], ["shard"])

    counts = distinct.select("fingerprint").mapInArrow(home, "shard bigint").groupBy("shard").count().collect()
    chunks = np.ones(2**depth, np.int64)
    for shard, count in counts:
        chunks[shard] = -(-count // CHUNK)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, first = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            rows, shards = tree.shards(marks.view(np.uint64), bits)
            parts = chunks[shards]
            mixed = marks[rows].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
            own = mixed.astype(np.int64) % parts
            at = np.repeat(np.arange(len(rows)), parts)
            other = np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)
            low, high = np.minimum(own[at], other), np.maximum(own[at], other)
            columns = [shards[at], low, high, marks[rows][at], first[rows][at]]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names)

    def link(group: pa.Table) -> pa.Table:
        marks, first = group.column("fingerprint").to_numpy(), group.column("first").to_numpy()
        a, b = spanning_links(marks.view(np.uint64), bits)
        order = np.argsort(first, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        root = _roots(len(order), place[a], place[b])
        moved = np.flatnonzero(root != np.arange(len(order)))
        ids = first[order]
        return pa.table({"node": ids[moved], "parent": ids[root[moved]]})

    names = ["shard", "low", "high", "fingerprint", "first"]
    dealt = distinct.mapInArrow(deal, ", ".join(f"{name} bigint" for name in names))
    return dealt.groupBy("shard", "low", "high").applyInArrow(link, "node bigint, parent bigint").distinct()


def components(links: DataFrame) -> DataFrame:
    """`node`, `root`: the smallest id of the component of each id that has a smaller one.

    `links` has `node` > `parent`. A round points every id to its smallest parent, links its other parents to
    that one, and lets each id skip to its parent's parent; about log2 of the longest chain rounds are needed.
    Each round is a written table, so that a lost executor costs one round at most.
    """
    edges = materialize(links.select("node", "parent"), "links")
    while True:
        best = edges.groupBy("node").agg(F.min("parent").alias("root"))
        others = (
            edges.join(best, "node")
            .where("parent != root")
            .select(F.col("parent").alias("node"), F.col("root").alias("parent"), F.lit(True).alias("moved"))
        )
        above = best.select(F.col("node").alias("root"), F.col("root").alias("top"))
        jumped = best.join(above, "root", "left").select(
            "node", F.coalesce("top", "root").alias("parent"), F.col("top").isNotNull().alias("moved")
        )
        after = others.union(jumped).groupBy("node", "parent").agg(F.max("moved").alias("moved"))
        edges = materialize(after, "links")
        if edges.where("moved").isEmpty():
            return edges.select("node", F.col("parent").alias("root"))


def near_duplicate_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words_per_shingle: int = 4,
    bits: int = 4,
) -> DataFrame:
    """`doc_id`, `fingerprint` (16 hex digits), `component_id` per row: the smallest id reachable by links.

    Fingerprints at most `bits` bits apart are linked. Null and empty texts have fingerprint 0, which is linked
    like any other; repeated rows share their class. A row without id has a fingerprint but null as component
    and links nothing. Other columns of `docs` are not read. An empty table gives no rows.
    """
    marks = materialize(fingerprints(docs, id_col, text_col, words_per_shingle), "fingerprints")
    known = marks.where("doc_id IS NOT NULL").groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    distinct = materialize(known, "distinct_fingerprints")
    roots = components(_links(distinct, bits)).withColumnRenamed("node", "first")
    classes = distinct.join(roots, "first", "left").select(
        F.col("fingerprint"), F.coalesce("root", "first").alias("component_id")
    )
    return marks.join(classes, "fingerprint", "left").select(
        "doc_id",
        hex_fingerprint(F.col("fingerprint")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words_per_shingle: int = 4,
    bits: int = 4,
) -> DataFrame:
    """The document with the smallest id of each group, with all its columns.

    Of repeated ids the row with the smallest text stays; rows without id all stay.
    """
    groups = near_duplicate_groups(docs, id_col, text_col, words_per_shingle, bits)
    kept = materialize(groups.where("doc_id = component_id").select("doc_id").distinct(), "kept")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.struct("*").alias("row"))
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    single = rows.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by("row", text).alias("row"))
    return single.select("row.*").union(rows.where("doc_id IS NULL").select("row.*"))
