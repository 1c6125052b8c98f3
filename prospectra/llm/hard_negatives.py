"""Hard negatives: exact search for the largest inner products, also within a window of scores, by cover trees.

One more component makes all candidates equally long: x becomes (x, sqrt(M^2 - |x|^2)) with M the largest length, and
a query q becomes (q, 0). Then |q - x|^2 = |q|^2 + M^2 - 2 <q, x>, so a candidate's distance gives its inner product,
and a ball that covers candidates bounds their inner products from both sides.

Candidates are dealt to the nearest of a bounded number of centres; a shard is such a ball and is cut into pieces of a
bounded size. A query goes to the shards whose bounds meet its window and can better what it has found among the
centres. There a cover tree goes on: farthest-first centres of a node are further apart than the radius that they
cover it with, level by level. A query descends to the leaf with the best bound first, verifies its rows by exact
integer products, and stops when no bound is better than its last result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prospectra.sources.scratch import materialize

#: Candidates of a shard aimed at, and the number of centres at the most; the driver and each task hold the centres.
SHARD, CENTRES = 1_024, 4_096
#: Rows of a shard's piece at the least and at the most.
PIECE, LARGEST_PIECE = 2_048, 65_536
#: Queries that meet a piece in one task, and those that descend together.
BLOCK, TOGETHER = 32_768, 1_024
#: Children of a tree's node, and rows of a leaf.
CHILDREN, LEAF = 16, 128
#: Largest length of a vector: a hundred times an inner product of two stays within a long.
LONGEST = 3.0e8
_NONE = np.iinfo(np.int64).min


def integer_vectors(column: Column) -> Column:
    """floor(256 * x) of each component as doubles."""
    return F.transform(column.cast("array<double>"), lambda x: F.floor(F.lit(256.0) * x).cast("double"))


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    dimension = max(1, queries.shape[1])
    most = (np.abs(queries).max(initial=0) or 1) * (np.abs(rows).max(initial=0) or 1) * dimension
    if most < 2**53:
        return (queries @ rows.T).astype(np.int64)
    return queries.astype(np.int64) @ rows.astype(np.int64).T


class Queries:
    """Query vectors with their label, own id and window, and the best rows found so far."""

    def __init__(self, vectors: np.ndarray, own: np.ndarray, label: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int):
        self.vectors, self.own, self.label, self.low, self.high, self.same, self.k = vectors, own, label, low, high, same, k
        self.lengths = (vectors**2).sum(axis=1)
        self.scores = np.full((len(vectors), k), _NONE)
        self.ids = np.full((len(vectors), k), np.iinfo(np.int64).max)

    def offer(self, of: np.ndarray, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        """Verifies rows for the queries `of` and keeps the best: larger scores first, ties by smaller id."""
        scores = _products(self.vectors[of], rows)
        alike = self.label[of][:, None] == labels[None, :]
        fits = (alike if self.same else ~alike) & (self.own[of][:, None] != ids[None, :])
        fits &= (scores >= self.low[of][:, None]) & (scores <= self.high[of][:, None])
        fits &= scores >= self.scores[of][:, -1:]
        some = np.flatnonzero(fits.any(axis=1))
        if not len(some):
            return
        at = of[some]
        scores = np.where(fits[some], scores[some], _NONE)
        named = np.where(fits[some], ids[None, :], np.iinfo(np.int64).max)
        scores, named = np.concatenate([self.scores[at], scores], axis=1), np.concatenate([self.ids[at], named], axis=1)
        order = np.lexsort((named, ~scores), axis=1)[:, : self.k]  # ~x falls as x rises, and the least long has one
        self.scores[at] = np.take_along_axis(scores, order, axis=1)
        self.ids[at] = np.take_along_axis(named, order, axis=1)

    def promise(self, of: np.ndarray, distance: np.ndarray, radius: np.ndarray, longest: float) -> np.ndarray:
        """Per query of `of` and ball the largest score in its window that the ball may hold; -inf if none."""
        whole = self.lengths[of][:, None] + longest
        slack = 1.0 + 1e-6 * whole  # of roots of differences of large numbers
        most = (whole - np.maximum(distance - radius, 0) ** 2) / 2 + slack
        least = (whole - (distance + radius) ** 2) / 2 - slack
        low, high = self.low[of][:, None].astype(float), self.high[of][:, None].astype(float)
        return np.where((most >= low) & (least <= high), np.minimum(most, high), -np.inf)

    def wants(self, of: np.ndarray, promised: np.ndarray) -> np.ndarray:
        """Whether a ball with that promise can still change the result."""
        last = self.scores[of][:, -1]
        return (promised > -np.inf) & ((last == _NONE) | (promised >= last.astype(float) * (1 - 1e-15) - 1))


def augmented(rows: np.ndarray, longest: float) -> np.ndarray:
    """The rows with one more component, all as long as the square root of `longest`."""
    return np.concatenate([rows, np.sqrt(np.maximum(longest - (rows**2).sum(axis=1), 0))[:, None]], axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


class CoverTree:
    """Nested balls over augmented rows. Levels from the root: centre and covering radius per node, and its children.

    The centres of a node's children are taken farthest first, so that they are at least as far apart as the
    radius with which they cover the node's rows.
    """

    def __init__(self, rows: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.children: list[list[np.ndarray]] = []
        self.leaves: list[np.ndarray] = []
        nodes = [(0, np.arange(len(rows)))]
        while nodes:
            self.levels.append(
                (np.array([rows[centre] for centre, _ in nodes]), np.array([self._radius(rows, c, of) for c, of in nodes]))
            )
            below: list[tuple[int, np.ndarray]] = []
            children = []
            for centre, of in nodes:
                parts = self._split(rows, centre, of) if len(of) > LEAF else []
                if len(parts) > 1:
                    children.append(np.arange(len(below), len(below) + len(parts)))
                    below += parts
                else:  # a leaf, or equal rows
                    children.append(np.array([-1 - len(self.leaves)]))
                    self.leaves.append(of)
            self.children.append(children)
            nodes = below

    @staticmethod
    def _radius(rows: np.ndarray, centre: int, of: np.ndarray) -> float:
        return float(distances(rows[of], rows[centre : centre + 1]).max())

    @staticmethod
    def _split(rows: np.ndarray, centre: int, of: np.ndarray) -> list[tuple[int, np.ndarray]]:
        near, owner, centres = distances(rows[of], rows[centre : centre + 1])[:, 0], np.zeros(len(of), np.int64), [centre]
        near[of == centre] = 0
        while len(centres) < CHILDREN and near.max() > 1e-7 * (1 + float(np.abs(rows[centre]).max())):
            centres.append(int(of[near.argmax()]))
            distance = distances(rows[of], rows[centres[-1] : centres[-1] + 1])[:, 0]
            distance[of == centres[-1]] = 0
            closer = distance < near
            near[closer], owner[closer] = distance[closer], len(centres) - 1
        return [(c, of[owner == k]) for k, c in enumerate(centres)]


def search(queries: Queries, tree: CoverTree, longest: float, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
    """Offers to every query the rows that can change its result, the leaf with the best bound first."""
    asked = np.concatenate([queries.vectors, np.zeros((len(queries.vectors), 1))], axis=1)
    everyone = np.arange(len(asked))
    promised = np.full((len(asked), len(tree.leaves)), -np.inf)
    reached = np.ones((len(asked), 1), bool)
    for (centres, radii), children in zip(tree.levels, tree.children, strict=True):
        bounds = queries.promise(everyone, distances(asked, centres), radii[None, :], longest)
        bounds[~reached] = -np.inf
        inner = [node for node, below in enumerate(children) if below[0] >= 0]
        for node, below in enumerate(children):
            if below[0] < 0:
                promised[:, -1 - below[0]] = bounds[:, node]
        if inner:
            reached = np.repeat(bounds[:, inner] > -np.inf, [len(children[node]) for node in inner], axis=1)
    while True:
        best = promised.argmax(axis=1)
        open_ = np.flatnonzero(queries.wants(everyone, promised[everyone, best]))
        if not len(open_):
            return
        order = open_[np.argsort(best[open_], kind="stable")]
        leaf, starts = np.unique(best[order], return_index=True)
        for k, of in zip(leaf.tolist(), np.split(order, starts[1:]), strict=True):
            at = tree.leaves[k]
            for start in range(0, len(at), 4096):
                some = at[start : start + 4096]
                queries.offer(of, rows[some], ids[some], labels[some])
            promised[of, k] = -np.inf


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, "<f8").reshape(-1, dimension)


_CANDIDATE = "id bigint, label bigint, vector binary"
_ASKED = "query bigint, own bigint, label bigint, low bigint, high bigint, vector binary"


class Shards:
    """Centres over a bounded sample, the radius of each centre's candidates, and the pieces that they are cut into."""

    def __init__(self, candidates: DataFrame, dimension: int):
        rows, longest = candidates.agg(
            F.count("*"), F.max(F.expr("aggregate(transform(x, v -> v * v), 0D, (a, b) -> a + b)"))
        ).first()
        self.dimension, self.longest, self.rows = dimension, float(longest), rows
        wanted = max(1, min(CENTRES, math.ceil(rows / SHARD)))
        held = candidates.select("id", "label", "vector")
        picked = held.orderBy(F.xxhash64("id", "vector"), "id", "label").limit(wanted).collect()
        matrix = _matrix(pa.array([bytes(row.vector) for row in picked], pa.binary()), dimension)
        self.matrix, first = np.unique(matrix, axis=0, return_index=True)
        self.ids = np.array([picked[k].id for k in first], np.int64)
        self.labels = np.array([picked[k].label for k in first], np.int64)
        self.centres = augmented(self.matrix, self.longest)
        self.piece = int(max(PIECE, min(LARGEST_PIECE, 2 * rows / len(self.ids))))

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shard of each row and its distance from the centre."""
        shards, far = np.empty(len(rows), np.int64), np.empty(len(rows))
        for start in range(0, len(rows), 1024):
            distance = distances(augmented(rows[start : start + 1024], self.longest), self.centres)
            shards[start : start + 1024] = distance.argmin(axis=1)
            far[start : start + 1024] = distance.min(axis=1)
        return shards, far

    def deal(self, candidates: DataFrame) -> DataFrame:
        """The candidates with their shard; measures the shards on the way."""
        shards = self

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                of, far = shards.nearest(_matrix(batch.column(2), shards.dimension))
                yield pa.record_batch([*batch.columns, pa.array(of), pa.array(far)], ["id", "label", "vector", "shard", "far"])

        placed = candidates.select("id", "label", "vector").mapInArrow(place, f"{_CANDIDATE}, shard bigint, far double")
        placed = materialize(placed, "placed_candidates")
        self.radii, self.pieces = np.zeros(len(self.ids)), np.zeros(len(self.ids), np.int64)
        for row in placed.groupBy("shard").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect():
            self.radii[row.shard] = row.far * (1 + 1e-6) + 1e-3
            self.pieces[row.shard] = -(-row.n // self.piece)
        return placed.drop("far")

    def route(self, asked: DataFrame, same: bool, k: int) -> DataFrame:
        """The queries with the shards that may hold rows for them."""
        shards = self

        def to_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for start in range(0, whole.num_rows, 256):
                    batch = whole.slice(start, 256)
                    queries = _queries(batch, shards.dimension, same, k)
                    everyone = np.arange(batch.num_rows)
                    queries.offer(everyone, shards.matrix, shards.ids, shards.labels)
                    zeros = np.zeros((batch.num_rows, 1))
                    far = distances(np.concatenate([queries.vectors, zeros], axis=1), shards.centres)
                    promised = queries.promise(everyone, far, shards.radii[None, :], shards.longest)
                    wanted = np.stack([queries.wants(everyone, promised[:, s]) for s in range(promised.shape[1])], axis=1)
                    row, shard = np.nonzero(wanted & (shards.pieces > 0)[None, :])
                    # no result is worse than what the centres gave
                    low = pa.array(np.maximum(queries.low, queries.scores[:, -1]))
                    batch = batch.set_column(batch.schema.get_field_index("low"), "low", low)
                    yield pa.record_batch([pa.array(shard), *batch.take(pa.array(row)).columns], ["shard", *batch.schema.names])

        return asked.mapInArrow(to_shards, f"shard bigint, {_ASKED}")


def _queries(batch: pa.RecordBatch | pa.Table, dimension: int, same: bool, k: int) -> Queries:
    own, label, low, high = (np.asarray(batch.column(c)) for c in ("own", "label", "low", "high"))
    return Queries(_matrix(batch.column("vector"), dimension), own, label, low, high, same, k)


def largest_products(dealt: DataFrame, shards: Shards, asked: DataFrame, same: bool, k: int) -> DataFrame:
    """`query`, `id`, `score`: the `k` best rows of each query, of its label or of others, in its window of scores."""

    def run(key: tuple, asked: pa.Table, rows: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and asked.num_rows:
            ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
            matrix = _matrix(rows.column("vector"), shards.dimension)
            longest = float((matrix**2).sum(axis=1).max())
            tree = CoverTree(augmented(matrix, longest))
            for start in range(0, asked.num_rows, TOGETHER):
                some = asked.slice(start, TOGETHER)
                queries = _queries(some, shards.dimension, same, k)
                search(queries, tree, longest, matrix, ids, labels)
                q, at = np.nonzero(queries.scores != _NONE)
                found.append((some.column("query").to_numpy()[q], queries.ids[q, at], queries.scores[q, at]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 3
        return pa.table(columns, ["query", "id", "score"])

    routed = materialize(shards.route(asked, same, k), "routed_queries")
    blocks = {row.shard: -(-row["count"] // BLOCK) for row in routed.groupBy("shard").count().collect()}
    cut = [(s, int(n), blocks[s]) for s, n in enumerate(shards.pieces.tolist()) if s in blocks]
    # a row for each centre; pieces and blocks of a shard meet each in a task of their own
    cuts = F.broadcast(dealt.sparkSession.createDataFrame(cut, "shard bigint, pieces int, blocks int"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    block = F.pmod(F.xxhash64("query"), "blocks").cast("int")
    piece = F.pmod(F.xxhash64("id", "label", "vector"), "pieces").cast("int")
    names = [name.split()[0] for name in _ASKED.split(", ")]
    queries = routed.join(cuts, "shard").select("shard", each("pieces").alias("piece"), block.alias("block"), *names)
    rows = dealt.join(cuts, "shard").select("shard", piece.alias("piece"), each("blocks").alias("block"), "id", "label", "vector")
    keys = ["shard", "piece", "block"]
    found = queries.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(run, "query bigint, id bigint, score bigint")
    # each piece gives a query k rows at most
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("less"), "id"))), 1, k)
    top = found.groupBy("query").agg(best.alias("best")).select("query", F.posexplode("best").alias("place", "best"))
    return top.select("query", (F.col("place") + 1).alias("rank"), "best.id", (-F.col("best.less")).alias("score"))


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 10,
    least: int = 30,
    most: int = 90,
) -> DataFrame:
    """`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score`.

    Scores are inner products of the whole numbers floor(256 * x). An anchor's positives are its best `positives`
    other rows of its label; for each, `negatives` rows of other labels follow, best first, whose score is between
    `least` and `most` percent of the positive's. Ties go to the smaller id. `anchors` tells the anchors among the
    rows. Rows without id or label, with a null or empty vector or with null or non-finite components take no part,
    nor do those as long as `LONGEST`, whose products may exceed a long, or of another length than most. Repeated ids
    are rows like others, but a row is no positive of its own id, and a repeated anchor is asked once for each
    label and vector. Other columns are not read. Without anchors, positives or negatives there are no rows.
    """
    spark = vectors.sparkSession
    x = F.col(vector_col)
    usable = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & usable).select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("bigint").alias("label"),
        integer_vectors(x).alias("x"),
        anchors.alias("anchor"),
    )
    length = F.aggregate("x", F.lit(0.0), lambda total, v: total + v * v)
    rows = rows.where(length < LONGEST * LONGEST)
    sizes = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if sizes is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("x") == sizes.size)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(2).flatten().to_numpy().astype("<f8").reshape(-1, sizes.size)
            packed = pa.array([v.tobytes() for v in values], pa.binary())
            yield pa.record_batch([*batch.columns, packed], ["id", "label", "x", "anchor", "vector"])

    packed = rows.mapInArrow(pack, "id bigint, label bigint, x array<double>, anchor boolean, vector binary")
    packed = materialize(packed, "integer_vectors")
    shards = Shards(packed, sizes.size)
    dealt = shards.deal(packed)
    widest = F.lit(2**63 - 1)  # of scores
    asked = packed.where("anchor").select("id", "label", "vector").distinct()
    query = F.monotonically_increasing_id()
    asked = materialize(asked.select(query.alias("query"), "id", "label", "vector"), "anchors")
    wanted = asked.select("query", F.col("id").alias("own"), "label", (-widest).alias("low"), widest.alias("high"), "vector")
    near = largest_products(dealt, shards, wanted, True, positives)
    near = materialize(near.select(F.col("query").alias("of"), "rank", F.col("id").alias("positive_id"), "score"), "positives")

    def percent(share: int) -> Column:
        """The largest whole number not above that share of the score."""
        whole = F.col("score") * share
        return F.call_function("div", whole - F.pmod(whole, F.lit(100)), F.lit(100))

    low, high = -percent(-least), percent(most)
    pairs = near.join(asked, near.of == asked.query).select(
        query.alias("query"), F.col("id").alias("own"), "label", low.alias("low"), high.alias("high"), "vector", "positive_id", "score"
    )
    pairs = materialize(pairs, "windows")
    names = [name.split()[0] for name in _ASKED.split(", ")]
    far = largest_products(dealt, shards, pairs.where("low <= high").select(*names), False, negatives)
    far = far.select(F.col("query").alias("of"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    told = pairs.select("query", F.col("own").alias("anchor_id"), "positive_id", F.col("score").alias("positive_score"))
    return told.join(far, told.query == far.of).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
