"""Near-duplicate vectors by counted collisions on sorted one-dimensional projections.

Two vectors collide on a projection if each lies in the window of fixed width round the other. For a pair at the
threshold a collision has a known probability, since the difference of two unit vectors on a random direction is
normal; so the number of collisions that all but a stated share of such pairs reach is known too. Pairs that reach it
are compared exactly.

Not every pair is counted. A table cuts its own projections where half of the values lie on either side; a vector goes to
both sides if it is within half a border of the cut. A pair meets in a leaf of the table unless some cut separates
it; the number of tables follows from the measured density at the cuts, so that few enough pairs at the threshold
meet in none. A pair that meets is counted in one leaf of the first table in which it meets.

Equal vectors are one class with a weight. Large leaves are cut into chunks that are compared two at a time. Vectors so
close to the centre of a large leaf that all of them are linked (a ball) are counted as a group, never pair by pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prospectra.llm.simhash import components
from prospectra.sources.scratch import materialize

#: Vectors that fit the cuts, an eighth of all at the most; the driver holds them.
SAMPLE = 4_096
#: Rows that are compared with those behind them at a time.
STRIP = 128
#: Vectors of a leaf aimed at, and vectors beyond which a leaf is cut into chunks of that many.
LEAF, CHUNK = 512, 8_192
#: Share of pairs at the threshold that meet in a table, and share of those that also pass the count, at the least.
MEETING, COUNTING = 0.997, 0.997
#: Projections on which collisions are counted, at the least.
COUNTED = 64
#: Half a window and the width of a border, in deviations of the difference of a pair at the threshold.
WINDOW, BORDER = 1.2, 0.5
#: Half a window that all but a thousandth of those pairs keep, and the projections on which it is asked for first.
WIDE_WINDOW, WIDE = 3.3, 4
#: Tables, at the most; the leaves grow where more would be needed, and large ones are cut into chunks.
TABLES = 32
_SEED = 20_111
#: What rounding may change in an angle.
_ROUNDING = 1e-7


def _normal_below(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


def needed_collisions(projections: int, recall: float, window: float = WINDOW) -> int:
    """The largest count that a pair at the threshold reaches with at least the probability `recall`."""
    hit = 2 * _normal_below(window) - 1
    above = 1.0
    for count in range(projections + 1):
        if above < recall:
            return max(0, count - 1)
        above -= math.comb(projections, count) * hit**count * (1 - hit) ** (projections - count)
    return projections


def _separated(density: np.ndarray, deviation: float, border: float) -> np.ndarray:
    """Probability that a cut, with values of that density round it, separates a pair of that deviation."""
    t = border / deviation
    beyond = math.exp(-t * t / 2) / math.sqrt(2 * math.pi) - t * (1 - _normal_below(t))
    return np.minimum(1, 2 * density * deviation * beyond)


@lru_cache(2)
def directions(count: int, dimension: int) -> np.ndarray:
    return np.random.default_rng([_SEED, dimension]).standard_normal((count, dimension))


class Layout:
    """Cuts of the tables' projections, fitted on a sample of unit vectors for a number of vectors."""

    def __init__(self, sample: np.ndarray, rows: int, dimension: int, cosine: float):
        self.dimension, self.cosine = dimension, cosine
        self.deviation = math.sqrt(2 - 2 * cosine)
        self.border = BORDER * self.deviation
        self.depth, self.tables, cuts = 0, 1, np.empty(0)
        wanted = max(0, math.ceil(math.log2(max(1, rows / LEAF)) * 1.1)) if len(sample) > 1 else 0
        if wanted:
            values = sample @ directions(wanted, dimension).T
            spread = np.maximum(values.std(axis=0), 1e-12)
            near = (np.abs(values - np.median(values, axis=0)) <= 0.25 * spread).mean(axis=0)
            apart = _separated(near / (0.5 * spread), self.deviation, self.border)
            for depth, meeting in enumerate(np.cumprod(1 - apart).tolist(), 1):
                tables = math.ceil(math.log(1 - MEETING) / math.log(max(1e-9, 1 - meeting))) if meeting > 1e-9 else TABLES + 1
                if tables > TABLES:
                    break
                self.depth, self.tables = depth, tables
            cuts = np.median(sample @ directions(self.depth * self.tables, dimension).T, axis=0)
        self.cuts = cuts
        self.projections = max(COUNTED, self.depth * self.tables)
        self.needed = needed_collisions(self.projections, COUNTING)

    def sides(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per vector and table, as bits of one number: the cuts it may be below, and those it may be above."""
        shape = (len(unit), self.tables, self.depth)
        if not self.depth:
            return np.zeros(shape[:2], np.int64), np.zeros(shape[:2], np.int64)
        values = unit @ directions(self.depth * self.tables, self.dimension).T - self.cuts
        bits = np.left_shift(np.int64(1), np.arange(self.depth))
        below = (values <= self.border / 2).reshape(shape)
        above = (values >= -self.border / 2).reshape(shape)
        return below @ bits, above @ bits

    def leaves(self, below: np.ndarray, above: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, table and leaf of every vector's copies. A leaf has a bit for each cut that it is above."""
        n = len(below)
        row = np.repeat(np.arange(n), self.tables)
        table = np.tile(np.arange(self.tables), n)
        leaf = np.zeros(len(row), np.int64)
        for k in range(self.depth):
            may_below, may_above = below[row, table] >> k & 1, above[row, table] >> k & 1
            up = np.flatnonzero(may_above)
            down = np.flatnonzero(may_below)
            row, table, leaf = (
                np.concatenate([row[down], row[up]]),
                np.concatenate([table[down], table[up]]),
                np.concatenate([leaf[down], leaf[up] | 1 << k]),
            )
        return row, table, leaf

    def home(self, below: np.ndarray) -> np.ndarray:
        """The leaf of table 0 that a vector is in, if one is to be named."""
        return below[:, 0] ^ ((1 << self.depth) - 1)


def unit_vectors(rows: list[bytes], dimension: int) -> np.ndarray:
    """Unit vectors from their bytes, shorter ones with zeros behind."""
    made = np.zeros((len(rows), dimension))
    sizes = np.array([len(row) // 8 for row in rows], np.int64)
    for size in np.unique(sizes).tolist():
        of = np.flatnonzero(sizes == size)
        made[of, :size] = np.frombuffer(b"".join(rows[k] for k in of.tolist()), "<f8").reshape(len(of), size)
    return made


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`vec_id`, key and unit vector (little-endian doubles); both null where the vector takes no part."""
    for batch in batches:
        keys, vectors = [], []
        for vector in batch.column(1).cast(pa.list_(pa.float64())).to_pylist():
            key = made = None
            if vector and None not in vector:
                x = np.array(vector, "<f8") + 0.0
                top = np.abs(x).max()
                if np.isfinite(top) and top > 0:
                    key = xxhash.xxh3_128_digest(x.tobytes())
                    x = x / top
                    made = (x / math.sqrt(float(x @ x))).astype("<f8").tobytes()
            keys.append(key)
            vectors.append(made)
        columns = [batch.column(0), pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())]
        yield pa.record_batch(columns, ["vec_id", "key", "unit"])


def _linked_pairs(unit: np.ndarray, sizes: np.ndarray, layout: Layout, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs collide often enough and have the cosine."""
    values = (unit @ directions(layout.projections, layout.dimension).T).astype(np.float32)
    window, linked = np.float32(WINDOW * layout.deviation), np.zeros(len(a), bool)
    for start in range(0, len(a), step := 1 << 16):
        x, y = a[start : start + step], b[start : start + step]
        passed = (np.abs(values[x] - values[y]) <= window).sum(axis=1) >= layout.needed
        passed &= sizes[x] == sizes[y]
        at = np.flatnonzero(passed)
        cosine = np.einsum("ij,ij->i", unit[x[at]], unit[y[at]])
        linked[start + at[cosine >= layout.cosine]] = True
    return linked


def _meeting_pairs(
    key: tuple[int, int, int, int],
    chunk: np.ndarray,
    ball: np.ndarray,
    below: np.ndarray,
    above: np.ndarray,
    wide: np.ndarray,
    layout: Layout,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows that are to be counted here, a strip of rows at a time.

    Those of the two chunks of `key`, whose leaf this is the one for, that have not met in an earlier table, are not
    of one ball, and are within the wide windows on the projections `wide`, by the first of which the rows are sorted.
    """
    table, leaf, low, high = key
    order = np.argsort(wide[:, 0], kind="stable")
    chunk, ball, below, above, wide = chunk[order], ball[order], below[order], above[order], wide[order]
    everything, window = np.int64((1 << layout.depth) - 1), WIDE_WINDOW * layout.deviation
    upto = np.searchsorted(wide[:, 0], wide[:, 0] + window, side="right")
    wide = np.ascontiguousarray(wide.T, np.float32)
    for start in range(0, len(order), STRIP):
        stop = min(start + STRIP, len(order))
        end = int(upto[stop - 1])
        keep = np.arange(start, end)[None, :] > np.arange(start, stop)[:, None]
        for of in wide:
            keep &= np.abs(of[start:stop, None] - of[None, start:end]) <= np.float32(window)
        if layout.depth:
            own = below[:, table]
            keep &= (everything & ~(own[start:stop, None] & own[None, start:end])) == leaf
        if low != high:
            keep &= chunk[start:stop, None] != chunk[None, start:end]
        i, j = np.nonzero(keep)
        i, j = i + start, j + start
        other = (ball[i] != ball[j]) | (ball[i] < 0)
        i, j = i[other], j[other]
        for earlier in range(table):
            together = (below[i, earlier] & below[j, earlier]) | (above[i, earlier] & above[j, earlier])
            i, j = i[together != everything], j[together != everything]
        yield order[i], order[j]


def _smallest(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
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


_SIDED = "node bigint, n bigint, size int, unit binary, below binary, above binary, ball bigint"
_COPY = f"table int, leaf bigint, low int, high int, chunk int, {_SIDED}"


def _links(classes: DataFrame, layout: Layout) -> DataFrame:
    """`node`, `parent` (may be null), `linked`: links that span the components, and shares of the links' number."""

    def side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(2).to_pylist()
            sides = [x.astype("<i8") for x in layout.sides(unit_vectors(rows, layout.dimension))]
            columns = [batch.column(0), batch.column(1), pa.array([len(x) // 8 for x in rows], pa.int32()), batch.column(2)]
            columns += [pa.array([x.tobytes() for x in of], pa.binary()) for of in sides]
            yield pa.record_batch([*columns, pa.array([-1] * len(rows), pa.int64())], _SIDED.replace(",", "").split()[::2])

    sided = materialize(classes.select("node", "n", "unit").mapInArrow(side, _SIDED), "sided_vectors")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Table, leaf and ball of the copies."""
        for batch in batches:
            row, table, leaf = layout.leaves(_sides(batch.column(0), layout), _sides(batch.column(1), layout))
            columns = [pa.array(table, pa.int32()), pa.array(leaf, pa.int64()), batch.column(2).take(pa.array(row))]
            yield pa.record_batch(columns, ["table", "leaf", "ball"])

    def sizes(of: DataFrame, *more: str) -> DataFrame:
        placed = of.select("below", "above", "ball").mapInArrow(place, "table int, leaf bigint, ball bigint")
        return placed.groupBy("table", "leaf", *more).count()

    # at most the number of copies by the size of a chunk
    crowded = {(row.table, row.leaf) for row in sizes(sided).where(F.col("count") > CHUNK).collect()}
    chunks: dict[tuple[int, int], list[int]] = {}
    centres: dict[int, np.ndarray] = {}
    if crowded:
        centres = _centres(sided, layout, [leaf for table, leaf in crowded if table == 0])
        sided = materialize(_with_balls(sided, centres, layout), "balls")
        wanted = classes.sparkSession.createDataFrame(sorted(crowded), "table int, leaf bigint")
        full = sizes(sided, "ball").join(wanted, ["table", "leaf"])
        for row in full.orderBy("table", "leaf", "ball").collect():
            chunks.setdefault((row.table, row.leaf), []).extend([row.ball] * -(-row["count"] // CHUNK))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _COPY.replace(",", "").split()[::2]
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                node, ball = batch.column(0).to_numpy(), batch.column(6).to_numpy()
                row, table, leaf = layout.leaves(_sides(batch.column(4), layout), _sides(batch.column(5), layout))
                at, own, low, high = _chunked(node[row], ball[row], table, leaf, chunks)
                columns = [pa.array(table[at], pa.int32()), pa.array(leaf[at], pa.int64())]
                columns += [pa.array(x, pa.int32()) for x in (low, high, own)]
                yield pa.record_batch([*columns, *batch.take(pa.array(row[at])).columns], names)

    def link(key: tuple, group: pa.Table) -> pa.Table:
        table, leaf, low, high = (x.as_py() for x in key)
        unit = unit_vectors(group.column("unit").to_pylist(), layout.dimension)
        node, n = group.column("node").to_numpy(), group.column("n").to_numpy()
        sizes, chunk, ball = (group.column(c).to_numpy() for c in ("size", "chunk", "ball"))
        below, above = _sides(group.column("below"), layout), _sides(group.column("above"), layout)
        wide = unit @ directions(WIDE, layout.dimension).T
        linked, root = np.zeros(len(node), np.int64), np.arange(len(node))
        order = np.argsort(node, kind="stable")
        place = np.empty(len(node), np.int64)
        place[order] = np.arange(len(node))
        key = table, leaf, low, high
        for a, b in _meeting_pairs(key, chunk, ball, below, above, wide, layout):
            met = _linked_pairs(unit, sizes, layout, a, b)
            a, b = a[met], b[met]
            np.add.at(linked, a, n[b])
            np.add.at(linked, b, n[a])
            x, y = np.concatenate([place[a], np.arange(len(node))]), np.concatenate([place[b], root])
            root = _smallest(len(node), x, y)
        at = np.flatnonzero(linked)
        parent = node[order][root[place[at]]]
        parents = pa.array(parent, pa.int64(), mask=parent == node[at])
        return pa.table({"node": node[at], "parent": parents, "linked": linked[at]})

    dealt = sided.mapInArrow(deal, _COPY)
    found = dealt.groupBy("table", "leaf", "low", "high").applyInArrow(link, "node bigint, parent bigint, linked bigint")
    if not centres:
        return found
    members = sided.where("ball >= 0")
    totals = members.groupBy("ball").agg(F.min("node").alias("parent"), F.sum("n").alias("total"))
    grouped = members.join(totals, "ball").select(
        "node", F.when(F.col("parent") != F.col("node"), F.col("parent")).alias("parent"), (F.col("total") - F.col("n")).alias("linked")
    )
    return found.union(grouped)


def _sides(column: pa.Array, layout: Layout) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, "<i8").reshape(-1, layout.tables)


def _chunked(
    node: np.ndarray, ball: np.ndarray, table: np.ndarray, leaf: np.ndarray, chunks: dict[tuple[int, int], list[int]]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Copies, each as often as it is to be dealt, their chunk and the pair of chunks that they are dealt for.

    `chunks` has the balls of the chunks of crowded leaves. A copy there is dealt for every chunk, but not for those of
    its own ball.
    """
    of = [chunks.get(cell) for cell in zip(table.tolist(), leaf.tolist(), strict=True)] if chunks else [None] * len(node)
    rows = []
    for k, balls in enumerate(of):
        if balls is None:
            rows.append((k, 0, 0, 0))
            continue
        mine, mixed = int(ball[k]), int(node[k]) * 0x9E3779B97F4A7C15 % 2**64
        options = [c for c, b in enumerate(balls) if b == mine]
        own = options[mixed * len(options) >> 64]
        rows += [(k, own, min(own, c), max(own, c)) for c, b in enumerate(balls) if mine < 0 or b != mine]
    return tuple(np.array(rows, np.int64).reshape(-1, 4).T)


def _with_balls(sided: DataFrame, centres: dict[int, np.ndarray], layout: Layout) -> DataFrame:
    """The ball of each vector: the leaf of table 0 to whose centre it is so near that all such are linked, or -1."""
    radius = math.acos(layout.cosine) / 2 - _ROUNDING

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = unit_vectors(batch.column(3).to_pylist(), layout.dimension)
            home, found = layout.home(_sides(batch.column(4), layout)), np.full(len(unit), -1, np.int64)
            for leaf in np.unique(home).tolist():
                if leaf in centres:
                    of = np.flatnonzero((home == leaf) & (batch.column(2).to_numpy() == layout.dimension))
                    found[of[np.arccos(np.clip(unit[of] @ centres[leaf], -1, 1)) <= radius]] = leaf
            yield pa.record_batch([*batch.columns[:-1], pa.array(found)], batch.schema.names)

    return sided.mapInArrow(near, _SIDED)


def _centres(sided: DataFrame, layout: Layout, leaves: list[int]) -> dict[int, np.ndarray]:
    """Per crowded leaf of table 0 the direction of the mean of its vectors."""
    if not leaves:
        return {}
    wanted = np.array(sorted(leaves))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(wanted), layout.dimension))
        for batch in batches:
            unit, home = unit_vectors(batch.column(0).to_pylist(), layout.dimension), layout.home(_sides(batch.column(1), layout))
            at = np.minimum(np.searchsorted(wanted, home), len(wanted) - 1)
            inside = np.flatnonzero(wanted[at] == home)
            np.add.at(sums, at[inside], unit[inside])
        filled = np.flatnonzero(sums.any(axis=1))
        columns = [pa.array(wanted[filled]), pa.array([sums[k].tobytes() for k in filled.tolist()], pa.binary())]
        yield pa.record_batch(columns, ["leaf", "sums"])

    found: dict[int, np.ndarray] = {}
    for row in sided.select("unit", "below").mapInArrow(add, "leaf bigint, sums binary").toLocalIterator():
        found[row.leaf] = found.get(row.leaf, 0) + np.frombuffer(row.sums, "<f8")
    lengths = {leaf: float(np.linalg.norm(total)) for leaf, total in found.items()}
    return {leaf: total / lengths[leaf] for leaf, total in sorted(found.items()) if lengths[leaf] > 0}


def near_duplicate_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95
) -> DataFrame:
    """`vec_id`, `n_links`, `component_id`, `kept` per row: links to other rows of at least that cosine.

    `component_id` is the smallest id reachable by links; `kept` marks the row of that id. Vectors that are null,
    empty, zero or hold null or non-finite components have no links, and neither have rows without an id; their
    component is their id. Vectors of different lengths are not linked. Each row counts for itself: equal vectors
    are linked, also if the id repeats. Pairs at the threshold are found with the probability MEETING * COUNTING,
    closer ones more often; a pair of less is never linked. Other columns are not read; an empty table gives no rows.
    """
    chosen = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    keyed = materialize(chosen.mapInArrow(_keyed, "vec_id bigint, key binary, unit binary"), "keyed_vectors")
    known = keyed.where("key IS NOT NULL AND vec_id IS NOT NULL")
    # rows of one key have one vector
    counted = known.groupBy("key").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"), F.first("unit").alias("unit"))
    classes = materialize(counted, "vector_classes")
    sizes = classes.agg(F.count("*").alias("rows"), F.max(F.octet_length("unit")).alias("bytes")).first()
    dimension = (sizes.bytes or 8) // 8
    picked = classes.orderBy(F.xxhash64("key"), "node").limit(min(SAMPLE, sizes.rows // 8)).select("unit").collect()
    layout = Layout(unit_vectors([bytes(row.unit) for row in picked], dimension), sizes.rows, dimension, cosine)
    found = materialize(_links(classes, layout), "vector_links")
    roots = components(found.where("parent IS NOT NULL").select("node", "parent").distinct())
    linked = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    known = (
        classes.join(linked, "node", "left")
        .join(roots, "node", "left")
        .select(
            "key",
            (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("root", "node").alias("component"),
        )
    )
    part = F.when(F.col("vec_id").isNotNull(), F.col("key")).alias("key")
    joined = keyed.select("vec_id", part).join(known, "key", "left")
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
