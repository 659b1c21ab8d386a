"""Exact near-duplicate vectors by a dual traversal of cover trees.

Unit vectors with a cosine of at least the threshold lie within a fixed distance of each other. The upper
levels of the tree are the whole sphere and cells around pivots; a cell is cut into nodes of bounded
size, and inside each node nested levels with halving radii follow, down to single vectors. Two
nodes are compared from the top: a pair whose centres are further apart than the distance plus both
covering radii holds no link and is dropped, a pair that lies within it as a whole is linked as a
whole, and any other is replaced by the pairs of its children. What comes out are the
exact numbers of links, and for each pair of nodes one edge per vector that spans the links found.

A node is one row that holds its vectors packed. Which nodes meet grows with their number's square where bounds drop
few pairs, so nodes are not sent to their pairs: the stored nodes are dealt into parts, and a task reads two parts.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, FloatType

from courtside.llm.components import components
from courtside.llm.topk import usable
from courtside.session import store

#: Vectors of a node, cells at most, and radii of the levels inside a node.
NODE_ROWS, MAX_CELLS = 2048, 256
RADII = (0.5, 0.25, 0.125)
#: Room for rounding where a bound decides; the cosine itself decides between single vectors.
TINY = 1e-9
_SLICE = 65_536
#: Balls of the first level that are compared with those of the other node at a time.
_TOPS = 256
#: Bytes of the vectors of a part, and of the unpacked nodes that a task keeps.
PART_BYTES, KEPT_BYTES = 33_554_432, 134_217_728
_NODE = "node long, cell int, radius double, ids binary, weights binary, vectors binary, depth binary, apart array<double>"
_NAMES = [c.split()[0] for c in _NODE.split(", ")]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; safe for very large and very small numbers."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _distance(dots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dots))


def nested(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the points and, per level, whether a point opens a ball of that level.

    In that order every ball is a run of points whose first is its centre, inside one ball of the
    level above.
    """
    dots = points @ points.T
    balls = [np.arange(len(points))]
    depth = np.zeros(len(points), np.int64)
    for level, radius in enumerate(RADII):
        least, finer = 1.0 - radius * radius / 2.0, []
        for ball in balls:
            while len(ball):
                near = dots[ball[0], ball] >= least
                near[0] = True
                finer.append(ball[near])
                depth[ball[0]] |= 1 << level
                ball = ball[~near]
        balls = finer
    return np.concatenate(balls), depth


@dataclass
class Levels:
    """A node's points in order and, per level, where balls start and how far they reach."""

    points: np.ndarray
    starts: list[np.ndarray]
    radii: list[np.ndarray]
    #: The centres of the first level in single precision.
    tops: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray, depth: np.ndarray) -> "Levels":
        starts, radii = [], []
        for level in range(len(RADII)):
            first = np.flatnonzero(depth & (1 << level))
            sizes = np.diff(np.append(first, len(points)))
            far = _distance(np.einsum("ij,ij->i", points, np.repeat(points[first], sizes, axis=0)))
            far[first] = 0.0
            starts.append(first)
            radii.append(np.maximum.reduceat(far, first))
        starts.append(np.arange(len(points)))
        radii.append(np.zeros(len(points)))
        return cls(points, starts, radii, points[starts[0]].astype(np.float32))

    def stop(self, level: int, ball: np.ndarray) -> np.ndarray:
        return np.append(self.starts[level][1:], len(self.points))[ball]


def _pairs(first_a: np.ndarray, n_a: np.ndarray, first_b: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of the runs that start at ``first_a``, ``first_b`` and have ``n_a``, ``n_b`` members."""
    n = n_a * n_b
    own = np.repeat(np.arange(len(n)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return first_a[own] + at // n_b[own], first_b[own] + at % n_b[own]


def dual(a: Levels, b: Levels, cosine: float) -> Iterator[tuple[str, np.ndarray, ...]]:
    """Links between two nodes: runs that are linked as a whole, and single pairs."""
    reach = float(np.sqrt(2.0 - 2.0 * cosine))
    i, j = _near(a, b, reach)
    for level in range(len(RADII) + 1):
        last = level == len(RADII)
        next_i, next_j = [], []
        for s in range(0, len(i), _SLICE):
            x, y = i[s : s + _SLICE], j[s : s + _SLICE]
            dots = np.einsum("ij,ij->i", a.points[a.starts[level][x]], b.points[b.starts[level][y]])
            if last:
                linked = dots >= cosine
                yield "pairs", x[linked], y[linked]
                continue
            apart, ra, rb = _distance(dots), a.radii[level][x], b.radii[level][y]
            whole = (apart + ra + rb <= reach - TINY) & (dots >= cosine)
            if whole.any():
                xs, ys = x[whole], y[whole]
                yield "runs", a.starts[level][xs], a.stop(level, xs), b.starts[level][ys], b.stop(level, ys)
            open_ = ~whole & (apart <= reach + ra + rb + TINY)
            x, y = x[open_], y[open_]
            lo_a, hi_a = np.searchsorted(a.starts[level + 1], (a.starts[level][x], a.stop(level, x)))
            lo_b, hi_b = np.searchsorted(b.starts[level + 1], (b.starts[level][y], b.stop(level, y)))
            for part in np.array_split(np.arange(len(x)), max(1, int(((hi_a - lo_a) * (hi_b - lo_b)).sum()) // (4 * _SLICE))):
                px, py = _pairs(lo_a[part], (hi_a - lo_a)[part], lo_b[part], (hi_b - lo_b)[part])
                next_i.append(px)
                next_j.append(py)
        if not last:
            i = np.concatenate(next_i) if next_i else np.zeros(0, np.int64)
            j = np.concatenate(next_j) if next_j else np.zeros(0, np.int64)


def _near(a: Levels, b: Levels, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of balls of the first level that the bound does not drop."""
    ra, rb = a.radii[0], b.radii[0]
    ca, cb = a.tops, b.tops
    # Single precision decides what is dropped, so the bound is wider by what it can be off; all else is looked at again.
    off = TINY + (ca.shape[1] + 8) * float(np.finfo(np.float32).eps)
    found = []
    # Balls of one vector all have the same bound; the others are few.
    for some_a in (np.flatnonzero(ra == 0), np.flatnonzero(ra > 0)):
        for some_b in (np.flatnonzero(rb == 0), np.flatnonzero(rb > 0)):
            if len(some_a) and len(some_b):
                others = np.ascontiguousarray(cb[some_b].T)
                for s in range(0, len(some_a), _TOPS):
                    own = some_a[s : s + _TOPS]
                    most = reach + TINY + (ra[own][:, None] + rb[some_b][None, :] if ra[own].any() or rb[some_b].any() else 0.0)
                    least = (1.0 - off - most * most / 2.0) if np.ndim(most) else np.float32(1.0 - off - most * most / 2.0)
                    x, y = np.divmod(np.flatnonzero(ca[own] @ others >= least), len(some_b))
                    found.append((own[x], some_b[y]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _spanned(count: int, ends: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest point reachable from each point along the edges."""
    label = np.arange(count)
    if not ends:
        return label
    x, y = (np.concatenate(e) for e in zip(*ends))
    while True:
        low = np.minimum(label[x], label[y])
        fresh = label.copy()
        np.minimum.at(fresh, label[x], low)
        np.minimum.at(fresh, label[y], low)
        fresh = np.minimum(fresh, fresh[fresh])
        if (fresh == label).all():
            return label
        label = fresh


def _compare(cosine: float, width: int, kind: type) -> Callable:
    """Links of pairs of nodes as rows of vector, vector that it is connected with, links."""

    def unpacked(ids: pa.Scalar, weights: pa.Scalar, vectors: pa.Scalar, depth: pa.Scalar) -> tuple[np.ndarray, np.ndarray, Levels]:
        points = unit(np.frombuffer(vectors.as_buffer(), kind).reshape(-1, width).astype(np.float64))
        levels = Levels.of(points, np.frombuffer(depth.as_buffer(), np.int32))
        return np.frombuffer(ids.as_buffer(), np.int64), np.frombuffer(weights.as_buffer(), np.int64), levels

    def links(left: tuple, right: tuple) -> list[np.ndarray]:
        same = left is right
        (ids_a, weight_a, a), (ids_b, weight_b, b) = left, right
        n = len(ids_a)
        shift = 0 if same else n
        total_a, total_b = np.zeros(n + 1, np.int64), np.zeros(len(ids_b) + 1, np.int64)
        run_a, run_b = np.zeros(n + 1, np.int64), np.zeros(len(ids_b) + 1, np.int64)
        sum_a, sum_b = (np.concatenate(([0], np.cumsum(w))) for w in (weight_a, weight_b))
        ends: list[tuple[np.ndarray, np.ndarray]] = []
        for kind_of, *found in dual(a, b, cosine):
            if kind_of == "pairs":
                x, y = found
                np.add.at(total_a, x, weight_b[y])
                np.add.at(total_b, y, weight_a[x])
                ends.append((x, y + shift))
            else:
                lo_a, hi_a, lo_b, hi_b = found
                for run, lo, hi, sums, lo_o, hi_o in ((run_a, lo_a, hi_a, sum_b, lo_b, hi_b), (run_b, lo_b, hi_b, sum_a, lo_a, hi_a)):
                    other = sums[hi_o] - sums[lo_o]
                    np.add.at(run, lo, other)
                    np.add.at(run, hi, -other)
                one = np.ones(len(lo_a), np.int64)
                for x, y in (_pairs(lo_a, hi_a - lo_a, lo_b, one), _pairs(lo_a, one, lo_b, hi_b - lo_b)):
                    ends.append((x, y + shift))
        links_a = total_a[:-1] + np.cumsum(run_a)[:-1]
        links_b = total_b[:-1] + np.cumsum(run_b)[:-1]
        ids = ids_a if same else np.concatenate((ids_a, ids_b))
        counts = links_a if same else np.concatenate((links_a, links_b))
        some = counts > 0
        if not some.any():
            return [np.zeros(0, np.int64)] * 3
        label = _spanned(len(ids), ends)
        return [ids[some], ids[label[some]], counts[some]]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[int, tuple] = OrderedDict()

        def side(node: int, *packed: pa.Scalar) -> tuple:
            if node not in kept:
                kept[node] = unpacked(*packed)
                while len(kept) > 2 and sum(levels.points.nbytes for _, _, levels in kept.values()) > KEPT_BYTES:
                    kept.popitem(last=False)
            kept.move_to_end(node)
            return kept[node]

        for batch in batches:
            found = []
            for row in zip(*batch.columns):
                found.append(links(side(row[0].as_py(), *row[1:5]), side(row[5].as_py(), *row[6:10])))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=["a", "b", "n"])

    return compare


def _classes(fine: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The different vectors with their smallest id and number, and the smallest id of the vector of each id.

    Only vectors whose hash, and ids that, occur more than once are moved to be compared.
    """
    marks = store(fine.select("id", F.xxhash64("v").alias("h")))
    again = store(marks.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"))
    shared = store(marks.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"))
    smallest = fine.join(again, "id", "left_semi").groupBy("id").agg(F.min("v").alias("v"))
    own = fine.join(again, "id", "left_anti").unionByName(smallest).withColumn("h", F.xxhash64("v"))
    equal = store(own.join(shared, "h", "left_semi").groupBy("v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight")))
    single = own.join(shared, "h", "left_anti").select("v", F.col("id").alias("rep"), F.lit(1).cast("bigint").alias("weight"))
    reps = store(own.join(shared, "h", "left_semi").join(equal, "v").select("id", "rep"))
    ids = marks.select("id").distinct().join(reps, "id", "left").select("id", F.coalesce("rep", "id").alias("rep"))
    return store(single.unionByName(equal)), ids


def node_pairs(nodes: DataFrame, reach: float) -> DataFrame:
    """All pairs of nodes that the bounds of their cells do not drop, a node with itself included."""
    held = ["node", "ids", "weights", "vectors", "depth"]
    left, right = (nodes.select(*[F.col(c).alias(f"{c}_{s}") for c in [*held, "cell", "radius", "apart"]]) for s in "ab")
    apart = F.element_at("apart_a", F.col("cell_b") + 1)
    close = apart <= F.lit(reach + TINY) + F.col("radius_a") + F.col("radius_b")
    met = (F.col("node_a") == F.col("node_b")) | ((F.col("node_a") < F.col("node_b")) & close)
    # Parts are read again for each part that they meet, instead of being shuffled to it.
    pairs = left.hint("shuffle_replicate_nl").join(right.hint("shuffle_replicate_nl"), met)
    return pairs.select(*[f"{c}_{s}" for s in "ab" for c in held])


def near_vectors(rows: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``n_links``, ``component_id`` and ``kept`` of every row, with its id.

    Two vectors are linked at a cosine of at least ``cosine`` (above 0) in double precision. Null and
    zero vectors and those with null or non-finite components are linked with nothing, as are rows
    with a null id, whose component is null and which are kept. Of an id with several vectors the smallest
    counts for all its rows. A shorter vector counts as padded with zeros. Equal vectors are compared once
    and counted with their number.
    """
    given = rows.schema[vector].dataType
    single = isinstance(given, ArrayType) and isinstance(given.elementType, FloatType)
    kind, numbers = (np.float32, "array<float>") if single else (np.float64, "array<double>")
    plain = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).cast(numbers).alias("v"))
    fine = plain.where(usable("v") & F.col("id").isNotNull() & F.exists("v", lambda x: x != 0))
    least, width = fine.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    width = width or 1
    if least != width:
        fine = fine.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v")).cast(numbers)))
    classes, ids = _classes(fine)
    total = classes.count()

    count = int(min(MAX_CELLS, max(1, total // NODE_ROWS)))
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(count).select("v").collect()
    pivots = unit(np.array([r.v for r in sample], np.float64)) if sample else np.ones((1, width))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                dots = unit(_matrix(batch.column(2), batch.num_rows).astype(np.float64)) @ pivots.T
                cell = dots.argmax(axis=1)
                far = _distance(dots[np.arange(len(cell)), cell])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far)], names=["id", "weight", "v", "cell", "far"]
                )

    # Worked out twice, as that costs less than another copy of the vectors.
    placed = classes.select(F.col("rep").alias("id"), "weight", "v").mapInArrow(
        assign, f"id long, weight long, v {numbers}, cell int, far double"
    )
    rows_of = {r.cell: r["count"] for r in placed.groupBy("cell").count().collect()}
    chunks = [max(1, ceil(rows_of.get(cell, 0) / NODE_ROWS)) for cell in range(len(pivots))]
    chunk = F.pmod(F.xxhash64("id"), F.element_at(F.array(*[F.lit(n) for n in chunks]), F.col("cell") + 1))
    noded = placed.withColumn("node", F.col("cell").cast("bigint") * (1 << 40) + chunk)
    apart = _distance(pivots @ pivots.T)

    def build(table: pa.Table) -> pa.Table:
        vectors = _matrix(table.column("v"), table.num_rows)
        order, depth = nested(unit(vectors.astype(np.float64)))
        cell, far = table.column("cell")[0].as_py(), table.column("far").to_numpy().max()
        held = [table.column(c).to_numpy()[order].astype(np.int64) for c in ("id", "weight")]
        packed = [a.tobytes() for a in (*held, vectors[order].astype(kind), depth[order].astype(np.int32))]
        values = [table.column("node")[0].as_py(), cell, far, *packed, apart[cell].tolist()]
        return pa.table({c: pa.array([v], t) for c, v, t in zip(_NAMES, values, types)})

    types = [pa.int64(), pa.int32(), pa.float64(), *[pa.binary()] * 4, pa.list_(pa.float64())]
    # Pairs of parts are tasks: a few times as many as run at once, more where parts would be large.
    slots = rows.sparkSession.sparkContext.defaultParallelism
    parts = min(sum(chunks), max(ceil(sqrt(8 * slots)), ceil(total * width * np.dtype(kind).itemsize / PART_BYTES)))
    nodes = store(noded.repartition(parts, "node").groupBy("node").applyInArrow(build, _NODE))
    reach = float(np.sqrt(2.0 - 2.0 * cosine))
    links = store(node_pairs(nodes, reach).mapInArrow(_compare(cosine, width, kind), "a long, b long, n long"))

    counts = links.groupBy(F.col("a").alias("rep")).agg((F.sum("n") - 1).alias("n_links"))
    joined = components(links.select("a", "b"))
    by_class = counts.join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    of = ids.join(by_class, "rep").select("id", "n_links", F.coalesce("component", "rep").alias("component_id"))
    result = plain.select("id").join(of, "id", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return result.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
