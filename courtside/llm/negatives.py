"""Hard negatives by angular triangle filtering.

Every row stores its angles to a few reference directions. By the triangle inequality the angle of
two rows lies between the difference and the sum of their angles to any reference, so the stored
angles give an interval for their cosine, and with the norms one for their inner product. Only rows
whose interval overlaps the window of scores that an anchor asks for are scored, in whole numbers.

Rows lie in blocks by their nearest reference and their angle to it, so that a block spans
narrow angles. An anchor is sent to the blocks whose angles allow a score in its window, and
to no others. Angles are widened by more than their rounding, so that no row is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from courtside.llm.topk import usable
from courtside.session import store

#: Rows of a block, reference directions, and rows that these are chosen from (bounded, farthest first).
BLOCK_ROWS, REFERENCES, SAMPLE = 8192, 16, 1000
#: Ranges of neighbouring blocks whose angles are broadcast; an anchor goes to all blocks of a range or to none.
RANGES = 50_000
#: Anchors scored at a time.
SLICE = 256
_EXACT = 2.0**53


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int, kind=np.int64) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1).astype(kind, copy=False)


def references(sample: np.ndarray, count: int) -> np.ndarray:
    """Unit vectors far from one another: the first row, then always the one with the largest least angle."""
    norms = np.linalg.norm(sample, axis=1)
    units = sample[norms > 0] / norms[norms > 0, None]
    if not len(units):
        return np.eye(1, sample.shape[1] if sample.ndim == 2 and sample.shape[1] else 1)
    chosen, nearest = [0], units @ units[0]
    while len(chosen) < min(count, len(units)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, units @ units[chosen[-1]])
    return units[chosen]


def slack(width: int) -> float:
    """More than the rounding of an angle that is stored in single precision, for this many dimensions."""
    return 1e-6 + 4 * np.sqrt(width * 2.0**-52)


def angles_to(vectors: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the references; a zero vector is at a right angle to all."""
    v = vectors.astype(np.float64)
    norms = np.linalg.norm(v, axis=1)
    cosines = np.clip((v @ units.T) / np.where(norms > 0, norms, 1)[:, None], -1, 1)
    return norms, np.arccos(cosines)


def bounds(angles: np.ndarray, norms: np.ndarray, row_angles: np.ndarray, row_norms: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product that the angles allow, for each anchor (rows) and each row (columns)."""
    apart = np.zeros((len(angles), len(row_angles)))
    most = np.full_like(apart, np.pi)
    for j in range(angles.shape[1]):
        a, b = angles[:, j, None], row_angles[None, :, j]
        np.maximum(apart, np.abs(a - b), out=apart)
        total = a + b
        np.minimum(most, np.minimum(total, 2 * np.pi - total), out=most)
    wide = slack(width)
    product = norms[:, None] * row_norms[None, :]
    margin = product * 1e-9 + 1
    high = product * np.cos(np.maximum(apart - wide, 0)) + margin
    low = product * np.cos(np.minimum(most + wide, np.pi)) - margin
    return low, high


def block_bounds(angles: np.ndarray, norms: np.ndarray, least: np.ndarray, most: np.ndarray, top: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for anchors (rows) and blocks (columns) with the span of their angles and the largest norm."""
    apart = np.zeros((len(angles), len(least)))
    far = np.full_like(apart, np.pi)
    for j in range(angles.shape[1]):
        a, lo, hi = angles[:, j, None], least[None, :, j], most[None, :, j]
        np.maximum(apart, np.maximum(lo - a, a - hi), out=apart)
        # The angle between them is at most a + x and 2 pi - a - x; the worse end of the span counts.
        np.minimum(far, np.minimum(a + hi, 2 * np.pi - a - lo), out=far)
    wide = slack(width)
    product = norms[:, None] * top[None, :]
    margin = product * 1e-9 + 1
    cos_high, cos_low = np.cos(np.maximum(apart - wide, 0)), np.cos(np.minimum(far + wide, np.pi))
    # Norms of a block go down to zero: a bound of the wrong sign is pulled towards it.
    return np.minimum(product * cos_low, 0) - margin, np.maximum(product * cos_high, 0) + margin


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, through doubles where every sum is exact in them."""
    largest = float(np.abs(anchors).max(initial=0)) * float(np.abs(rows).max(initial=0)) * anchors.shape[1]
    if largest < _EXACT:
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return anchors @ rows.T


def _measured(units: np.ndarray) -> Callable:
    """Adds norm, angles, the nearest reference and the angle to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            norms, angles = angles_to(_matrix(batch.column("v"), batch.num_rows), units)
            near = angles.argmin(axis=1)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(angles.astype(np.float32).ravel()), angles.shape[1])
            added = [
                pa.array(norms),
                lists.cast(pa.list_(pa.float32())),
                pa.array(near.astype(np.int32)),
                pa.array(angles[np.arange(len(near)), near]),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "norm", "angles", "home", "from_home"])

    return run


def _best(found: np.ndarray, ids: np.ndarray, fits: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` best fitting scores, ties to the smaller id."""
    at = np.flatnonzero(fits)
    if len(at) > 4 * k:
        # Only scores from the k-th best on can be among them.
        cut = np.partition(found[at], len(at) - k)[len(at) - k]
        at = at[found[at] >= cut]
    return at[np.lexsort((ids[at], -found[at]))[:k]]


def _positives(k: int, width: int) -> Callable:
    """The ``k`` best rows of an anchor's label in one block, from its ``cutoff`` on."""
    kinds = pa.schema([("a", pa.int64()), ("x", pa.int64()), ("score", pa.int64())])

    def run(key: tuple, asks: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for mine, theirs, ask, row in _by_slices(asks, rows):
            cutoff = ask["cutoff"]
            _, high = bounds(ask["angles"], ask["norm"], row["angles"], row["norm"], width)
            maybe = (high >= cutoff[:, None]) & (ask["label"][:, None] == row["label"][None, :]) & (ask["a"][:, None] != row["x"][None, :])
            for i, (columns, score) in enumerate(_scored(maybe, mine, theirs)):
                best = _best(score, row["x"][columns], score >= cutoff[i], k)
                out.append((np.full(len(best), ask["a"][i]), row["x"][columns][best], score[best]))
        return _table(out, kinds)

    return run


def _negatives(k: int, low: int, high: int, width: int) -> Callable:
    """The ``k`` best rows of other labels in one block for each positive of an anchor, inside its window."""
    kinds = pa.schema([("a", pa.int64()), ("p", pa.int64()), ("ps", pa.int64()), ("x", pa.int64()), ("score", pa.int64())])

    def run(key: tuple, asks: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        positives = asks.column("positives").to_pylist()
        at = 0
        for mine, theirs, ask, row in _by_slices(asks, rows):
            floor = np.array([min(-(-low * p["ps"] // 100) for p in each) for each in positives[at : at + len(mine)]], np.float64)
            ceiling = np.array([max(high * p["ps"] // 100 for p in each) for each in positives[at : at + len(mine)]], np.float64)
            least, most = bounds(ask["angles"], ask["norm"], row["angles"], row["norm"], width)
            maybe = (most >= floor[:, None]) & (least <= ceiling[:, None]) & (ask["label"][:, None] != row["label"][None, :])
            for i, (columns, score) in enumerate(_scored(maybe, mine, theirs)):
                ids = row["x"][columns]
                for p in positives[at + i]:
                    inside = (score >= -(-low * p["ps"] // 100)) & (score <= high * p["ps"] // 100)
                    best = _best(score, ids, inside, k)
                    same = np.full(len(best), ask["a"][i])
                    out.append((same, np.full(len(best), p["p"]), np.full(len(best), p["ps"]), ids[best], score[best]))
            at += len(mine)
        return _table(out, kinds)

    return run


def _by_slices(asks: pa.Table, rows: pa.Table) -> Iterator[tuple]:
    """The anchors of a block a few at a time, with the rows of the block."""
    if not asks.num_rows or not rows.num_rows:
        return
    plain = lambda table, name: table.column(name).to_numpy()
    theirs = _matrix(rows.column("v"), rows.num_rows)
    row = {c: plain(rows, c) for c in ("x", "label", "norm")} | {"angles": _matrix(rows.column("angles"), rows.num_rows, np.float64)}
    for start in range(0, asks.num_rows, SLICE):
        part = asks.slice(start, SLICE)
        ask = {c: plain(part, c) for c in part.column_names if c in ("a", "label", "norm", "cutoff")}
        ask["angles"] = _matrix(part.column("angles"), part.num_rows, np.float64)
        yield _matrix(part.column("v"), part.num_rows), theirs, ask, row


def _scored(maybe: np.ndarray, mine: np.ndarray, theirs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each anchor the columns that may fit, and their scores."""
    some = np.flatnonzero(maybe.any(axis=0))
    whole = scores(mine, theirs[some]) if len(some) else np.zeros((len(mine), 0), np.int64)
    for i in range(len(mine)):
        inside = np.flatnonzero(maybe[i, some])
        yield some[inside], whole[i, inside]


def _table(parts: list[tuple], kinds: pa.Schema) -> pa.Table:
    if not parts:
        return kinds.empty_table()
    return pa.table([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)], schema=kinds)


def _reachable(spans, width: int) -> Callable:
    """Sends each anchor to the ranges of blocks whose angles allow a score in its window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, least, most, top = spans.value
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                angles, norms = _matrix(part.column("angles"), part.num_rows, np.float64), part.column("norm").to_numpy()
                low, high = block_bounds(angles, norms, least, most, top, width)
                floor = part.column("floor").to_numpy(zero_copy_only=False).astype(np.float64)
                ceiling = part.column("ceiling").to_numpy(zero_copy_only=False).astype(np.float64)
                at, to = np.nonzero((high >= floor[:, None]) & (low <= ceiling[:, None]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("a").take(pa.array(at)), pa.array(ranges[to].astype(np.int64))], names=["a", "range"]
                )

    return run


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    window: tuple[int, int] = (80, 100),
    id_col: str = "vec_id",
    label: str = "label",
    vector: str = "v",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """For each anchor and each of its best rows of its own label, the best rows of other labels within a window.

    ``vector`` holds whole numbers (long), a score is their inner product and must fit a long times the
    window; a shorter vector counts as padded with zeros. A negative fits if its score is between the two
    percentages of ``window`` of the positive's score. Returns ``anchor_id``, ``positive_id``, ``rank``
    (from 1), ``negative_id``, ``positive_score`` and ``negative_score``; ties go to the smaller id. Rows with
    a null id, label or vector take no part, a repeated row counts once, and of an id with several
    rows the smallest (vector, then label) counts. Without anchors or rows the result is empty.
    """
    spark = rows.sparkSession
    own = rows.select(
        F.col(id_col).cast("bigint").alias("x"), F.col(label).cast("bigint").alias("label"), F.col(vector).alias("v"), is_anchor.alias("ask")
    ).where("x IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    once = own.groupBy("x").agg(F.min(F.struct("v", "label", "ask")).alias("row")).select("x", "row.*")
    once = store(once)
    count, width = once.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = max(1, width or 0)
    padded = F.concat("v", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("v")))
    once = once.withColumn("v", padded)
    sample = once.orderBy(F.xxhash64("x"), "x").limit(SAMPLE).select("v").collect()
    units = references(np.array([r.v for r in sample], np.float64).reshape(len(sample), width), REFERENCES)

    blocks = max(1, -(-count // block_rows))
    kinds = "x long, label long, v array<bigint>, ask boolean, norm double, angles array<float>, home int, from_home double"
    measured = once.select("x", "label", "v", "ask").mapInArrow(_measured(units), kinds)
    placed = measured.repartitionByRange(blocks, "home", "from_home", "x").withColumn("block", F.spark_partition_id())
    placed = store(placed.withColumn("range", F.floor(F.col("block") * F.lit(min(blocks, RANGES)) / F.lit(blocks)).cast("bigint")))

    each = lambda fn: F.array(*[fn(F.get("angles", F.lit(j))) for j in range(len(units))])
    found = placed.groupBy("range").agg(each(F.min).alias("least"), each(F.max).alias("most"), F.max("norm").alias("top")).collect()
    spans = spark.sparkContext.broadcast((
        np.array([r["range"] for r in found], np.int64),
        np.array([r.least for r in found], np.float64).reshape(len(found), len(units)),
        np.array([r.most for r in found], np.float64).reshape(len(found), len(units)),
        np.array([r.top for r in found], np.float64),
    ))
    table = placed.select("block", "x", "label", "v", "norm", "angles")
    in_range = placed.select("range", F.col("block").alias("to")).distinct()
    anchors = placed.where("ask").select(F.col("x").alias("a"), "label", "v", "norm", "angles", F.col("block").alias("to"))
    top = Window.partitionBy("a").orderBy(F.desc("score"), "x")

    def best_of_label(asks: DataFrame) -> DataFrame:
        return asks.groupBy("to").cogroup(table.groupBy("block")).applyInArrow(
            _positives(positives, width), "a long, x long, score long"
        )

    # What an anchor finds in its own block is a safe cutoff for all others.
    near = best_of_label(anchors.withColumn("cutoff", F.lit(float("-inf"))))
    cutoff = near.withColumn("r", F.row_number().over(top)).where(F.col("r") == positives).select("a", F.col("score").cast("double").alias("cutoff"))
    asking = store(anchors.drop("to").join(cutoff, "a", "left").fillna({"cutoff": float("-inf")}))

    def sent(windows: DataFrame) -> DataFrame:
        """Blocks that each anchor with a window (``floor``, ``ceiling``) has to see."""
        return windows.select("a", "norm", "angles", "floor", "ceiling").mapInArrow(_reachable(spans, width), "a long, range long").join(
            in_range, "range"
        ).select("a", "to")

    to_all = sent(asking.select("*", F.col("cutoff").alias("floor"), F.lit(float("inf")).alias("ceiling")))
    everywhere = best_of_label(asking.join(to_all, "a"))
    chosen = everywhere.withColumn("r", F.row_number().over(top)).where(F.col("r") <= positives)
    each_positive = F.struct(F.col("x").alias("p"), F.col("score").alias("ps"))
    # A window is empty for a negative score, and ends at zero for zero.
    wanted = chosen.where("score >= 0").groupBy("a").agg(
        F.collect_list(each_positive).alias("positives"), F.min("score").alias("low"), F.max("score").alias("high")
    )
    wanted = store(asking.drop("cutoff").join(wanted, "a"))
    limits = wanted.select(
        "*", (F.col("low") * (window[0] / 100) - 1).alias("floor"), (F.col("high") * (window[1] / 100) + 1).alias("ceiling")
    )
    asks = wanted.select("a", "label", "v", "norm", "angles", "positives").join(sent(limits), "a")
    local = asks.groupBy("to").cogroup(table.groupBy("block")).applyInArrow(
        _negatives(negatives, *window, width), "a long, p long, ps long, x long, score long"
    )
    by_positive = Window.partitionBy("a", "p").orderBy(F.desc("score"), "x")
    ranked = local.withColumn("rank", F.row_number().over(by_positive)).where(F.col("rank") <= negatives)
    return ranked.select(
        F.col("a").alias("anchor_id"),
        F.col("p").alias("positive_id"),
        "rank",
        F.col("x").alias("negative_id"),
        F.col("ps").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
