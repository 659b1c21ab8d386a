"""Boosted regression trees by passes over blocks of binned rows.

A row is reduced to one byte per feature, its label and its weight, and rows are stored as blocks of packed
arrays. A level of a tree is one pass: each task adds up weights and residuals per node, feature and bin over its
blocks, and only these sums, whose size depends on features and nodes alone, reach the driver, which picks the
splits. An executor keeps a copy of its blocks, with their forecasts, in mapped files of its own folder for temporary
files, so that a pass is sent the numbers of blocks instead of their rows. A copy that is behind, as after the loss of an
executor, catches up by the trees it misses; a block that has no copy where its task runs is read from the stored ones.
Trees, losses, steps and importances are those of MLlib's ``GBTRegressor``, and what comes out is its model; random
draws differ, and cut points are quantiles of all rows.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from courtside.session import ensure_checkpoint_dir, store, with_package

#: Bins of a feature, as many as ``GBTRegressor`` has.
BINS = 32
#: Rows of a block, rounds between two updates of the kept forecasts, and updates between two broadcasts of all trees
#: (the later ones go with each pass).
BLOCK_ROWS, REFRESH, REBASE = 65_536, 1, 60
#: Bytes of the stored blocks that a task works on at most.
TASK_BYTES = 100_000_000
#: Nodes up to which two features are counted at a time.
PAIRED_NODES = 64
#: From so many tasks on their sums are added up in a few tasks before they reach the driver.
MANY_TASKS = 64
#: Gains below this share of the node's own figure are rounding.
ROUNDING = 1e-12

_BLOCK = "part int, block int, bins binary, label binary, weight binary"
_SUMS = "sums binary, missing binary"
_BINARY = pa.schema([("sums", pa.binary()), ("missing", pa.binary())])


@dataclass
class Tree:
    """A complete tree: feature and highest left bin of every inner node by level, value of every leaf."""

    depth: int
    weight: float
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    #: Weight, sum and sum of squares of the residuals of each node, and what its split gains; None where it was not reached.
    stats: list = field(init=False)
    gain: list = field(init=False)

    def __post_init__(self):
        inner = 2**self.depth - 1
        self.feature, self.cut = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
        self.stats, self.gain = [None] * (2 * inner + 1), [None] * (2 * inner + 1)

    def prediction(self, at: int) -> float:
        weight, total, _ = self.stats[at]
        return float(total / weight) if weight else 0.0

    def values(self) -> np.ndarray:
        """What each leaf adds to the forecast; below a node without a split all rows go left."""
        out = np.zeros(2**self.depth)
        for leaf in range(len(out)):
            at = 2**self.depth - 1 + leaf
            while at and self.stats[at] is None:
                at = (at - 1) // 2
            out[leaf] = self.prediction(at) * self.weight
        return out

    def packed(self) -> tuple:
        return self.feature, self.cut, self.values()


def nodes_of(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """Number of each row's node within a level."""
    node, went = np.zeros(bins.shape[1], np.uint16 if levels > 8 else np.uint8), []
    for level in range(levels):
        choice = [_right(bins, int(feature[at]), int(cut[at])) for at in range(2**level - 1, 2 ** (level + 1) - 1)]
        # Of the sides that the level's nodes give, the one of the row's own node, by the sides taken above.
        for above in reversed(went):
            choice = [low ^ (above & (low ^ high)) for low, high in zip(choice[::2], choice[1::2])]
        went.append(choice[0])
        node <<= 1
        node |= choice[0].view(np.uint8)
    return node


def _right(bins: np.ndarray, feature: int, cut: int) -> np.ndarray:
    return bins[feature] > cut if cut < BINS else np.zeros(bins.shape[1], bool)


def forecast(bins: np.ndarray, before: np.ndarray, trees: Sequence[tuple]) -> np.ndarray:
    for feature, cut, values in trees:
        before = before + values[nodes_of(bins, feature, cut, len(values).bit_length() - 1)]
    return before


def residuals(loss: str, label: np.ndarray, predicted: np.ndarray) -> np.ndarray:
    """What the next tree is fitted to: minus the gradient of the loss."""
    if loss == "absolute":
        return 1.0 - 2.0 * (label < predicted)
    return 2.0 * (label - predicted)


def cut_points(df: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """At most ``BINS - 1`` increasing cut points per feature; a row is left of those it does not exceed.

    Between all values where these are few, else at quantiles of all rows.
    """
    clean = df.select(*[F.when(~F.isnan(c), F.col(c)).alias(f"f{i}") for i, c in enumerate(features)])
    names = clean.columns
    shares = [k / BINS for k in range(1, BINS)]
    counted = clean.agg(
        *[F.approx_count_distinct(c).alias(f"n_{c}") for c in names],
        *[F.percentile_approx(c, shares, 10_000).alias(c) for c in names],
    ).first()
    # The count is rough, so somewhat more are looked at.
    few = [c for c in names if counted[f"n_{c}"] <= 2 * BINS]
    held = clean.agg(*[F.collect_set(c).alias(c) for c in few]).first() if few else {}
    cuts = []
    for c in names:
        values = np.unique(held[c]) if c in few else np.empty(0)
        if c in few and len(values) <= BINS:
            cuts.append((values[:-1] + values[1:]) / 2)
        else:
            cuts.append(np.unique(counted[c] or []))
    return [points.astype(float) for points in cuts]


def to_blocks(df: DataFrame, cuts: Sequence[np.ndarray]) -> DataFrame:
    """Rows of features, label and weight (doubles, in this order) as blocks."""
    count = len(cuts)

    def pack(number: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        table = np.concatenate(parts, axis=1)
        label, weight = table[count], table[count + 1]
        if not np.isfinite(label).all():
            raise ValueError("labels must not be null, NaN or infinite")
        if not (np.isfinite(weight).all() and (weight >= 0).all()):
            raise ValueError("weights must not be null, negative, NaN or infinite")
        bins = np.stack([np.searchsorted(points, table[i]) for i, points in enumerate(cuts)]).astype(np.uint8)
        where = TaskContext.get().partitionId()
        values = [[where], [number], *[[a.tobytes()] for a in (bins, label, weight)]]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in _BLOCK.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, parts = 0, 0, []
        for batch in batches:
            parts.append(np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]))
            held += batch.num_rows
            if held >= BLOCK_ROWS:
                yield pack(number, parts)
                number, held, parts = number + 1, 0, []
        if held:
            yield pack(number, parts)

    return df.mapInArrow(run, _BLOCK)


class Copy:
    """An executor's own copy of a block in a mapped file: what the rows hold, their forecasts and their marks.

    Forecasts before an update are left as they are until the next one, and so are the marks of the round before, so
    that a task that is run again finds what it started from.
    """

    def __init__(self, path: str, features: int):
        self.held = np.memmap(path, np.uint8, "r+")
        rows = (len(self.held) - 16) // (34 + features)
        #: Round whose forecasts are held, and round whose marks are.
        self.head = self.held[:16].view(np.int64)
        numbers = self.held[16 : 16 + 32 * rows].view(np.float64).reshape(4, rows)
        self.label, self.weight, self.forecasts = numbers[0], numbers[1], numbers[2:]
        small = self.held[16 + 32 * rows :].reshape(features + 2, rows)
        self.bins, self.marks = small[:features], small[features:]

    @staticmethod
    def path(key: str, part: int, block: int) -> str:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or tempfile.gettempdir()
        return os.path.join(folder, f"courtside-{key}-{part}-{block}")

    @staticmethod
    def write(path: str, bins: pa.Scalar, label: pa.Scalar, weight: pa.Scalar) -> None:
        """A copy that no tree has been added to; it takes its name when it is whole."""
        rows = len(label.as_buffer()) // 8
        with tempfile.NamedTemporaryFile(dir=os.path.dirname(path), delete=False) as out:
            out.write(np.array([0, -1], np.int64))
            for part in (label.as_buffer(), weight.as_buffer(), bytes(16 * rows), bins.as_buffer(), bytes(2 * rows)):
                out.write(part)
        os.replace(out.name, path)

    def forecast(self, turn: int, trees: Callable[[int, int], Sequence[tuple]]) -> np.ndarray:
        """Forecasts of all trees before a round; ``trees`` gives those of a range of rounds."""
        last = turn - turn % REFRESH
        held, at = int(self.head[0]), last // REFRESH % 2
        if held != last:
            known = 0 <= held < last
            before = self.forecasts[held // REFRESH % 2] if known else np.zeros(len(self.label))
            after = forecast(self.bins, before, trees(held if known else 0, last))
            # What is held counts again when it is whole.
            self.head[0] = -1 if held // REFRESH % 2 == at else held
            self.forecasts[at] = after
            self.head[0] = last
        return forecast(self.bins, self.forecasts[at], trees(last, turn))

    def marked(self, turn: int, draw: Callable, trees: Callable) -> np.ndarray:
        """Per row whether the label is below the forecast (1) and whether the row is drawn (2)."""
        marks = self.marks[turn % 2]
        if self.head[1] != turn:
            marks[:] = (self.label < self.forecast(turn, trees)).view(np.uint8) if turn else 0
            marks |= draw(len(marks)).astype(np.uint8) << 1
            self.head[1] = turn
        return marks


def keep(blocks: DataFrame, key: str) -> DataFrame:
    """Write the copies; the rows that are left are the numbers of the blocks and stay where the copies are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block, *arrays in zip(*batch.columns):
                Copy.write(Copy.path(key, part.as_py(), block.as_py()), *arrays)
            yield batch.select(["part", "block"])

    return blocks.mapInArrow(run, "part int, block int").persist()


def drop(kept: DataFrame, key: str) -> None:
    """Remove the copies; what is left on other executors goes with their folders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in zip(*batch.columns):
                path = Copy.path(key, part.as_py(), block.as_py())
                if os.path.exists(path):
                    os.remove(path)
            yield batch

    kept.mapInArrow(run, "part int, block int").count()
    kept.unpersist()


@dataclass(frozen=True)
class Fit:
    """Fixed settings of one fit."""

    features: int
    cuts: list[np.ndarray]
    loss: str
    depth: int
    subsample: float
    per_node: int
    seed: int
    key: str


class Histograms:
    """Sums of several weights by node, feature and bin, collected block by block."""

    def __init__(self, features: int, nodes: int, wanted: Sequence[int], paired: bool = True):
        self.features, self.nodes = features, nodes
        at_once = 2 if paired and nodes <= PAIRED_NODES else 1
        self.tables = {tuple(wanted[i : i + at_once]): None for i in range(0, len(wanted), at_once)}

    def add(self, bins: np.ndarray, node: np.ndarray, weights: Sequence[np.ndarray]) -> None:
        # Two features are counted as one with the bins of both, whose sums give either.
        first = {len(pair): node.astype(np.intp) * BINS ** len(pair) for pair in self.tables}
        for pair, table in self.tables.items():
            own = bins[pair[0]] if len(pair) == 1 else bins[pair[0]].astype(np.uint16) * BINS + bins[pair[1]]
            own = first[len(pair)] + own
            found = np.stack([np.bincount(own, w, self.nodes * BINS ** len(pair)) for w in weights])
            self.tables[pair] = found if table is None else table + found

    def sums(self, count: int) -> np.ndarray:
        """By weight, feature, node and bin; zero for features that were not wanted."""
        out = np.zeros((count, self.features, self.nodes, BINS))
        for pair, table in self.tables.items():
            if table is not None:
                table = table.reshape(count, self.nodes, *[BINS] * len(pair))
                for k, f in enumerate(pair):
                    out[:, f] = table if len(pair) == 1 else table.sum(axis=3 - k)
        return out


def level_sums(
    fit: Fit, turn: int, tree: Tree, level: int, wanted: Sequence[int], earlier: Broadcast | None, later: Sequence[tuple]
) -> Callable:
    """A pass: weight, residuals and their squares summed by node of the level, feature and bin.

    The batches name blocks, or hold them; named blocks without a copy here are left out and named in what comes out.
    """
    feature, cut = tree.feature, tree.cut
    features, loss, subsample, seed, key = fit.features, fit.loss, fit.subsample, fit.seed, fit.key
    signs = bool(turn and loss == "absolute")
    start = turn - len(later)

    def trees(lo: int, hi: int) -> Sequence[tuple]:
        return [*(earlier.value[lo:hi] if lo < start else ()), *later[max(0, lo - start) : max(0, hi - start)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The first tree's means may equal labels, where rounding decides a sign: they are added up feature by feature.
        found, missing = Histograms(features, 2**level * (2 if signs else 1), wanted, turn > 0), []
        for batch in batches:
            for part, block, *arrays in zip(*batch.columns):
                number = part.as_py(), block.as_py()
                path = Copy.path(key, *number)
                if not os.path.exists(path):
                    if not arrays:
                        missing.append(number)
                        continue
                    Copy.write(path, *arrays)
                copy = Copy(path, features)
                draw = lambda rows: (
                    np.random.default_rng([seed, turn, *number]).random(rows, np.float32) < subsample
                    if subsample < 1
                    else np.ones(rows, bool)
                )
                marks = copy.marked(turn, draw, trees)
                weight = copy.weight * (marks >> 1) if subsample < 1 else copy.weight
                node = nodes_of(copy.bins, feature, cut, level)
                if signs:
                    found.add(copy.bins, node.astype(np.uint16) << 1 | marks & 1, [weight])
                else:
                    left = residuals(loss, copy.label, copy.forecast(turn, trees)) if turn else copy.label
                    weighted = weight * left
                    found.add(copy.bins, node, [weight, weighted, weighted * left])
        if signs:
            above, below = np.moveaxis(found.sums(1)[0].reshape(features, -1, 2, BINS), 2, 0)
            sums = np.stack([above + below, above - below, above + below])
        else:
            sums = found.sums(3)
        values = [[sums.tobytes()], [np.array(missing, np.int32).tobytes()]]
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.binary()) for v in values], schema=_BINARY)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, missing = None, b""
    for batch in batches:
        for value, named in zip(*batch.columns):
            sums = np.frombuffer(value.as_buffer())
            total, missing = sums if total is None else total + sums, missing + named.as_py()
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in (total.tobytes(), missing)], schema=_BINARY)


def summed(kept: DataFrame, stored: DataFrame, run: Callable, shape: tuple[int, ...]) -> np.ndarray:
    """The sums of all tasks; added up in task order, so that a repetition gives the same bits."""
    spark, total = kept.sparkSession, np.zeros(shape)
    blocks = kept
    while blocks is not None:
        sums, missing = blocks.mapInArrow(run, _SUMS), []
        if spark.sparkContext.defaultParallelism > MANY_TASKS:
            sums = sums.repartition(MANY_TASKS // 8).mapInArrow(_added, _SUMS)
        for row in sums.collect():
            total += np.frombuffer(row.sums).reshape(shape)
            missing += np.frombuffer(row.missing, np.int32).reshape(-1, 2).tolist()
        # Blocks without a copy where their task ran: these are read.
        blocks = stored.join(spark.createDataFrame(missing, "part int, block int"), ["part", "block"]) if missing else None
    return total


def grow(
    fit: Fit, turn: int, tree: Tree, kept: DataFrame, stored: DataFrame, earlier: Broadcast | None, later: Sequence[tuple]
) -> None:
    """Fit the tree level by level."""
    for level in range(tree.depth):
        base = 2**level - 1
        open_nodes = [base + k for k in range(2**level) if not level or tree.stats[base + k] is not None]
        if not open_nodes:
            return
        chosen = {}
        for at in open_nodes:
            draw = np.random.default_rng([fit.seed, turn, at])
            chosen[at] = sorted(draw.choice(fit.features, fit.per_node, replace=False).tolist())
        wanted = sorted({f for some in chosen.values() for f in some})
        run = level_sums(fit, turn, tree, level, wanted, earlier, later)
        sums = summed(kept, stored, run, (3, fit.features, 2**level, BINS))
        for at in open_nodes:
            if not level:
                tree.stats[0] = tuple(sums[:, wanted[0], 0].sum(axis=1))
            split(fit, tree, at, sums[:, :, at - base], chosen[at])


def split(fit: Fit, tree: Tree, at: int, sums: np.ndarray, chosen: Sequence[int]) -> None:
    """Take the split of a node that reduces the variance most, if any does."""
    weight, total, _ = tree.stats[at]
    best = None
    for f in chosen:
        left = np.cumsum(sums[:, f], axis=1)[:, : len(fit.cuts[f])]
        right = sums[:, f].sum(axis=1)[:, None] - left
        valid = (left[0] > 0) & (right[0] > ROUNDING * weight)
        if not valid.any():
            continue
        score = np.full(left.shape[1], -np.inf)
        score[valid] = left[1, valid] ** 2 / left[0, valid] + right[1, valid] ** 2 / right[0, valid]
        cut = int(np.argmax(score))
        if best is None or score[cut] > best[0]:
            best = (score[cut], f, cut, tuple(left[:, cut]), tuple(right[:, cut]))
    if best is None:
        return
    own = total**2 / weight
    gain = (best[0] - own) / weight
    if gain * weight <= ROUNDING * max(own, best[0]):
        return
    tree.gain[at] = gain
    tree.feature[at], tree.cut[at] = best[1], best[2]
    tree.stats[2 * at + 1], tree.stats[2 * at + 2] = best[3], best[4]


def boost(
    df: DataFrame, features: Sequence[str], label: str, weight: str | None, loss: str, depth: int, step: float,
    rounds: int, subsample: float = 1.0, colsample: float = 1.0, seed: int = 7,
) -> tuple[list[Tree], list[np.ndarray]]:
    """Fit ``rounds`` trees; returns them with the cut points of the features. A missing feature counts as the highest."""
    with_package(df.sparkSession)
    columns = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features]
    rows = df.select(
        *[c.alias(f"f{i}") for i, c in enumerate(columns)],
        F.col(label).cast("double").alias("label"),
        (F.lit(1.0) if weight is None else F.col(weight).cast("double")).alias("weight"),
    )
    count = len(features)
    cuts = cut_points(rows, rows.columns[:count])
    per_node = count if colsample >= 1 else int(np.ceil(colsample * count))
    fit = Fit(count, cuts, loss, depth, subsample, per_node, seed, uuid.uuid4().hex)
    context = df.sparkSession.sparkContext
    # Dealt evenly, as every pass waits for its slowest task: as many tasks as run at once, or a multiple where they would
    # be large.
    total, slots = rows.count(), context.defaultParallelism
    dealt = min(slots * max(1, -(-total * (count + 16) // (slots * TASK_BYTES))), max(1, total // BLOCK_ROWS))
    stored = store(to_blocks(rows, cuts).repartition(dealt))
    kept, trees, earlier, later = keep(stored, fit.key), [], None, []
    try:
        for turn in range(rounds):
            if turn and turn % (REFRESH * REBASE) == 0:
                if earlier is not None:
                    earlier.destroy()
                earlier, later = context.broadcast([t.packed() for t in trees]), []
            tree = Tree(depth, step if turn else 1.0)
            grow(fit, turn, tree, kept, stored, earlier, later)
            if not turn and not tree.stats[0][0]:
                raise ValueError("no rows to train on, or none with a weight")
            trees.append(tree)
            later = [*later, tree.packed()]
    finally:
        drop(kept, fit.key)
        if earlier is not None:
            earlier.destroy()
    return trees, cuts


def _rows_of(number: int, tree: Tree, cuts: Sequence[np.ndarray]) -> list[tuple]:
    """The nodes of a tree in the form MLlib stores them, parents before children."""
    found = []

    def add(at: int) -> int:
        index, stats = len(found), tree.stats[at]
        found.append(None)
        weight, total, squares = map(float, stats)
        impurity = max(0.0, squares / weight - (total / weight) ** 2) if weight else 0.0
        plain = (index, tree.prediction(at), impurity, [weight, total, squares], -1)
        if tree.gain[at] is None:
            found[index] = (number, (*plain, -1.0, -1, -1, (-1, [], -1)))
        else:
            children = add(2 * at + 1), add(2 * at + 2)
            f = int(tree.feature[at])
            found[index] = (number, (*plain, float(tree.gain[at]), *children, (f, [float(cuts[f][tree.cut[at]])], -1)))
        return index

    add(0)
    return found


def to_model(spark: SparkSession, trees: Sequence[Tree], cuts: Sequence[np.ndarray], params: dict) -> GBTRegressionModel:
    """The trees as MLlib's model, by way of its stored form; a model of two rows gives that form's fixed parts."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    named = {k: params[k] for k in ("featuresCol", "labelCol", "predictionCol")}
    two = [(Vectors.dense([float(k)] * len(cuts)), float(k)) for k in range(2)]
    two = spark.createDataFrame(two, [named["featuresCol"], named["labelCol"]])
    GBTRegressor(maxIter=1, maxDepth=1, **named).fit(two).save(f"{folder}/form")
    about = json.loads(spark.read.text(f"{folder}/form/metadata").first().value)
    about |= {"paramMap": about["paramMap"] | params, "numFeatures": len(cuts), "numTrees": len(trees)}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{folder}/model/metadata")
    each = spark.read.parquet(f"{folder}/form/treesMetadata")
    tree = json.loads(each.first()["_2"])
    tree["paramMap"] |= {"maxDepth": params["maxDepth"]}
    listed = [(n, json.dumps(tree | {"uid": f"{tree['uid']}_{n}"}), t.weight) for n, t in enumerate(trees)]
    spark.createDataFrame(listed, each.schema).coalesce(1).write.parquet(f"{folder}/model/treesMetadata")
    nodes = [row for n, t in enumerate(trees) for row in _rows_of(n, t, cuts)]
    form = spark.read.parquet(f"{folder}/form/data").schema
    spark.createDataFrame(nodes, form).coalesce(1).write.parquet(f"{folder}/model/data")
    return GBTRegressionModel.load(f"{folder}/model")
