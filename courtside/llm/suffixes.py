"""Removal of repeated byte strings by a distributed merge of sorted, front-coded suffix runs.

A byte goes if a string of ``span`` bytes that covers it also starts elsewhere. Documents are laid
together in blocks. Where to look is decided by content: of the ``gram``-byte strings in each window of
``span`` bytes the one with the least hash is its anchor, so equal windows have their anchor at the
same place, and only anchors whose gram occurs twice can matter. Around these the blocks
make suffixes: what follows an anchor, up to ``span`` bytes, and what precedes it, read backwards.

Suffixes are sorted in every block, cut into runs by gram, and sent front-coded: the length of the
prefix shared with the suffix before, and the rest. Each receiving task merges its runs with a
loser tree whose entries carry the prefix length that they share with the last winner; it decides by
these lengths, looks at letters beyond the shared prefix only, and yields the order with the shared
lengths of neighbours. From the two orders it follows exactly which windows around an anchor occur
again: for a start ``d`` bytes before the anchor, those that agree on ``d`` bytes backwards and on
the remaining bytes forwards.

An anchor that occurs very often is not left to one task: there each window is a suffix of its own,
sent by its content, and equal windows of a block travel as one with their number.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from courtside.llm.batches import slices
from courtside.llm.shingles import Powers, mix
from courtside.session import ensure_checkpoint_dir, store

#: Bytes of a repeated string and of the grams that anchor it.
SPAN, GRAM = 200, 50
#: Bytes of documents in a block, and of suffixes that one merging task is meant to get.
BLOCK_BYTES, RUN_BYTES = 1_000_000, 4_000_000
#: An anchor gram that occurs more often is spread by its windows.
HOT = 5_000
#: Text bytes of a bucket of blocks, and fewest and most buckets.
BUCKET_BYTES, MIN_BUCKETS, MAX_BUCKETS = 16_000_000, 96, 100_000

_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_POWERS = Powers(0xA0761D6478BD642F)


# --- blocks of documents ------------------------------------------------------------------


def blocks(docs: DataFrame, columns: Sequence[str], text: str) -> DataFrame:
    """Documents laid together: ``block``, ``data``, ``lengths`` and one array for each column.

    Written once, bucketed by block, so that later joins by block do not shuffle the texts.
    """
    keep = [f"c{i}" for i in range(len(columns))]
    data = docs.select(*[F.col(c).alias(k) for c, k in zip(columns, keep)], F.col(text).cast("string").cast("binary").alias("text"))
    kinds = ", ".join(f"{k} array<{data.schema[k].dataType.simpleString()}>" for k in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        parts: list[pa.RecordBatch] = []
        size = 0
        for batch in slices(batches, 20):
            more = batch.column(len(keep)).nbytes
            if parts and size + more > BLOCK_BYTES:
                yield _block(parts, keep, first + made)
                parts, size, made = [], 0, made + 1
            parts.append(batch)
            size += more
        if parts:
            yield _block(parts, keep, first + made)

    spark = docs.sparkSession
    size = data.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(MAX_BUCKETS, max(MIN_BUCKETS, -(-size // BUCKET_BYTES)))
    name = f"blocks_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    made = data.mapInArrow(run, f"block long, data binary, lengths array<int>{', ' + kinds if kinds else ''}")
    made.write.bucketBy(buckets, "block").option("path", path).saveAsTable(name)
    return spark.table(name)


def _block(parts: list[pa.RecordBatch], keep: list[str], block: int) -> pa.RecordBatch:
    table = pa.Table.from_batches(parts)
    texts = [t or b"" for t in table.column("text").to_pylist()]
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    columns = [one(table.column(k).combine_chunks()) for k in keep]
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([b"".join(texts)], pa.binary()), one(pa.array(map(len, texts), pa.int32())), *columns],
        names=["block", "data", "lengths", *keep],
    )


# --- anchors -------------------------------------------------------------------------------


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """Least (greatest) value of every ``width`` neighbours."""
    reach = 1
    while 2 * reach <= width:
        values = best(values[:-reach], values[reach:])
        reach *= 2
    return best(values[: len(values) - (width - reach)], values[width - reach :]) if reach < width else values


class Anchors:
    """Anchors of the documents of a block: where they are and the hashes of their grams."""

    def __init__(self, data: bytes, lengths: np.ndarray, span: int, gram: int):
        self.data, self.span, self.windows = data, span, span - gram + 1
        self.stops = np.cumsum(lengths, dtype=np.int64)
        self.starts = self.stops - lengths
        signs = np.frombuffer(data, np.uint8)
        count = len(signs) - gram + 1
        if count < self.windows:
            self.at, self.grams = np.zeros(0, np.int64), np.zeros(0, np.uint64)
            self.least = self.order = np.zeros(0, np.uint32)
            return
        up, down = _POWERS.upto(len(signs) + 1)
        sums = np.zeros(len(signs) + 1, np.uint64)
        np.cumsum(_BYTES[signs] * up[: len(signs)], dtype=np.uint64, out=sums[1:])
        hashes = mix((sums[gram:] - sums[:count]) * down[:count])
        # Zero is kept for windows that no document holds.
        self.order = (hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        self.least = _sliding(self.order, self.windows, np.minimum)
        whole = np.zeros(len(self.least) + 1, np.int32)
        fits = self.stops - self.starts >= span
        np.add.at(whole, self.starts[fits], 1)
        np.add.at(whole, self.stops[fits] - span + 1, -1)
        self.least[np.cumsum(whole[:-1]) == 0] = 0
        edge = np.zeros(self.windows - 1, np.uint32)
        chosen = _sliding(np.concatenate((edge, self.least, edge)), self.windows, np.maximum)
        self.at = np.flatnonzero(chosen == self.order)
        self.grams = hashes[self.at]

    def around(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes available before (short of a whole span) and from each place, in its document."""
        own = np.searchsorted(self.stops, at, "right")
        return np.minimum(at - self.starts[own], self.windows - 1), np.minimum(self.stops[own] - at, self.span)

    def window_starts(self, at: np.ndarray) -> np.ndarray:
        """Starts of all windows that have one of the given anchors."""
        found = []
        for some in np.array_split(at, max(1, len(at) // 4096)):
            places = some[:, None] - np.arange(self.windows)[None, :]
            inside = (places >= 0) & (places < len(self.least))
            own = inside & (self.least[np.where(inside, places, 0)] == self.order[some][:, None])
            found.append(places[own])
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _read(row: dict, span: int, gram: int) -> Anchors:
    return Anchors(row["data"], np.asarray(row["lengths"], np.int64), span, gram)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        yield batch


# --- suffixes of a block -------------------------------------------------------------------


class Units:
    """Distinct suffix pairs of a block, each with its number and places, and the part it is sent to."""

    def __init__(self, anchors: Anchors, grams: np.ndarray, hot: np.ndarray, parts: int, hot_parts: int):
        known = np.argsort(grams)
        grams, hot = grams[known], hot[known]
        spot = np.minimum(np.searchsorted(grams, anchors.grams), max(0, len(grams) - 1))
        match = grams[spot] == anchors.grams if len(grams) else np.zeros(len(anchors.grams), bool)
        at, own, often = anchors.at[match], anchors.grams[match], hot[spot[match]] if len(grams) else match[match]
        data, back = anchors.data, anchors.data[::-1]
        n = len(data)
        self.right: list[bytes] = []
        self.left: list[bytes] = []
        self.part: list[int] = []
        index: dict = {}
        places, unit = [], []
        before, after = anchors.around(at[~often])
        for p, b, a, g in zip(at[~often].tolist(), before.tolist(), after.tolist(), own[~often].tolist()):
            key = (data[p : p + a], back[n - p : n - p + b])
            u = index.get(key)
            if u is None:
                u = index[key] = len(index)
                self.right.append(key[0])
                self.left.append(key[1])
                self.part.append(g % parts)
            places.append(p)
            unit.append(u)
        for p in anchors.window_starts(at[often]).tolist() if often.any() else ():
            window = data[p : p + anchors.span]
            u = index.get(window)
            if u is None:
                u = index[window] = len(index)
                self.right.append(window)
                self.left.append(b"")
                self.part.append(parts + (zlib.crc32(window) * 0x9E3779B1 >> 12) % hot_parts)
            places.append(p)
            unit.append(u)
        self.places, self.unit = np.array(places, np.int64), np.array(unit, np.int64)
        self.count = np.bincount(self.unit, minlength=len(index)).astype(np.uint32)

    def runs(self) -> Iterator[tuple[int, bytes]]:
        """The sorted runs of each part, front-coded."""
        by_part: dict[int, list[int]] = {}
        for u, p in enumerate(self.part):
            by_part.setdefault(p, []).append(u)
        for part, units in by_part.items():
            coded = [np.array(units, "<u4").tobytes(), self.count[units].astype("<u4").tobytes()]
            for strings in (self.right, self.left):
                order = sorted(range(len(units)), key=lambda i: strings[units[i]])
                coded += front_code([strings[units[i]] for i in order])
                coded.append(np.array(order, "<u4").tobytes())
            sizes = np.array([len(c) for c in coded], "<u4").tobytes()
            yield part, zlib.compress(sizes + b"".join(coded), 1)


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return n - ((int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])).bit_length() + 7) // 8


def front_code(strings: list[bytes]) -> list[bytes]:
    """Shared prefix lengths, lengths of the rests, and the rests of sorted strings."""
    shared, before = [], b""
    for s in strings:
        shared.append(common(before, s))
        before = s
    rests = [s[h:] for s, h in zip(strings, shared)]
    return [np.array(shared, "<u2").tobytes(), np.array([len(r) for r in rests], "<u2").tobytes(), b"".join(rests)]


class Run:
    """A received run: units, numbers, and the two sorted sequences with their shared lengths."""

    def __init__(self, coded: bytes):
        raw = zlib.decompress(coded)
        sizes = np.frombuffer(raw, "<u4", 10)
        ends = 40 + np.cumsum(sizes)
        piece = [raw[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist())]
        self.units, self.count = np.frombuffer(piece[0], "<u4"), np.frombuffer(piece[1], "<u4")
        self.sides = [self._decode(*piece[2:6]), self._decode(*piece[6:10])]

    @staticmethod
    def _decode(shared: bytes, sizes: bytes, rests: bytes, order: bytes) -> tuple[list[bytes], list[int], np.ndarray]:
        heads, strings, at, before = np.frombuffer(shared, "<u2").tolist(), [], 0, b""
        for h, n in zip(heads, np.frombuffer(sizes, "<u2").tolist()):
            before = before[:h] + rests[at : at + n]
            at += n
            strings.append(before)
        return strings, heads, np.frombuffer(order, "<u4")


# --- merge ---------------------------------------------------------------------------------


def merge(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int], list[int]]:
    """Merge sorted runs of (strings, shared lengths with the string before).

    Returns for each string in order its run, its place in it, and the length it shares with the
    string before. A loser tree: each entry knows how much it shares with the string that beat it, so
    the entry that shares more is the smaller one, and letters are looked at beyond that length only.
    """
    width = 1
    while width < len(runs):
        width *= 2
    heads: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (width - len(runs))
    shared = [0 if h is not None else -1 for h in heads]
    place = [0] * width
    loser = [0] * width

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser, and what the loser shares with the winner."""
        x, y = shared[a], shared[b]
        if x != y or x < 0:
            return (a, b) if x >= y else (b, a)
        rest_a, rest_b = heads[a][x:], heads[b][x:]
        n = common(rest_a, rest_b)
        if rest_a[n : n + 1] <= rest_b[n : n + 1]:
            shared[b] = x + n
            return a, b
        shared[a] = x + n
        return b, a

    def build(node: int) -> int:
        if node >= width:
            return node - width
        winner, loser[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1) if width > 1 else 0
    of_run, of_place, lengths = [], [], []
    while shared[winner] >= 0:
        of_run.append(winner)
        i = place[winner]
        of_place.append(i)
        lengths.append(shared[winner])
        strings, heights = runs[winner]
        i += 1
        place[winner] = i
        if i < len(strings):
            heads[winner], shared[winner] = strings[i], heights[i]
        else:
            heads[winner], shared[winner] = None, -1
        node = (winner + width) >> 1
        while node:
            other = loser[node]
            x, y = shared[winner], shared[other]
            if x < y:
                loser[node], winner = winner, other
            elif x == y and x >= 0:
                winner, loser[node] = play(winner, other)
            node >>= 1
    return of_run, of_place, lengths


def repeated(runs: list[Run], span: int, windows: int) -> np.ndarray:
    """For each unit (run after run) and each distance, whether that window occurs again."""
    offsets = np.cumsum([0] + [len(r.units) for r in runs])
    total = int(offsets[-1])
    ranks, heights, sizes = [], [], []
    for side in (0, 1):
        of_run, of_place, shared = merge([r.sides[side][:2] for r in runs])
        local = [r.sides[side][2] for r in runs]
        unit = np.fromiter((offsets[r] + local[r][i] for r, i in zip(of_run, of_place)), np.int64, total)
        size = np.empty(total, np.int64)
        size[unit] = np.fromiter((len(runs[r].sides[side][0][i]) for r, i in zip(of_run, of_place)), np.int64, total)
        rank = np.empty(total, np.int64)
        rank[unit] = np.arange(total)
        ranks.append(rank)
        heights.append(np.array(shared, np.int64))
        sizes.append(size)
    count = np.concatenate([r.count for r in runs]).astype(np.int64)
    out = np.zeros((total, windows), bool)
    for d in range(min(windows - 1, int(sizes[1].max())) + 1):
        fits = np.flatnonzero((sizes[0] >= span - d) & (sizes[1] >= d))
        if not len(fits):
            continue
        ahead = np.cumsum(heights[0] < span - d)[ranks[0][fits]]
        behind = np.cumsum(heights[1] < d)[ranks[1][fits]]
        key = ahead * (total + 1) + behind
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], np.diff(key[order]) != 0)))
        often = np.add.reduceat(count[fits][order], first) >= 2
        out[fits[order], d] = np.repeat(often, np.diff(np.concatenate((first, [len(order)]))))
    return out


# --- the operator --------------------------------------------------------------------------


def remove_repeats(
    docs: DataFrame,
    columns: Sequence[str],
    text: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
    hot: int = HOT,
    characters: bool = False,
) -> DataFrame:
    """The named columns of every row with ``n_bytes``, ``spans`` and ``kept``.

    ``spans`` are the removed byte intervals as start, end, start, end, ...; ``kept`` are the other bytes
    in order. All copies of a repeated string go, the first one included; strings are judged on the
    input. With ``characters`` a span is narrowed to whole characters, so that ``kept`` stays UTF-8. A null
    text is empty, and a text shorter than ``span`` is left whole. Repeated rows repeat
    each other's text. Columns not named are not carried.
    """
    windows = span - gram + 1
    laid = blocks(docs, columns, text)
    keep = [f"c{i}" for i in range(len(columns))]

    def list_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _rows(batches):
            row = batch.to_pylist()[0]
            grams, n = np.unique(_read(row, span, gram).grams, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams.view(np.int64)), pa.array(np.full(len(grams), row["block"], np.int64)), pa.array(n.astype(np.int64))],
                names=["gram", "block", "n"],
            )

    grams = laid.select("block", "data", "lengths").mapInArrow(list_grams, "gram long, block long, n long")
    total = F.sum("n").over(Window.partitionBy("gram"))
    shared = grams.withColumn("total", total).where("total > 1")
    wanted = store(
        shared.groupBy("block").agg(
            F.collect_list(F.struct("gram", (F.col("total") > hot).alias("hot"))).alias("wanted"),
            F.sum(F.when(F.col("total") > hot, 0).otherwise(F.col("n"))).alias("cold"),
            F.sum(F.when(F.col("total") > hot, F.col("n")).otherwise(0)).alias("hot"),
        )
    )
    cold, often = wanted.agg(F.sum("cold"), F.sum("hot")).first()
    parts = max(64, (cold or 0) * (span + windows) // RUN_BYTES)
    hot_parts = max(64, (often or 0) * windows * span // (8 * RUN_BYTES))
    wanted = wanted.select("block", F.col("wanted.gram").alias("grams"), F.col("wanted.hot").alias("often"))

    def units_of(row: dict) -> tuple[Anchors, Units]:
        anchors = _read(row, span, gram)
        grams = np.array(row["grams"], np.int64).view(np.uint64)
        return anchors, Units(anchors, grams, np.array(row["often"], bool), parts, hot_parts)

    def make_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _rows(batches):
            row = batch.to_pylist()[0]
            sent = list(units_of(row)[1].runs())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p for p, _ in sent], pa.int32()),
                    pa.array([row["block"]] * len(sent), pa.int64()),
                    pa.array([c for _, c in sent], pa.binary()),
                ],
                names=["part", "block", "run"],
            )

    def judge(table: pa.Table) -> pa.Table:
        owners = table.column("block").to_pylist()
        runs = [Run(c) for c in table.column("run").to_pylist()]
        marks = repeated(runs, span, windows)
        at, out = 0, []
        for block, run in zip(owners, runs):
            own = marks[at : at + len(run.units)]
            at += len(run.units)
            some = own.any(axis=1)
            if some.any():
                out.append((block, run.units[some].astype("<u4").tobytes(), np.packbits(own[some], axis=1).tobytes()))
        block, units, bits = zip(*out) if out else ((), (), ())
        return pa.table(
            {"block": pa.array(block, pa.int64()), "units": pa.array(units, pa.binary()), "bits": pa.array(bits, pa.binary())}
        )

    # Hashing what is small per bucket streams the blocks past it; a merge would sort rows of a megabyte.
    with_grams = laid.select("block", "data", "lengths").join(wanted.hint("shuffle_hash"), "block")
    runs = with_grams.mapInArrow(make_runs, "part int, block long, run binary")
    judged = store(runs.groupBy("part").applyInArrow(judge, "block long, units binary, bits binary"))
    marked = judged.groupBy("block").agg(F.collect_list("units").alias("units"), F.collect_list("bits").alias("bits"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _rows(batches):
            own = batch.select(["data", "lengths", "grams", "often", "units", "bits"]).to_pylist()[0]
            lengths = np.asarray(own["lengths"], np.int64)
            covered = np.zeros(len(own["data"]) + 1, np.int32)
            if own["units"]:
                _mark(covered, units_of(own)[1], own["units"], own["bits"], windows, span)
            gone = np.cumsum(covered[:-1]) > 0
            data, spans, kept, at = np.frombuffer(own["data"], np.uint8), [], [], 0
            for n in lengths.tolist():
                own_gone = gone[at : at + n]
                if own_gone.any():
                    steps = np.diff(np.concatenate(([0], own_gone.astype(np.int8), [0])))
                    edges = np.flatnonzero(steps)
                    if characters:
                        edges = _whole_characters(data[at : at + n], edges)
                        own_gone = np.cumsum(np.bincount(edges, np.resize([1, -1], len(edges)), n + 1)[:n]) > 0
                    spans.append(edges.tolist())
                    kept.append(data[at : at + n][~own_gone].tobytes())
                else:
                    spans.append([])
                    kept.append(own["data"][at : at + n])
                at += n
            carried = [batch.column(k).flatten() for k in keep]
            yield pa.RecordBatch.from_arrays(
                [*carried, pa.array(lengths, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(kept, pa.binary())],
                names=[*keep, "n_bytes", "spans", "kept"],
            )

    kinds = [f"{k} {laid.schema[k].dataType.elementType.simpleString()}" for k in keep]
    whole = laid.join(wanted.hint("shuffle_hash"), "block", "left").join(marked.hint("shuffle_hash"), "block", "left")
    done = whole.mapInArrow(cut, ", ".join([*kinds, "n_bytes long", "spans array<int>", "kept binary"]))
    return done.withColumnsRenamed(dict(zip(keep, columns)))


def _whole_characters(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Spans without the parts of characters at their ends; a span within one character goes."""
    opens = np.flatnonzero((data & 0xC0) != 0x80)
    borders = np.append(opens, len(data))
    start = borders[np.searchsorted(borders, edges[0::2], "left")]
    stop = borders[np.searchsorted(borders, edges[1::2], "right") - 1]
    some = start < stop
    return np.column_stack((start[some], stop[some])).ravel()


def _mark(covered: np.ndarray, units: Units, names: list[bytes], bits: list[bytes], windows: int, span: int) -> None:
    """Add the intervals of the repeated windows of a block to a difference array."""
    order = np.argsort(units.unit, kind="stable")
    place, first = units.places[order], np.concatenate(([0], np.cumsum(units.count, dtype=np.int64)))
    for name, packed in zip(names, bits):
        own = np.frombuffer(name, "<u4").astype(np.int64)
        marks = np.unpackbits(np.frombuffer(packed, np.uint8).reshape(len(own), -1), axis=1)[:, :windows].astype(np.int8)
        steps = np.diff(np.pad(marks, ((0, 0), (1, 1))), axis=1)
        row, low = np.nonzero(steps == 1)
        high = np.nonzero(steps == -1)[1] - 1
        unit = own[row]
        n = units.count[unit].astype(np.int64)
        index = np.repeat(first[unit] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        at = place[index]
        np.add.at(covered, at - np.repeat(high, n), 1)
        np.add.at(covered, at - np.repeat(low, n) + span, -1)
