"""Packing of token sequences by a configuration linear program.

A configuration is a multiset of piece lengths that fits one sequence. Over the histogram of lengths
the program asks for the fewest configurations that cover every length as often as it occurs. It is
solved by multiplicative weights: a length weighs less the more of it is covered, a
knapsack dynamic program finds the configuration of the highest price, fill first, and that
configuration is used a whole number of times, so each step is rounded as it is made; the step
shrinks as the remaining counts do. What no well-filled configuration takes is packed best fit
decreasing, again on counts. Pieces then find their places by their rank among the pieces of their
length, without any pass over all of them in one task.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from courtside.llm.batches import slices
from courtside.session import store

#: Lengths that one pricing looks at, classes of lengths that share a weight, and pricings at one step size.
PRICED, CLASSES, ROUNDS = 256, 64, 1000
#: Rates at which weights fall with coverage, and by how much a configuration may be emptier than the mean.
FALL, SLACK, WASTE = (1.0, 4.0, 30.0), 2.0, 8
#: Words a worker remembers in a generation, those it keeps between tasks, and the longest that it remembers.
CACHE_ENTRIES, KEPT_ENTRIES, CACHE_BYTES = 500_000, 100_000, 64
#: Signs that may stand between words in the tokenizer, and words that go through it at a time.
BORDERS, JOINED = "§¶¤¬|", 1000


class Words:
    """Token ids of texts, word by word: the vocabulary drops white space and never joins over it.

    New words go through the tokenizer many at a time, with a sign between them that is one token and
    is in none of them. What the last words were is remembered in two generations, and a part of the
    newer one, the words that came first, goes over to the next task. A text that holds an added token of
    the vocabulary, which is one id wherever it stands, is encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        # For words of texts without an added token; lower-casing must not make one.
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.border, self.border_id = next(
            (sign, ids[0]) for sign in BORDERS if len(ids := self.tokenizer.encode(sign, add_special_tokens=False).ids) == 1
        )
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of words of which none has the border sign."""
        if not words:
            return []
        # The fast call leaves out where in the text the tokens stand.
        whole = self.tokenizer.encode_batch_fast([f" {self.border} ".join(words)], add_special_tokens=False)[0]
        ids = np.array(whole.ids, "<u4")
        at = np.flatnonzero(ids == self.border_id)
        data, starts, stops = ids.tobytes(), [0, *((at + 1) * 4).tolist()], [*(at * 4).tolist(), 4 * len(ids)]
        return [data[a:b] for a, b in zip(starts, stops)]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        whole = {i for i, t in enumerate(texts) if any(a in t for a in self.added)}
        # The tokenizer lower-cases as well, so that words which differ in A-Z only are one.
        split = [[] if i in whole else t.lower().split() for i, t in enumerate(texts)]
        if len(self.cache) > CACHE_ENTRIES:
            self.cache, self.older = {}, self.cache
        cache = self.cache
        unknown = self._unknown(set(chain.from_iterable(split)).difference(cache))
        parts = {w: _parts(w) for w in unknown}
        new = self._unknown({p for w, both in parts.items() if len(both) > 1 for p in both if p not in cache})
        new += [w for w, both in parts.items() if len(both) == 1]
        border = self.border.encode()
        plain = [w for w in new if border not in w]
        for i in range(0, len(plain), JOINED):
            some = plain[i : i + JOINED]
            cache.update(zip(some, self._ids([w.decode("utf-8") for w in some])))
        for w in new:
            if border in w:
                ids = self.tokenizer.encode(w.decode("utf-8"), add_special_tokens=False).ids
                cache[w] = np.array(ids, "<u4").tobytes()
        for w, both in parts.items():
            if len(both) > 1:
                cache[w] = cache[both[0]] + cache[both[1]]
        out = [b"".join(map(cache.__getitem__, words)) for words in split]
        for i in whole:
            ids = self.whole.encode(texts[i].decode("utf-8"), add_special_tokens=False).ids
            out[i] = np.array(ids, "<u4").tobytes()
        for w in {*unknown, *new}:
            if len(w) > CACHE_BYTES:
                del cache[w]
        return out

    def forget(self) -> None:
        """Release most words, as the worker may go on with other work; frequent ones tend to come first."""
        self.cache, self.older = dict(islice(self.cache.items(), KEPT_ENTRIES)), {}

    def _unknown(self, words: set[bytes]) -> list[bytes]:
        """The words that are remembered in neither generation; those of the older one are kept."""
        out = []
        for w in words:
            if w in self.older:
                self.cache[w] = self.older[w]
            else:
                out.append(w)
        return out


def _parts(word: bytes) -> tuple[bytes, ...]:
    """A word without the marks at its end, and these: the tokenizer always splits there."""
    stem = word.rstrip(b".,!?;:*$%&#")
    return (stem, word[len(stem) :]) if stem != word and stem[-1:].isalnum() else (word,)


_WORDS: dict[str, Words] = {}


def _words(path: str) -> Words:
    if path not in _WORDS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _WORDS[path] = Words(path)
    return _WORDS[path]


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str, text: str) -> DataFrame:
    """Token pieces of every document, numbered within their task and length.

    ``id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``part`` (the task) and ``nth`` (how many
    pieces of that length the task had before).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, part = _words(path), Counter(), TaskContext.get().partitionId()
        end = end_id.to_bytes(4, "little")
        for batch in slices(batches):
            rows = []
            for i, ids in enumerate(words.encode([t or b"" for t in batch.column(1).to_pylist()])):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    n = len(cut) // 4
                    rows.append((i, piece, at // 4, n, zlib.crc32(cut), seen[n]))
                    seen[n] += 1
            at, piece, start, length, crc, nth = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                    pa.array([part] * len(rows), pa.int32()),
                    pa.array(nth, pa.int64()),
                ],
                names=["id", "piece", "start", "length", "ids_crc32", "part", "nth"],
            )
        words.forget()

    data = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").cast("binary").alias("text"))
    kind = data.schema["id"].dataType.simpleString()
    return data.mapInArrow(
        run, f"id {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long"
    )


def price(lengths: np.ndarray, most: np.ndarray, values: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration of the highest value: a knapsack with ``most`` copies of each length."""
    items = []
    for at, (length, count) in enumerate(zip(lengths.tolist(), most.tolist())):
        copies = 1
        while count > 0:
            take = min(copies, count)
            if take * length > capacity:
                break
            items.append((at, take, take * length, take * values[at]))
            count -= take
            copies *= 2
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(items), capacity + 1), bool)
    for row, (_, _, size, value) in enumerate(items):
        other = best[: capacity + 1 - size] + value
        better = other > best[size:]
        taken[row, size:] = better
        np.copyto(best[size:], other, where=better)
    room, chosen = int(best.argmax()), Counter()
    for row in range(len(items) - 1, -1, -1):
        if taken[row, room]:
            at, copies, size, _ = items[row]
            chosen[int(lengths[at])] += copies
            room -= size
    return dict(chosen)


@dataclass(frozen=True)
class Group:
    """``count`` sequences with the same lengths in them."""

    lengths: tuple[tuple[int, int], ...]
    count: int


def configurations(histogram: dict[int, int], capacity: int) -> list[Group]:
    """Groups of sequences that hold every length of the histogram exactly as often as it occurs.

    The program is solved at each rate of ``FALL``; the solution with the fewest sequences counts.
    """
    return min((_solved(histogram, capacity, fall) for fall in FALL), key=lambda groups: sum(g.count for g in groups))


def _solved(histogram: dict[int, int], capacity: int, fall: float) -> list[Group]:
    left = {n: c for n, c in histogram.items() if c > 0}
    groups = [Group(((capacity, 1),), left.pop(capacity))] if capacity in left else []
    sizes = np.array(sorted(left), np.int64)
    counts = np.array([left[n] for n in sizes.tolist()], np.int64)
    total, at = counts.copy(), {int(n): i for i, n in enumerate(sizes)}
    tokens = int((sizes * counts).sum())
    classes = np.unique((sizes - 1) * CLASSES // capacity, return_inverse=True)[1]
    in_class = np.bincount(classes, sizes * counts)
    step, used, rounds = max(1, tokens // capacity // ROUNDS), 0, 0
    fills: list[int] = []
    while step:
        for _ in range(ROUNDS):
            there = np.flatnonzero(counts >= step)
            if not len(there):
                break
            # A class of lengths weighs more the further its coverage lags behind that of all tokens.
            open_share = np.bincount(classes, sizes * counts) / in_class
            weight = np.exp(fall * (used / tokens - 1 + open_share))[classes[there]]
            if len(there) > PRICED:
                # Of each class the lengths that lag most, as many of each.
                order = np.lexsort((-counts[there] / total[there], classes[there]))
                own = classes[there][order]
                nth = np.arange(len(own)) - np.searchsorted(own, own)
                keep = np.sort(order[nth < PRICED // CLASSES])
                there, weight = there[keep], weight[keep]
            most = np.minimum(counts[there] // step, capacity // sizes[there])
            found = price(sizes[there], most, sizes[there] * weight, capacity)
            fill = sum(n * c for n, c in found.items())
            if len(fills) > 20 and capacity - fill > SLACK * (capacity - sum(fills) / len(fills)) + WASTE:
                break
            fills.append(fill)
            groups.append(Group(tuple(found.items()), step))
            used += fill * step
            for n, c in found.items():
                counts[at[n]] -= c * step
        step //= 2
    rest = {int(n): int(c) for n, c in zip(sizes, counts) if c}
    return groups + best_fit(rest, capacity)


def best_fit(histogram: dict[int, int], capacity: int) -> list[Group]:
    """Best fit decreasing on counts: equal sequences are handled together."""
    rooms: list[int] = []
    by_room: dict[int, list[Group]] = {}

    def put(room: int, group: Group) -> None:
        if room not in by_room:
            bisect.insort(rooms, room)
            by_room[room] = []
        by_room[room].append(group)

    for n in sorted(histogram, reverse=True):
        count = histogram[n]
        while count:
            i = bisect.bisect_left(rooms, n)
            if i == len(rooms):
                fit = capacity // n
                for copies, bins in ((fit, count // fit), (count % fit, 1)):
                    if copies and bins:
                        put(capacity - copies * n, Group(((n, copies),), bins))
                break
            room = rooms[i]
            group = by_room[room].pop()
            used = min(count, group.count)
            if used < group.count:
                by_room[room].append(Group(group.lengths, group.count - used))
            elif not by_room[room]:
                del by_room[room], rooms[i]
            put(room - n, Group((*group.lengths, (n, 1)), used))
            count -= used
    return [g for groups in by_room.values() for g in groups]


def slots(groups: list[Group]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length the runs of ranks that a group takes: first rank, sequence, copies, offset."""
    taken: Counter = Counter()
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for group in groups:
        offset = 0
        for n, copies in group.lengths:
            runs.setdefault(n, []).append((taken[n], sequence, copies, offset))
            taken[n] += copies * group.count
            offset += n * copies
        sequence += group.count
    return {n: tuple(np.array(c, np.int64) for c in zip(*r)) for n, r in runs.items()}


def pack(
    docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of all documents with the sequence and the offset that each is placed at.

    A null or empty text is the end id alone. Only documents longer than ``capacity`` are cut. Rows
    that repeat are packed each. The histogram has at most ``capacity`` lengths, and the runs that are
    broadcast follow the number of configurations, not of pieces: at most ``ROUNDS`` per step size,
    and what best fit gets is less than one step of the smallest size can fill.
    """
    rows = store(pieces(docs, path, capacity, end_id, id_col, text))
    found = rows.groupBy("part", "length").agg((F.max("nth") + 1).alias("n"))
    found = store(found)
    histogram = {r.length: r.n for r in found.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = rows.sparkSession.sparkContext.broadcast(slots(configurations(histogram, capacity)))

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = found.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).select("part", "length", "first")
    ranked = rows.join(first, ["part", "length"]).withColumn("rank", F.col("first") + F.col("nth"))
    columns = ["id", "piece", "start", "length", "ids_crc32"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            borders = np.flatnonzero(np.diff(length[order])) + 1
            for own in np.split(order, borders):
                if len(own):
                    n = int(length[own[0]])
                    lows, sequences, copies, offsets = places.value[n]
                    run = np.searchsorted(lows, rank[own], "right") - 1
                    inside = rank[own] - lows[run]
                    sequence[own] = sequences[run] + inside // copies[run]
                    offset[own] = offsets[run] + (inside % copies[run]) * n
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)],
                names=[*columns, "sequence_id", "offset"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    placed = ranked.select(*columns, "rank").mapInArrow(
        place,
        f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
    return placed.withColumnRenamed("id", id_col)
