"""Near-duplicate documents by circulant MinHash.

Two permutations make the whole signature: one scatters the shingles over 2^32 places, the other is
shifted circularly by 0, 1, 2, ... places, and the least value under each shift is a coordinate. Bands
of coordinates name buckets. Documents with equal shingle sets are one class from the start. In
each bucket the smallest class leads and is compared with the others, which costs one comparison per
member. Only buckets whose members are still in different components after that are looked at
again: cut into chunks of bounded size, any two of which meet in one task, all their sets are compared,
so that no link that could join two components is lost. Every comparison is of full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from courtside.llm.batches import slices
from courtside.llm.components import components
from courtside.llm.shingles import set_digest, shingle_sets
from courtside.session import store

#: Bands and coordinates in each: at a similarity of 0.85 a pair shares no bucket once in 10^8 pairs,
#: at 0.8 three times in 10^6.
BANDS, ROWS = 32, 5
#: Shingles of the sets in a chunk of an undecided bucket, and columns of a membership matrix.
CHUNK_SHINGLES, MATRIX_COLUMNS = 100_000, 4_096


def _shifted_minima(places: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Coordinate k of each set: the least value of the second permutation at its places plus k."""
    out = np.empty((len(starts), BANDS * ROWS), np.uint32)
    x, y = np.empty_like(places), np.empty_like(places)
    for k in range(BANDS * ROWS):
        np.add(places, np.uint32(k), out=x)
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            np.right_shift(x, np.uint32(shift), out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, np.uint32(factor), out=x)
        np.right_shift(x, np.uint32(16), out=y)
        np.bitwise_xor(x, y, out=x)
        out[:, k] = np.minimum.reduceat(x, starts)
    return out


def buckets(sets: list[np.ndarray]) -> list[np.ndarray | None]:
    """Bucket names (one per band) of each set; none for an empty set."""
    full = [i for i, s in enumerate(sets) if len(s)]
    out: list[np.ndarray | None] = [None] * len(sets)
    if full:
        sizes = np.fromiter((len(sets[i]) for i in full), np.int64, len(full))
        # The fingerprints are scrambled bits, so their upper halves are the first permutation.
        places = (np.concatenate([sets[i] for i in full]) >> np.uint64(32)).astype(np.uint32)
        signature = _shifted_minima(places, np.concatenate(([0], np.cumsum(sizes)[:-1])))
        names = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
        for r in range(ROWS):
            names = (names ^ signature[:, r::ROWS].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            names ^= names >> np.uint64(29)
        for i, row in zip(full, names.view(np.int64)):
            out[i] = row
    return out


def signatures(docs: DataFrame, width: int, id_col: str, text: str) -> DataFrame:
    """``id``, ``digest`` of the shingle set, ``n_shingles`` and ``buckets`` of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets([t or b"" for t in batch.column(1).to_pylist()], width)
            sizes = pa.array([len(s) for s in sets], pa.int64())
            digests = pa.array([set_digest(s) for s in sets], pa.binary())
            named = pa.array(buckets(sets), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), digests, sizes, named], names=["id", "digest", "n_shingles", "buckets"]
            )

    data = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").cast("binary").alias("text"))
    kind = data.schema["id"].dataType.simpleString()
    return data.mapInArrow(run, f"id {kind}, digest binary, n_shingles long, buckets array<long>")


def _confirmed(pairs: DataFrame, sources: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose sets are at least ``percent`` similar."""
    sides = [
        sources.select(F.col("node").alias(s), F.col("text").alias(f"text_{s}")) for s in "ab"
    ]
    both = pairs.select("a", "b").join(sides[0], "a").join(sides[1], "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            columns = {c: batch.column(c).to_pylist() for c in batch.schema.names}
            known: dict[bytes, int] = {}
            for s in "ab":
                for t in columns[f"text_{s}"]:
                    known.setdefault(t, len(known))
            sets = shingle_sets(list(known), width)
            linked = []
            for ta, tb in zip(columns["text_a"], columns["text_b"]):
                x, y = sets[known[ta]], sets[known[tb]]
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(run, f"a {kind}, b {kind}")


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``n_shingles``, ``component_id`` and ``kept`` of every row, with its id.

    Documents are linked at ``percent`` of shared distinct shingles of ``width`` words, and
    ``component_id`` is the smallest id reachable. Ids are expected to be unique; of rows that share
    one, each is judged by its own text. A null or empty text has no shingles and is linked with
    nothing. A row with a null id is linked with nothing, has a null component and is kept.
    """
    rows = store(signatures(docs, width, id_col, text))
    # A class stands for all ids with one set; its node is the smallest of them.
    classes = store(
        rows.where("digest IS NOT NULL AND id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("id").alias("node"), F.first("n_shingles").alias("size"), F.first("buckets").alias("buckets"))
    )
    placed = classes.select(F.explode("buckets").alias("bucket"), "node", "size")
    shared = placed.groupBy("bucket").agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = store(placed.join(shared, "bucket").select("bucket", "node", "size", "lead", "n"))

    like = lambda s, z: (100 * F.least(s, z)) >= (F.lit(percent) * F.greatest(s, z))
    led = members.where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b"), "size").distinct()
    sizes = classes.select(F.col("node").alias("a"), F.col("size").alias("size_a"))
    pairs = store(led.join(sizes, "a").where(like(F.col("size"), F.col("size_a"))).select("a", "b").distinct())
    nodes = members.select("node").distinct()
    texts = docs.select(F.col(id_col).alias("node"), F.col(text).cast("string").cast("binary").alias("text"))
    sources = store(nodes.join(texts.where("text IS NOT NULL"), "node"))
    links = store(_confirmed(pairs, sources, width, percent))

    joined = components(links)
    of = members.where("n > 2").join(joined, "node", "left").select(
        "bucket", "node", "size", F.coalesce("component", "node").alias("component")
    )
    mixed = of.groupBy("bucket").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.sum("size").alias("total"),
        F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node")), F.bit_xor(F.hash("node"))).alias("same"),
    )
    # Buckets with the same members are one.
    mixed = mixed.where("low <> high").groupBy("same").agg(F.min("bucket").alias("bucket"), F.first("total").alias("total"))
    undecided = store(of.join(mixed.select("bucket", "total"), "bucket"))
    if not undecided.isEmpty():
        joined = components(links.unionByName(_across(undecided, sources, width, percent)))

    component = classes.select("digest", "node").join(joined, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component_id")
    )
    out = rows.join(component, "digest", "left").withColumn(
        "component_id", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    )
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", kept.alias("kept"))


def _across(undecided: DataFrame, sources: DataFrame, width: int, percent: int) -> DataFrame:
    """Links that join components inside the undecided buckets, as edges of a spanning forest.

    A bucket is cut into chunks of bounded size, and every two chunks meet in one group; small buckets
    share a group. Which sets overlap by how much is counted inside the group, so no pairs are
    written out.
    """
    chunks = F.ceil(F.col("total") / CHUNK_SHINGLES)
    whole = undecided.where(F.col("total") <= CHUNK_SHINGLES).agg(F.sum("size")).first()[0] or 0
    packs = max(1, -(-whole // CHUNK_SHINGLES))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks"))
    placed = undecided.withColumn("chunks", chunks).withColumn("chunk", chunk)
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
    low, high = F.least("chunk", "other"), F.greatest("chunk", "other")
    pack = F.when(F.col("chunks") == 1, F.pmod("bucket", F.lit(packs))).otherwise(F.xxhash64("bucket", low, high))
    rows = placed.select(
        pack.alias("pack"), "bucket", F.struct(low.alias("low"), high.alias("high")).alias("meeting"), "node", "component"
    ).join(sources.select("node", "text"), "node")

    def meet(table: pa.Table) -> pa.Table:
        data = table.to_pydict()
        known = dict(zip(data["node"], data["text"]))
        sets = dict(zip(known, shingle_sets(list(known.values()), width)))
        groups: dict[tuple, dict] = {}
        for bucket, at, node, component in zip(data["bucket"], data["meeting"], data["node"], data["component"]):
            groups.setdefault((bucket, at["low"], at["high"]), {})[node] = component
        edges = {e for g in groups.values() for e in _spanning(g, sets, percent)}
        a, b = zip(*edges) if edges else ((), ())
        return pa.table({"a": pa.array(a, table.schema.field("node").type), "b": pa.array(b, table.schema.field("node").type)})

    kind = rows.schema["node"].dataType.simpleString()
    return store(rows.groupBy("pack").applyInArrow(meet, f"a {kind}, b {kind}"))


def _spanning(group: dict, sets: dict, percent: int) -> Iterator[tuple]:
    """Edges that connect the components of a group wherever two of their sets are linked."""
    nodes = list(group)
    labels = np.unique(np.array([group[n] for n in nodes], dtype=object).astype(str), return_inverse=True)[1]
    if labels.max(initial=0) == 0:
        return
    own = [sets[n] for n in nodes]
    sizes = np.array([len(s) for s in own], np.int64)
    common = _common(own)
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    np.fill_diagonal(linked, False)
    linked &= labels[:, None] != labels[None, :]
    for i in range(len(nodes)):
        # One edge to each component that the node is linked with.
        others = np.flatnonzero(linked[i])
        for j in others[np.unique(labels[others], return_index=True)[1]].tolist():
            yield min(nodes[i], nodes[j]), max(nodes[i], nodes[j])


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by a product of membership matrices over the shared shingles."""
    names, at, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = np.cumsum(often > 1) - 1
    inside = (often > 1)[at]
    row, column = row[inside], shared[at[inside]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.int64)
    total = int(shared[-1]) + 1 if len(names) else 0
    for first in range(0, total, MATRIX_COLUMNS):
        lo, hi = np.searchsorted(column, (first, first + MATRIX_COLUMNS))
        holds = np.zeros((len(sets), min(MATRIX_COLUMNS, total - first)), np.float32)
        holds[row[lo:hi], column[lo:hi] - first] = 1.0
        out += (holds @ holds.T).astype(np.int64)
    return out
