"""Exact top-k search by inner product with a three-phase uniform threshold.

The dimensions are cut into lists; the score of a pair is the sum of its partial scores over the
lists. Phase one gathers the best partial scores of every list, scores what they name exactly
and takes the k-th best as a safe cutoff. A pair whose partial scores are all below cutoff divided by
the number of lists cannot reach it, so in phase two each list sends only its entries from there
on. Phase three scores the pairs sent exactly. The work is done on blocks of queries against
blocks of rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from courtside.session import store

#: Rows and queries of a block, and lists into which the dimensions are cut.
BLOCK_ROWS, BLOCK_QUERIES, LISTS = 1024, 1024, 2
_EXACT = 2.0**53


def usable(vector: str) -> Column:
    """A vector that is present and holds neither nulls nor non-finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & fine


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    flat = table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1)


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products; as doubles where every sum is exact in them."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    bound = float(np.abs(queries).max()) * float(np.abs(rows).max()) * queries.shape[1]
    if bound < _EXACT:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return queries @ rows.T


def _best_partial(k: int) -> Callable:
    """Phase one: the k best partial scores of each query in a block of a list."""

    def run(key: tuple, queries: pa.Table, rows: pa.Table) -> pa.Table:
        part = _products(_matrix(queries, "v"), _matrix(rows, "v")) if queries.num_rows and rows.num_rows else None
        q, x = queries.column("q").to_numpy(), rows.column("x").to_numpy()
        if part is None:
            return pa.table({"q": pa.array([], pa.int64()), "x": pa.array([], pa.int64()), "part": pa.array([], pa.int64())})
        n = min(k, part.shape[1])
        best = np.argpartition(-part, n - 1, axis=1)[:, :n]
        return pa.table({"q": np.repeat(q, n), "x": x[best].ravel(), "part": np.take_along_axis(part, best, axis=1).ravel()})

    return run


def _sufficient(lists: int) -> Callable:
    """Phase two: for each query of a block of a list the rows whose partial score reaches the threshold."""

    def run(key: tuple, queries: pa.Table, rows: pa.Table) -> pa.Table:
        _, qb, rb = (k.as_py() for k in key)
        kinds = pa.schema([("q", pa.int64()), ("xs", pa.list_(pa.int64())), ("qb", pa.int32()), ("rb", pa.int32())])
        if not queries.num_rows or not rows.num_rows:
            return kinds.empty_table()
        part = _products(_matrix(queries, "v"), _matrix(rows, "v"))
        cutoff = queries.column("cutoff").to_pandas().astype(float).fillna(-np.inf).to_numpy()
        # Beyond 2^53 doubles round: a slightly lower cutoff still sends all that is needed.
        safe = np.where(np.abs(cutoff) < _EXACT, cutoff, cutoff - np.abs(cutoff) * 1e-12)
        at_q, at_x = np.nonzero(part * float(lists) >= safe[:, None])
        own, first = np.unique(at_q, return_index=True)
        offsets = pa.array(np.append(first, len(at_q)).astype(np.int32))
        sent = pa.ListArray.from_arrays(offsets, pa.array(rows.column("x").to_numpy()[at_x]))
        block = [pa.array(np.full(len(own), b, np.int32)) for b in (qb, rb)]
        return pa.table([pa.array(queries.column("q").to_numpy()[own]), sent, *block], schema=kinds)

    return run


def _resolve(k: int) -> Callable:
    """Phase three: exact scores of the pairs sent, of which the k best of a query in the block stay."""

    def run(key: tuple, left: pa.Table, rows: pa.Table) -> pa.Table:
        is_pair = left.column("xs").is_valid()
        pairs, queries = left.filter(is_pair), left.filter(pc.invert(is_pair))
        empty = pa.table({c: pa.array([], pa.int64()) for c in ("q", "x", "score")})
        if not pairs.num_rows or not queries.num_rows or not rows.num_rows:
            return empty
        q, x = queries.column("q").to_numpy(), rows.column("x").to_numpy()
        order_q, order_x = np.argsort(q), np.argsort(x)
        vectors, table = _matrix(queries, "v"), _matrix(rows, "v")
        px = pairs.column("xs").combine_chunks().flatten().to_numpy()
        pq = np.repeat(pairs.column("q").to_numpy(), pc.list_value_length(pairs.column("xs")).to_numpy())
        # Several lists may have sent the same pair.
        order = np.lexsort((px, pq))
        pq, px = pq[order], px[order]
        fresh = np.concatenate(([True], (np.diff(pq) != 0) | (np.diff(px) != 0)))
        pq, px = pq[fresh], px[fresh]
        i = order_q[np.searchsorted(q, pq, sorter=order_q)]
        j = order_x[np.searchsorted(x, px, sorter=order_x)]
        score = np.concatenate([
            np.einsum("ij,ij->i", vectors[i[s : s + 65536]], table[j[s : s + 65536]]) for s in range(0, len(i), 65536)
        ])
        order = np.lexsort((px, -score, pq))
        pq, px, score = pq[order], px[order], score[order]
        first = np.searchsorted(pq, pq)
        near = np.arange(len(pq)) - first < k
        return pa.table({"q": pq[near], "x": px[near], "score": score[near]})

    return run


def top_k(rows: DataFrame, k: int, id_col: str, vector: str, is_query: Column) -> DataFrame:
    """The ``k`` best other rows of every query: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    ``vector`` holds whole numbers (long); the score is their inner product, which must fit a long;
    ties go to the smaller id. Rows with a null id or vector are left out, a shorter vector counts
    as padded with zeros. A row that repeats counts once, and of an id with several vectors the
    smallest counts. With fewer than ``k`` other rows all are returned; without a query, none.
    Rows with equal vectors are searched as one: their ``k + 1`` smallest ids are enough.
    """
    want = k + 1
    own = rows.select(F.col(id_col).alias("id"), F.col(vector).alias("v"), is_query.alias("ask"))
    own = own.where("id IS NOT NULL AND v IS NOT NULL").groupBy("id").agg(F.min("v").alias("v"), F.max("ask").alias("ask"))
    own = store(own)
    width = max(LISTS, own.agg(F.max(F.size("v"))).first()[0] or 0)
    width += -width % LISTS
    padded = F.concat("v", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("v")))
    own = own.withColumn("v", padded)
    classes = store(own.groupBy("v").agg(F.min("id").alias("x"), F.max("ask").alias("ask")))
    members = store(own.join(classes.select("v", "x"), "v").select("id", "ask", "x"))

    n, asked = classes.agg(F.count(F.lit(1)), F.count_if("ask")).first()
    blocks, ask_blocks = max(1, -(-n // BLOCK_ROWS)), max(1, -(-asked // BLOCK_QUERIES))
    in_rows = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    in_asks = lambda c: F.pmod(F.xxhash64(c, F.lit(1)), F.lit(ask_blocks)).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    asks = classes.where("ask").select(F.col("x").alias("q"), "v", in_asks("x").alias("qb")).withColumn("rb", each(blocks))
    table = classes.select("x", "v", in_rows("x").alias("rb")).withColumn("qb", each(ask_blocks))

    step = width // LISTS
    lists = F.explode(F.array(*[
        F.struct(F.lit(i).alias("list"), F.slice("v", i * step + 1, step).alias("v")) for i in range(LISTS)
    ])).alias("l")
    cut_table = table.select("x", "rb", "qb", lists).select("x", "rb", "qb", "l.list", "l.v")
    by = ["list", "qb", "rb"]

    def in_lists(left: DataFrame) -> DataFrame:
        return left.select(*[c for c in left.columns if c != "v"], lists).select(
            *[c for c in left.columns if c != "v"], "l.list", "l.v"
        )

    local = in_lists(asks).groupBy(*by).cogroup(cut_table.groupBy(*by)).applyInArrow(
        _best_partial(want), "q long, x long, part long"
    )
    best = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("part"), "x"))
    named = local.withColumn("r", best).where(F.col("r") <= want * LISTS).select("q", "x").distinct()
    exact = _scored(named, classes)
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "x"))
    cutoff = exact.withColumn("r", rank).where(F.col("r") == want).select("q", F.col("score").alias("cutoff"))
    bounded = store(classes.where("ask").select(F.col("x").alias("q"), "v").join(cutoff, "q", "left"))

    asks = bounded.withColumn("qb", in_asks("q")).withColumn("rb", each(blocks))
    sent = in_lists(asks).groupBy(*by).cogroup(cut_table.groupBy(*by)).applyInArrow(
        _sufficient(LISTS), "q long, xs array<bigint>, qb int, rb int"
    )
    nothing = F.lit(None).cast("array<bigint>")
    left = asks.select("q", nothing.alias("xs"), "v", "qb", "rb").unionByName(sent.withColumn("v", nothing))
    resolved = left.groupBy("qb", "rb").cogroup(table.groupBy("qb", "rb")).applyInArrow(
        _resolve(want), "q long, x long, score long"
    )
    winners = resolved.withColumn("r", rank).where(F.col("r") <= want).select("q", "x", "score")

    low = F.row_number().over(Window.partitionBy("x").orderBy("id"))
    few = members.select("x", "id").withColumn("r", low).where(F.col("r") <= want).drop("r")
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id")))
    lists_of = winners.join(few, "x").groupBy("q").agg(F.slice(ranked, 1, want).alias("best"))
    asking = members.where("ask").select(F.col("id").alias("query_id"), F.col("x").alias("q"))
    others = F.slice(F.filter("best", lambda b: b.id != F.col("query_id")), 1, k)
    return (
        asking.join(lists_of, "q")
        .select("query_id", F.posexplode(others).alias("at", "b"))
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("b.id").alias("vec_id"), (-F.col("b.minus")).alias("score"))
    )


def _scored(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Exact scores of a few pairs per query."""
    left = classes.select(F.col("x").alias("q"), F.col("v").alias("qv"))
    both = pairs.join(left, "q").join(classes.select("x", "v"), "x")
    products = F.zip_with("qv", "v", lambda a, b: a * b)
    return both.select("q", "x", F.aggregate(products, F.lit(0).cast("bigint"), lambda s, p: s + p).alias("score"))
