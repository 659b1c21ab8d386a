"""Token counts of whole texts without their token ids.

A tokenizer that drops white space splits a text into pre-tokens and never joins over their borders, so
the count of a text is the sum over its pre-tokens. The pieces of each distinct pre-token are counted
once, in one table. That table is then joined to the frequencies of the pre-tokens in each document:
the most frequent pre-tokens, of which there are at most ``FREQUENT`` by their share of all
occurrences, are looked up in a broadcast of bounded size; all others by a shuffle join, in which no
key can be hot, since the frequent ones are out.
"""

from __future__ import annotations

import hashlib
import json
import operator
import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from courtside.llm.batches import slices
from courtside.session import store

#: A pre-token is frequent if it makes up this fraction of all occurrences or more: no more than
#: ``FREQUENT`` can, and each takes at most 16 bytes and a count in the broadcast.
FREQUENT = 1_000_000
#: Longest pre-token that is its own key; of a longer one the digest of 16 bytes is.
KEY_BYTES = 15
#: Distinct pre-tokens a task gathers before it sends their counts, and chunks that it remembers.
GATHERED, REMEMBERED = 200_000, 300_000
#: A chunk between white space that is longer is cut by the tokenizer's own rules, a shorter one at its last marks.
LONG = 64
MARKS = b".,!?;:*$%&#"


class PreTokens:
    """Cuts texts where the tokenizer is sure to cut, and counts pieces of what lies between."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            added = json.load(file).get("added_tokens", [])
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError("added tokens that depend on what is around them are not supported")
        self.tokenizer = Tokenizer.from_file(path)
        # Texts are cut at added tokens first; what is left holds none, also after lower-casing.
        self.tokenizer.encode_special_tokens = True
        ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        if ids("ab, \n\tcd") != ids("ab") + ids(",") + ids("cd") or ids("AB") != ids("ab"):
            raise ValueError("only tokenizers that drop white space and lower-case are supported")
        names = sorted((t["content"].encode() for t in added), key=len, reverse=True)
        self.added = regex.compile(b"|".join(map(regex.escape, names))) if names else None
        self.names = names

    def chunks(self, text: bytes) -> tuple[list[bytes], int]:
        """What lies between white space, A-Z lower-cased, and the number of added tokens."""
        if any(name in text for name in self.names):
            between = self.added.split(text)
            return b" ".join(between).lower().split(), len(between) - 1
        return text.lower().split(), 0

    def parts(self, chunk: bytes) -> list[bytes]:
        """Pre-tokens of a chunk. Letters and digits never join with the marks after them."""
        if len(chunk) > LONG:
            normal = self.tokenizer.normalizer.normalize_str(chunk.decode("utf-8", "replace"))
            return [normal[a:b].encode() for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        stem = chunk.rstrip(MARKS)
        return [stem, chunk[len(stem) :]] if len(stem) < len(chunk) and stem[-1:].isalnum() else [chunk]

    def counts(self, pretokens: list[bytes]) -> list[int]:
        """Number of pieces of each pre-token."""
        texts = [p.decode("utf-8", "replace") for p in pretokens]
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


_TOKENIZERS: dict[str, PreTokens] = {}


def _tokenizer(path: str) -> PreTokens:
    """One per Python worker, as the files take a while to load."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = PreTokens(path)
    return _TOKENIZERS[path]


def _key(pretoken: bytes) -> bytes:
    return pretoken if len(pretoken) <= KEY_BYTES else hashlib.blake2b(pretoken, digest_size=16).digest()


def _distinct(path: str):
    """Pre-tokens of a task with their occurrences; what one task sends more than once is summed later."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, seen = _tokenizer(path), Counter()
        for batch in slices(batches):
            chunks: Counter = Counter()
            for text in batch.column(0).to_pylist():
                chunks.update(cut.chunks(text or b"")[0])
            for chunk, n in chunks.items():
                for part in cut.parts(chunk):
                    seen[part] += n
            if len(seen) >= GATHERED:
                yield from _sent(seen)
                seen = Counter()
        yield from _sent(seen)

    return run


def _sent(seen: Counter) -> Iterator[pa.RecordBatch]:
    words = list(seen)
    for at in range(0, len(words), 10_000):
        some = words[at : at + 10_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(map(_key, some), pa.binary()), pa.array(some, pa.binary()), pa.array([seen[w] for w in some], pa.int64())],
            names=["key", "pretoken", "n"],
        )


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 5000):
            pieces = _tokenizer(path).counts(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(pieces, pa.int64())], names=["key", "n", "pieces"]
            )

    return run


def piece_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Every distinct pre-token once: ``key``, ``n`` (its occurrences in all texts) and ``pieces``.

    ``key`` is the pre-token, or its digest if it is longer than 15 bytes.
    """
    data = docs.select(F.col(text).cast("string").cast("binary").alias("text"))
    found = data.mapInArrow(_distinct(path), "key binary, pretoken binary, n long")
    once = found.groupBy("key").agg(F.any_value("pretoken").alias("pretoken"), F.sum("n").alias("n"))
    return once.mapInArrow(_counted(path), "key binary, n long, pieces long")


def _per_document(path: str, frequent, keep: int):
    """Frequencies of the pre-tokens of each text, those of frequent ones summed up at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, pieces, known = _tokenizer(path), frequent.value, {}
        words = pa.list_(pa.struct([("key", pa.binary()), ("times", pa.int64())]))
        for batch in slices(batches):
            sizes, sums, rest = [], [], []
            for text in batch.column(keep).to_pylist():
                text = text or b""
                chunks, total = cut.chunks(text)
                times = Counter(chunks)
                found = list(map(known.get, times))
                rare: Counter = Counter()
                if None in found:
                    for at, (chunk, n) in enumerate(times.items()):
                        if found[at] is None:
                            known_parts, found[at] = 0, 0
                            keys = list(map(_key, cut.parts(chunk)))
                            for key in keys:
                                if (count := pieces.get(key)) is None:
                                    rare[key] += n
                                else:
                                    known_parts += count
                            found[at] = known_parts
                            if len(chunk) <= LONG and not any(key in rare for key in keys):
                                known[chunk] = known_parts
                    if len(known) > REMEMBERED:
                        known.clear()
                sizes.append(len(text))
                sums.append(total + sum(map(operator.mul, found, times.values())))
                rest.append([{"key": k, "times": n} for k, n in sorted(rare.items())])
            made = [pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(rest, words)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:keep], *made], names=[*[f"c{i}" for i in range(keep)], "n_bytes", "counted", "rare"]
            )

    return run


def count_tokens(docs: DataFrame, path: str, columns: list[str], text: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """The given columns with ``n_bytes`` (of UTF-8) and ``n_tokens`` of each whole text.

    ``path`` is a tokenizer file that every machine has, of a kind that drops white space and lower-cases;
    begin, end and other special tokens are not added, the strings of added tokens in a text count as
    one token each. One row per input row, repeated rows included; a null or empty text has no
    tokens. ``frequent`` bounds the broadcast.
    """
    spark = docs.sparkSession
    counted = store(piece_counts(docs, path, text))
    total = counted.agg(F.sum("n")).first()[0] or 0
    often = counted.where(F.col("n") * frequent >= total).select("key", "pieces")
    table = spark.sparkContext.broadcast({bytes(k): n for k, n in often.toLocalIterator()})

    keep = [f"c{i}" for i in range(len(columns))]
    data = docs.select(
        *[F.col(c).alias(k) for c, k in zip(columns, keep)], F.col(text).cast("string").cast("binary").alias("text")
    )
    head = "".join(f"{k} {data.schema[k].dataType.simpleString()}, " for k in keep)
    known = data.mapInArrow(
        _per_document(path, table, len(keep)),
        f"{head}n_bytes long, counted long, rare array<struct<key: binary, times: bigint>>",
    )
    # Written with their numbers, so that a task that runs again cannot number the rows anew.
    known = store(known.withColumn("row", F.monotonically_increasing_id()))
    whole = known.where(F.size("rare") == 0).select(*keep, "n_bytes", F.col("counted").alias("n_tokens"))
    words = known.where(F.size("rare") > 0).select("row", F.explode("rare").alias("w")).select("row", "w.key", "w.times")
    others = counted.where(F.col("n") * frequent < total).select("key", "pieces")
    more = words.join(others, "key").groupBy("row").agg(F.sum(F.col("times") * F.col("pieces")).alias("more"))
    rest = known.where(F.size("rare") > 0).drop("rare").join(more, "row")
    rest = rest.select(*keep, "n_bytes", (F.col("counted") + F.col("more")).alias("n_tokens"))
    return whole.unionByName(rest).withColumnsRenamed(dict(zip(keep, columns)))
