"""Byte-level BPE encoding and decoding.

Pre-tokens are looked up in two tiers. A minimal perfect hash over the vocabulary answers whole
pre-tokens at once; a miss is split into linked bytes, and a heap of adjacent pairs merges the
pair of the lowest rank, leftmost first, until none is in the vocabulary. Each distinct pre-token
is resolved once while it stays in a bounded cache.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable

import regex
import xxhash
from pyspark.sql import DataFrame

from courtside.llm.batches import per_text

#: Pre-tokens that a worker remembers before it starts anew, and the longest that it remembers.
CACHE_ENTRIES = 300_000
CACHE_CHARS = 64


def load_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks from a rank file (base64 and number on each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class PerfectHash:
    """Minimal perfect hash of byte strings to slots, by hash and displace.

    Keys go to buckets; the fullest bucket first, each gets the smallest seed that sends its keys
    to free slots. A bucket of one key is given a free slot outright. The slot's own key is
    compared on lookup, so an absent string is told apart.
    """

    BUCKET = 4

    def __init__(self, items: dict[bytes, int]):
        self.size = len(items)
        self.keys: list[bytes | None] = [None] * self.size
        self.values = [0] * self.size
        n_buckets = self.size // self.BUCKET + 1
        buckets: list[list[bytes]] = [[] for _ in range(n_buckets)]
        for key in items:
            buckets[xxhash.xxh3_64_intdigest(key) % n_buckets].append(key)
        self.seeds = [0] * n_buckets
        order = sorted(range(n_buckets), key=lambda b: -len(buckets[b]))
        for at, b in enumerate(order):
            if len(buckets[b]) < 2:
                break
            seed = 1
            while True:
                slots = [xxhash.xxh3_64_intdigest(k, seed) % self.size for k in buckets[b]]
                if len(set(slots)) == len(slots) and all(self.keys[s] is None for s in slots):
                    break
                seed += 1
            self.seeds[b] = seed
            for key, slot in zip(buckets[b], slots):
                self.keys[slot], self.values[slot] = key, items[key]
        else:
            at = len(order)
        free = (s for s in range(self.size) if self.keys[s] is None)
        for b in order[at:]:
            for key in buckets[b]:
                slot = next(free)
                self.seeds[b] = -slot - 1
                self.keys[slot], self.values[slot] = key, items[key]

    def get(self, key: bytes) -> int | None:
        if not self.size:
            return None
        seed = self.seeds[xxhash.xxh3_64_intdigest(key) % len(self.seeds)]
        slot = -seed - 1 if seed < 0 else xxhash.xxh3_64_intdigest(key, seed) % self.size
        return self.values[slot] if self.keys[slot] == key else None


class Codec:
    """Encoder and decoder over one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.ranks, self.words = ranks, PerfectHash(ranks)
        self.split = regex.compile(pattern).findall
        self.strings = {rank: token for token, rank in ranks.items()}
        self.cache: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of a pre-token that is not in the vocabulary."""
        ranks = self.ranks
        n = len(data)
        parts: list[bytes | None] = [data[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i, data[i : i + 2]) for i in range(n - 1) if (rank := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            left = parts[i]
            j = after[i]
            # The entry is stale if either side was merged since.
            if left is None or j >= n or len(left) + len(parts[j]) != len(pair) or left + parts[j] != pair:
                continue
            parts[i], parts[j] = pair, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                wider = pair + parts[k]
                if (rank := ranks.get(wider)) is not None:
                    heapq.heappush(heap, (rank, i, wider))
            h = before[i]
            if h >= 0:
                wider = parts[h] + pair
                if (rank := ranks.get(wider)) is not None:
                    heapq.heappush(heap, (rank, h, wider))
        return [ranks[p] for p in parts if p is not None]

    def resolve(self, token: str) -> bytes:
        """Ids of a pre-token as little-endian unsigned 32-bit integers."""
        data = token.encode("utf-8", "replace")
        whole = self.words.get(data)
        ids = self.merge(data) if whole is None else [whole]
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def encode(self, text: str) -> bytes:
        cache = self.cache
        out = []
        for token in self.split(text):
            ids = cache.get(token)
            if ids is None:
                ids = self.resolve(token)
                if len(token) <= CACHE_CHARS:
                    if len(cache) >= CACHE_ENTRIES:
                        cache.clear()
                    cache[token] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.strings.__getitem__, memoryview(ids).cast("I"))) if ids else b""


#: One codec per Python worker and vocabulary file, as the cache serves all of its tasks.
_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS.clear()
        _CODECS[path, pattern] = Codec(load_ranks(path), pattern)
    return _CODECS[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, columns: list[str], text: str = "text") -> DataFrame:
    """Add ``ids``, the token ids of each whole text as little-endian unsigned 32-bit integers.

    One row per input row. A null or empty text has no ids. The vocabulary file is read
    on each executor from ``path``, a place that exists on every machine.
    """

    def make() -> Callable[[list[str]], tuple]:
        encoder = codec(path, pattern).encode
        return lambda batch: ([encoder(t) for t in batch],)

    return per_text(docs, [*columns, text], make, "ids binary")


def round_trip(docs: DataFrame, path: str, pattern: str, columns: list[str], text: str = "text") -> DataFrame:
    """Number and digest of the ids of each whole text, and the digest of what they decode to.

    ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``; a null text counts as empty, and
    what it decodes to is the empty string.
    """

    def make() -> Callable[[list[str]], tuple]:
        both = codec(path, pattern)

        def one(text: str) -> tuple[int, str, str]:
            ids = both.encode(text)
            decoded = both.decode(ids)
            return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

        return lambda batch: tuple(zip(*map(one, batch)))

    return per_text(docs, [*columns, text], make, "n_tokens long, ids_sha256 string, decoded_sha256 string")
