"""Byte-level BPE against a reference library, packing against its definition."""

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from courtside.llm import bpe, packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.load_ranks(RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def words():
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    return tokenizer


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=200), st.text("abc '\n<|>0é漢", max_size=300)))
def test_codec_equals_the_library(codec, reference, text):
    ids = reference.encode_ordinary(text)
    got = codec.encode(text)
    assert np.frombuffer(got, "<u4").tolist() == ids
    assert codec.decode(got) == text.encode()


def test_perfect_hash_is_minimal_and_knows_what_is_absent():
    for n in (0, 1, 2, 1000):
        items = {f"key{i}".encode(): i for i in range(n)}
        made = bpe.PerfectHash(items)
        assert len(made.keys) == n and None not in made.keys
        assert all(made.get(k) == v for k, v in items.items())
        assert made.get(b"absent") is None


def test_cache_starts_anew_when_full(codec, reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    text = " ".join(f"word{i}x" for i in range(50))
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError):
        bpe.Codec({b"a": 0}, public_tokenizers.PATTERN)


def test_round_trip_of_awkward_rows(odd_docs, odd_rows, reference):
    got = bpe.round_trip(odd_docs, RANKS, public_tokenizers.PATTERN, ["doc_id", "row"]).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        doc_id, text = odd_rows[r.row]
        ids = reference.encode_ordinary(text or "")
        assert (r.doc_id, r.n_tokens) == (doc_id, len(ids))
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.encode(odd_docs.limit(0), RANKS, public_tokenizers.PATTERN, ["doc_id"]).collect() == []


@settings(max_examples=200, deadline=None)
@given(text=st.one_of(st.text(max_size=100), st.text("ab'sS \n\t\x0b\x1c\x85\xa0\u3000é1.§,!*%A", max_size=100)))
def test_words_equal_whole_texts(words, text):
    ids = words.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing._words(WORDS).encode([text.encode()])[0], "<u4").tolist() == ids


def check_packing(rows, pieces, words, capacity):
    """Pieces of the right tokens, each sequence gapless and not too long."""
    want = Counter()
    for doc_id, text in rows:
        ids = [*words.encode(text or "", add_special_tokens=False).ids, 1]
        for n, i in enumerate(range(0, len(ids), capacity)):
            part = ids[i : i + capacity]
            want[doc_id, n, i, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in pieces) == want
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [16, 4096])
def test_packing_of_awkward_rows(odd_docs, odd_rows, words, capacity):
    pieces = packing.pack(odd_docs, WORDS, capacity).collect()
    n = check_packing(odd_rows, pieces, words, capacity)
    assert n >= -(-sum(p.length for p in pieces) // capacity)
    assert packing.pack(odd_docs.limit(0), WORDS, capacity).collect() == []


def test_packing_of_a_table(spark, sf_dir, words):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = packing.pack(docs, WORDS).collect()
    n = check_packing([(r.doc_id, r.text) for r in docs.collect()], pieces, words, 4096)
    assert n <= 1.02 * -(-sum(p.length for p in pieces) // 4096) + 1


def test_price_is_the_best_configuration():
    lengths, most, values = np.array([3, 5, 7]), np.array([2, 3, 1]), np.array([3.0, 5.5, 7.2])
    best = 0.0
    for a in range(3):
        for b in range(4):
            for c in range(2):
                if 3 * a + 5 * b + 7 * c <= 20:
                    best = max(best, 3.0 * a + 5.5 * b + 7.2 * c)
    found = packing.price(lengths, most, values, 20)
    assert sum(values[list(lengths).index(n)] * c for n, c in found.items()) == pytest.approx(best)


@settings(max_examples=60, deadline=None)
@given(histogram=st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=40))
def test_configurations_hold_every_piece(histogram):
    groups = packing.configurations(histogram, 64)
    held = Counter()
    for g in groups:
        assert sum(n * c for n, c in g.lengths) <= 64
        for n, c in g.lengths:
            held[n] += c * g.count
    assert held == histogram
    greedy = sum(g.count for g in packing.best_fit(histogram, 64))
    assert sum(g.count for g in groups) <= 1.1 * greedy + 2


MARKED = [
    "a <|endoftext|> b", "<|startoftext|>A b<|endoftext|>", "<|ENDOFTEXT|> <|EndOfText|>", "x<|endoftext|>Y <|endoftext|", "<| endoftext |>",
    "É§ <|endoftext|>\u3000\n" * 3000, "<|endoftext|>",
]


@pytest.fixture(scope="module")
def untouched():
    return Tokenizer.from_file(WORDS)


@settings(max_examples=100, deadline=None)
@given(parts=st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", " ", "Word's", "é§", "\n", "1."]), max_size=12))
def test_added_tokens_are_one_id_as_the_library_has_it(untouched, parts):
    text = "".join(parts)
    ids = untouched.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing._words(WORDS).encode([text.encode()])[0], "<u4").tolist() == ids


def test_packing_of_texts_with_added_tokens(spark, untouched):
    rows = list(enumerate(MARKED))
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), WORDS, 4096).collect()
    check_packing(rows, pieces, untouched, 4096)
