"""Periodic runs against their definition, token counts against the tokenizer library."""

import hashlib
import random
import zlib

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from courtside.llm import catalog, periodic, tokencounts

WORDS = public_tokenizers.path("word_bpe_49k.json")


def runs_by_definition(words):
    """Every maximal stretch with a period, of its smallest period, twelve words and two periods long."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end > at and end + q - at >= max(12, 2 * q):
                stretch = words[at : end + q]
                if not any(stretch[r:] == stretch[:-r] for r in range(1, q)):
                    found.append((at, len(stretch), q))
            at = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    """The words that the query looks at."""
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def row_by_definition(doc_id, words):
    found = runs_by_definition(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found)]
    sha = lambda data: hashlib.sha256(data).hexdigest()
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found).encode()
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    exponent = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, exponent, sha(lines), sha(b" ".join(kept)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_groups_hold_the_longest_lyndon_words(signs):
    lengths, groups = periodic.lyndon_groups(signs)
    for i in range(len(signs)):
        smaller = (j for j in range(i + 1, len(signs)) if signs[j:] < signs[i:])
        assert lengths[i] == next(smaller, len(signs)) - i
    words = [tuple(signs[i : i + n]) for i, n in enumerate(lengths)]
    assert all((groups[i] == groups[j]) == (words[i] == words[j]) for i in range(len(signs)) for j in range(i))


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 5), st.integers(1, 90))
def test_runs_equal_the_definition(seed, kinds, n):
    pick = random.Random(seed)
    words = [b"w%d" % pick.randrange(kinds) for _ in range(n)]
    start = pick.randrange(n)
    period = 1 + pick.randrange(n - start)
    words = [w if i < start else words[start + (i - start) % period] for i, w in enumerate(words)]
    assert [tuple(r) for r in periodic.runs(words).tolist()] == runs_by_definition(words)


def test_runs_of_strings_full_of_repeats():
    a, b = ["a"], ["a", "b"]
    while len(b) < 250:
        a, b = b, b + a
    parity = [str(i.bit_count() % 2) for i in range(256)]
    for words in (b, parity, ["x"] * 200, list("ab" * 90), list("aab" * 5 + "aabb" * 9)):
        coded = [w.encode() for w in words]
        assert [tuple(r) for r in periodic.runs(coded).tolist()] == runs_by_definition(coded)


def test_long_matches_beyond_the_common_steps():
    pick = random.Random(3)
    block = [b"%d" % pick.randrange(900) for _ in range(700)]
    words = [b"start", *block, *block, *block[:333], b"end"]
    assert [tuple(r) for r in periodic.runs(words).tolist()] == [(1, 1733, 700)]


@pytest.mark.parametrize("source", ["odd", "table"])
def test_query_equals_brute_force(spark, sf_dir, odd_docs, tmp_path, source):
    folder = sf_dir
    if source == "odd":
        folder = str(tmp_path)
        more = spark.createDataFrame([(i, "la " * 30 + "x") for i in range(20, 60)], "doc_id long, text string")
        odd_docs.unionByName(more, allowMissingColumns=True).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    if source == "table":
        docs = docs.where("length(text) < 2500 or text is null")
        docs.write.parquet(f"{tmp_path}/documents.parquet")
        folder = str(tmp_path)
    got = catalog.QUERIES["op12_periodic_runs"](spark, folder)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    # The very long text has no short periods by construction and is left to the other tests.
    wanted = [row_by_definition(i, planted(i, t)) for i, t in rows if len(t or "") < 20_000]
    plain = lambda found: sorted(map(repr, map(tuple, found)))
    long = [i for i, t in rows if len(t or "") >= 20_000]
    assert plain(r for r in got.collect() if r.doc_id not in long) == plain(wanted)
    assert got.count() == len(rows)


def test_operator_passes_columns_on_and_takes_an_empty_table(spark, odd_docs):
    found = periodic.find_runs(odd_docs, ["doc_id", "score", "kept", "c0", "row", "block"])
    assert found.columns == ["doc_id", "score", "kept", "c0", "row", "block", "runs", "collapsed"]
    assert found.count() == odd_docs.count()
    assert periodic.find_runs(odd_docs.where("1 = 0"), ["doc_id"]).count() == 0


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


TEXTS = [
    None, "", " \n", "a <|endoftext|> b", "A<|startoftext|>B<|endoftext|><|endoftext|>", "<|ENDOFTEXT|> x<|endoftext|", "don't DON'T he'll!!'s",
    "étude ́a", "word, word. word?! (word) 12,500.50", "漢字かな交じり文、" * 30, "x" * 300, "é" * 70 + "!" * 80, "a b c\x1cd\x85e",
    "İstanbul ΣΣ ẞ K ſ", "🙂🙂 ok🙂", "a" * 15 + " " + "a" * 16, "----" * 40,
]


@pytest.mark.parametrize("frequent", [1, 10, 1_000_000])
def test_counts_equal_the_library(spark, library, frequent):
    rows = [(i, t, i) for i, t in enumerate(TEXTS * 2)] + [(3, TEXTS[3], 3)] * 3 + [(None, None, None), (None, "a b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_bytes int").repartition(3)
    got = tokencounts.count_tokens(docs, WORDS, ["doc_id"], frequent=frequent)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
    wanted = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, wanted))


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=120), st.text("ab'st.,!?<|endoftx>é ́漢\n1", max_size=200)))
def test_parts_never_change_a_count(library, text):
    cut = tokencounts._tokenizer(WORDS)
    chunks, added = cut.chunks(text.encode("utf-8", "replace"))
    parts = [p for c in chunks for p in cut.parts(c)]
    assert added + sum(cut.counts(parts) if parts else []) == len(library.encode(text.encode("utf-8", "replace").decode(), add_special_tokens=False).ids)


def test_distinct_pretokens_are_counted_once_and_sent_in_parts(spark, odd_docs, monkeypatch):
    counted = tokencounts.piece_counts(odd_docs, WORDS)
    assert counted.count() == counted.select("key").distinct().count()
    words = sum(len((r.text or "").split()) for r in odd_docs.select("text").collect())
    assert counted.agg({"n": "sum"}).first()[0] >= words


def test_token_query_and_empty_table(spark, sf_dir, library, odd_docs):
    got = {r.doc_id: r for r in catalog.QUERIES["op11_token_counts"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    for doc_id, text in docs:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        row = got[doc_id]
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len((text or "").encode()), n, n > 2048)
    assert len(got) == len(docs)
    assert tokencounts.count_tokens(odd_docs.where("1 = 0"), WORDS, ["doc_id", "row"]).count() == 0


def test_only_tokenizers_that_drop_white_space():
    with pytest.raises(ValueError):
        tokencounts.PreTokens(public_tokenizers.path("byte_bpe_50k.json"))
