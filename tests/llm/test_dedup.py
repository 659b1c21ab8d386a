"""Suffix, MinHash and cover-tree deduplication against brute force."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from courtside.llm import covertree, minhash, suffixes
from courtside.llm.components import components
from courtside.llm.shingles import shingle_sets

from .conftest import prose


def reachable(nodes, links):
    """Smallest node reachable from each."""
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


@pytest.mark.parametrize("shape", ["empty", "path", "star", "random", "odd"])
def test_components(spark, shape):
    pick = random.Random(5)
    edges = {
        "empty": [],
        "path": [(i, i + 1) for i in range(40)],
        "star": [(99, i) for i in range(50)],
        "random": [(pick.randrange(80), pick.randrange(80)) for _ in range(60)],
        "odd": [(1, 1), (None, 2), (3, None), (4, 5), (5, 4), (4, 5)],
    }[shape]
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    want = reachable({n for e in real for n in e}, real)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


# --- suffixes ---------------------------------------------------------------------------------


def cut_by_force(texts, span):
    seen = {}
    for t in texts:
        for i in range(len(t) - span + 1):
            seen[t[i : i + span]] = seen.get(t[i : i + span], 0) + 1
    spans = []
    for t in texts:
        gone = [False] * (len(t) + 1)
        for i in range(len(t) - span + 1):
            if seen[t[i : i + span]] > 1:
                gone[i : i + span] = [True] * span
        edges = [i for i in range(len(t) + 1) if gone[i] != (i > 0 and gone[i - 1])]
        spans.append(edges)
    return spans


def check_cut(got, texts, span):
    want = cut_by_force(texts, span)
    assert len(got) == len(texts)
    for r in got:
        text = texts[r.n]
        assert (r.n_bytes, list(r.spans)) == (len(text), want[r.n])
        gone = np.zeros(len(text), bool)
        for a, b in zip(r.spans[::2], r.spans[1::2]):
            gone[a:b] = True
        assert bytes(r.kept) == bytes(np.frombuffer(text, np.uint8)[~gone])


@pytest.mark.parametrize("hot", [10_000, 2])
@pytest.mark.parametrize("signs", ["ab", "abcdefgh ", "aé"])
def test_repeats_equal_brute_force(spark, monkeypatch, signs, hot):
    pick = random.Random(len(signs) + hot)
    parts = ["".join(pick.choices(signs, k=pick.randrange(5, 60))) for _ in range(25)]
    texts = ["".join(pick.choices(parts, k=pick.randrange(0, 6))) for _ in range(60)] + ["", "a" * 200, "ab" * 150]
    docs = spark.createDataFrame(list(enumerate(texts)), "n long, text string").repartition(4)
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 700)
    got = suffixes.remove_repeats(docs, ["n"], span=24, gram=8, hot=hot).collect()
    check_cut(got, [t.encode() for t in texts], 24)


@pytest.mark.parametrize("hot", [10_000, 1])
def test_repeats_of_awkward_rows(odd_docs, odd_rows, hot):
    got = suffixes.remove_repeats(odd_docs.withColumnRenamed("row", "n"), ["n", "doc_id", "score", "block"], hot=hot).collect()
    check_cut(got, [(t or "").encode() for _, t in odd_rows], 200)
    assert all(odd_rows[r.n][0] == r.doc_id and r.block == "b" and r.score is None for r in got)


def test_repeats_of_no_rows(odd_docs):
    assert suffixes.remove_repeats(odd_docs.limit(0), ["doc_id"]).collect() == []


def test_repeats_leave_whole_characters(spark):
    shared = "é漢" * 60
    docs = spark.createDataFrame([(0, "zé" + shared + "ñ"), (1, "yè" + shared + "ô")], "n long, text string")
    got = suffixes.remove_repeats(docs, ["n"], characters=True).collect()
    assert {r.n: bytes(r.kept).decode() for r in got} == {0: "zéñ", 1: "yèô"}


@settings(max_examples=100, deadline=None)
@given(runs=st.lists(st.lists(st.binary(max_size=6), max_size=12), min_size=1, max_size=6))
def test_merge_yields_order_and_shared_lengths(runs):
    runs = [sorted(r) for r in runs]
    shared = [[suffixes.common(a, b) for a, b in zip([b"", *r], r)] for r in runs]
    of_run, of_place, lengths = suffixes.merge(list(zip(runs, shared)))
    merged = [runs[r][i] for r, i in zip(of_run, of_place)]
    assert merged == sorted(s for r in runs for s in r)
    assert lengths == [suffixes.common(a, b) for a, b in zip([b"", *merged], merged)]


# --- MinHash ----------------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def check_groups(got, rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    full = [(i, s) for (i, _), s in zip(rows, sets) if s and i is not None]
    links = [
        (i, j)
        for k, (i, s) in enumerate(full)
        for j, o in full[:k]
        if 100 * len(s & o) >= percent * len(s | o)
    ]
    want = reachable({i for i, _ in rows if i is not None}, links)
    sizes = {(i, len(s)) for (i, _), s in zip(rows, sets)}
    assert len(got) == len(rows)
    for r in got:
        assert (r.doc_id, r.n_shingles) in sizes
        assert r.component_id == want.get(r.doc_id)
        assert r.kept == (r.doc_id is None or r.component_id == r.doc_id)


@given(texts=st.lists(st.text("aAbB \t\n\x0b\xa0é", max_size=40), max_size=6))
@settings(max_examples=100, deadline=None)
def test_shingle_sets_have_the_right_sizes(texts):
    for width in (1, 3, 5):
        sets = shingle_sets([t.encode() for t in texts], width)
        wanted = [shingles(t, width) for t in texts]
        assert [len(s) for s in sets] == [len(w) for w in wanted]
        for a, x in zip(sets, wanted):
            for b, y in zip(sets, wanted):
                assert len(np.intersect1d(a, b)) == len(x & y)


def test_signature_agreement_estimates_similarity():
    words = [f"w{i}" for i in range(3000)]
    a, b = shingle_sets([" ".join(words[:2000]).encode(), " ".join(words[400:2400]).encode()], 3)
    similarity = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    places = (np.concatenate([a, b]) >> np.uint64(32)).astype(np.uint32)
    signature = minhash._shifted_minima(places, np.array([0, len(a)]))
    assert abs((signature[0] == signature[1]).mean() - similarity) < 0.12


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_near_copies_equal_brute_force(spark, width, percent):
    pick, rows = random.Random(width), []
    for family in range(12):
        words = prose(family, pick.choice([2, 30, 120])).split()
        for _ in range(pick.randrange(1, 14)):
            own = list(words)
            for _ in range(pick.randrange(0, 6)):
                own[pick.randrange(len(own))] = f"new{pick.randrange(50)}"
            rows.append((len(rows) * 7 % 1000, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check_groups(minhash.near_duplicates(docs, width, percent).collect(), rows, width, percent)


def test_near_copies_whose_leader_does_not_reach_all(spark):
    """A chain of small changes: the ends share buckets with the middle only."""
    words = prose(77, 120).split()
    rows = []
    for i in range(40):
        words = list(words)
        words[(i * 3) % 120] = f"step{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check_groups(minhash.near_duplicates(docs, 3, 85).collect(), rows, 3, 85)


def test_near_copies_of_awkward_rows(odd_docs, odd_rows):
    check_groups(minhash.near_duplicates(odd_docs, 3, 85).collect(), odd_rows, 3, 85)
    assert minhash.near_duplicates(odd_docs.limit(0)).collect() == []


# --- vectors ----------------------------------------------------------------------------------


def check_vectors(got, rows, cosine):
    good = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good[i] = min(good[i], v) if i in good else v
    width = max((len(v) for v in good.values()), default=1)
    ids = sorted(good)
    points = np.array([list(good[i]) + [0.0] * (width - len(good[i])) for i in ids], float).reshape(len(ids), width)
    dots = covertree.unit(points) @ covertree.unit(points).T if ids else np.zeros((0, 0))
    linked = dots >= cosine
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(linked)) if a != b]
    want = reachable({i for i, _ in rows if i is not None}, links)
    counts = {i: int(linked[k].sum()) - 1 for k, i in enumerate(ids)}
    assert len(got) == len(rows)
    for r in got:
        assert r.n_links == counts.get(r.vec_id, 0)
        assert r.component_id == want.get(r.vec_id)
        assert r.kept == (r.vec_id is None or r.vec_id == r.component_id)


@pytest.mark.parametrize("cosine", [0.95, 0.6])
def test_vectors_equal_brute_force(spark, monkeypatch, cosine):
    monkeypatch.setattr(covertree, "NODE_ROWS", 40)
    pick = np.random.default_rng(3)
    centres = pick.normal(size=(6, 8))
    near = [centres[pick.integers(6)] * pick.uniform(0.1, 9) + pick.normal(size=8) * pick.choice([0.01, 0.2, 0.6]) for _ in range(200)]
    rows = [(i * 3, v.tolist()) for i, v in enumerate([*near, *pick.normal(size=(60, 8)), *[near[0]] * 50])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    check_vectors(covertree.near_vectors(docs, cosine).collect(), rows, cosine)


def test_nodes_meet_without_being_shuffled_to_their_pairs(spark, monkeypatch):
    """Single precision, ids and vectors that come twice; a node is sent nowhere, its part is read (F1)."""
    monkeypatch.setattr(covertree, "NODE_ROWS", 20)
    met, node_pairs = [], covertree.node_pairs

    def seen(nodes, reach):
        met.append((nodes.count(), node_pairs(nodes, reach)))
        return met[-1][1]

    monkeypatch.setattr(covertree, "node_pairs", seen)
    pick = np.random.default_rng(5)
    single = pick.normal(size=(150, 6)).astype(np.float32)
    near = (single[:40] + pick.normal(size=(40, 6)) * 0.1).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate([*single, *near, *[single[3]] * 30])]
    rows += [(5, near[2].tolist()), (7, near[2].tolist()), (7, near[2].tolist()), (8, None), (500, [1.0, 0.0]), (501, [1.0, -0.0]), (502, [2.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    check_vectors(covertree.near_vectors(docs).collect(), rows, 0.95)
    (count, pairs), plan = met[0], met[0][1]._jdf.queryExecution().executedPlan().toString()
    assert count > 5 and "CartesianProduct" in plan and "Exchange" not in plan
    # Every pair that holds a link is there once, a node with itself included.
    found = [(r.node_a, r.node_b) for r in pairs.select("node_a", "node_b").collect()]
    assert len(found) == len(set(found)) <= count * (count + 1) // 2 and sum(a == b for a, b in found) == count


def test_bounds_in_single_precision_drop_no_link():
    """Pairs at the very threshold pass the first look."""
    pick = np.random.default_rng(2)
    points = covertree.unit(pick.normal(size=(300, 32)))
    side = covertree.unit(pick.normal(size=(300, 32)))
    side = covertree.unit(side - points * (side * points).sum(axis=1, keepdims=True))
    others = 0.95 * points + np.sqrt(1 - 0.95**2) * side
    cosine = float((points * others).sum(axis=1).min())
    levels = []
    for these in (points, others):
        order, depth = covertree.nested(these)
        levels.append((order, covertree.Levels.of(these[order], depth[order])))
    (order_a, a), (order_b, b) = levels
    got = {(order_a[i], order_b[j]) for kind, *ends in covertree.dual(a, b, cosine) if kind == "pairs" for i, j in zip(*ends)}
    dots = np.einsum("ij,ij->i", points, others)
    assert {(k, k) for k in np.flatnonzero(dots >= cosine)} <= got


def test_awkward_vectors(spark):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 0.0]),
        (8, [2.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0]), (10, [1e300, 1e299]), (11, [-1.0, 0.0]), (None, [1.0, 0.0]), (None, None), (12, [1e-300, 0.0]),
    ]
    docs = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "vec_id long, embedding array<double>, v double, node int")
    check_vectors(covertree.near_vectors(docs).collect(), rows, 0.95)
    assert covertree.near_vectors(docs.limit(0)).collect() == []
    assert covertree.near_vectors(docs.where("vec_id = 3")).collect()[0].kept
