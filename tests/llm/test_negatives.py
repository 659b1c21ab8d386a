"""Hard negatives against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtside.llm import negatives


def brute(rows, is_anchor, k=5, low=80, high=100):
    """(anchor, positive, rank, negative, positive score, negative score) by comparing all with all."""
    usable = {}
    for i, label, v in sorted((r for r in rows if None not in r), key=lambda r: (r[2], r[1])):
        usable.setdefault(i, (label, v))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (label, v) in usable.items():
        if not is_anchor(a):
            continue
        ranked = sorted((-dot(v, w), x, other == label) for x, (other, w) in usable.items() if x != a)
        for minus, p, _ in [r for r in ranked if r[2]][:k]:
            fits = [(-m, x) for m, x, same in ranked if not same and low * -minus <= 100 * -m <= high * -minus][:k]
            out += [(a, p, n + 1, x, -minus, s) for n, (s, x) in enumerate(fits)]
    return sorted(out)


def vectors(seed, count, width, spread=40):
    """Clusters of vectors with equal ones, zeros and opposite ones among them."""
    pick = random.Random(seed)
    centres = [[pick.randint(-100, 100) for _ in range(width)] for _ in range(5)]
    made = []
    for i in range(count):
        centre = pick.choice(centres)
        v = [c + pick.randint(-spread, spread) for c in centre]
        made.append((i, pick.randrange(3), pick.choice([v, v, v, centre, [0] * width, [-x for x in v]])))
    return made


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "b") for r in rows], "vec_id long, label int, v array<bigint>, block int, a string").repartition(3)


@pytest.mark.parametrize("block_rows", [7, 64, 10_000])
def test_equals_brute_force(spark, block_rows):
    rows = vectors(block_rows, 300, 6)
    got = negatives.hard_negatives(table(spark, rows), F.col("vec_id") % 9 == 0, block_rows=block_rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    wanted = brute(rows, lambda i: i % 9 == 0)
    assert len(wanted) > 100 and sorted(map(tuple, got.collect())) == wanted


def test_awkward_rows(spark):
    rows = vectors(1, 40, 4) + [
        (100, None, [1, 2, 3, 4]), (101, 1, None), (None, 1, [1, 1, 1, 1]), (9, 2, [5, 5]), (9, 2, [5, 5]), (102, 1, []),
        (103, 0, [10**7, -(10**7), 10**7, 3]), (108, 1, [10**7 - 5, -(10**7), 10**7, 3]), (117, 0, [10**7, -(10**7), 10**7, 2]),
        (126, 0, [3 * 10**8, 1, 1, 1]), (127, 1, [3 * 10**8 - 1, 1, 1, 1]), (128, 0, [3 * 10**8, 2, 1, 1]),
    ]
    got = negatives.hard_negatives(table(spark, rows), F.col("vec_id") % 9 == 0, block_rows=16)
    # A short vector counts as padded with zeros.
    padded = [(i, n, None if v is None else v + [0] * (4 - len(v))) for i, n, v in rows]
    assert sorted(map(tuple, got.collect())) == brute(padded, lambda i: i % 9 == 0)


def test_nothing_to_mine(spark):
    rows = vectors(2, 20, 3)
    for some, anchor in ((rows[:0], F.lit(True)), (rows, F.lit(False)), ([(1, 1, [0, 0]), (2, 1, [0, 0])], F.lit(True))):
        assert negatives.hard_negatives(table(spark, some), anchor).count() == 0


def test_bounds_hold_for_every_pair():
    pick = np.random.default_rng(7)
    v = pick.integers(-300, 300, (200, 12))
    v[:20] = 0
    v[20:40] = v[40:60]
    v[60:80] = -v[40:60]
    v[80:100] = v[40:60] * 3
    units = negatives.references(v[30:].astype(float), 8)
    norms, angles = negatives.angles_to(v, units)
    stored = angles.astype(np.float32).astype(float)
    low, high = negatives.bounds(stored, norms, stored, norms, v.shape[1])
    exact = v @ v.T
    assert (low <= exact).all() and (exact <= high).all()
    # They say something: some of these spread vectors have a window of less than half of what norms allow.
    assert ((high - low) < np.outer(norms, norms)).mean() > 0.1
    blocks = np.array_split(np.argsort(angles[:, 0]), 9)
    least, most = (np.array([fn(stored[b], axis=0) for b in blocks]) for fn in (np.min, np.max))
    top = np.array([norms[b].max() for b in blocks])
    low, high = negatives.block_bounds(stored, norms, least, most, top, v.shape[1])
    for j, b in enumerate(blocks):
        assert (low[:, j, None] <= exact[:, b]).all() and (exact[:, b] <= high[:, j, None]).all()


def test_references_are_far_apart_and_bounded():
    rows = np.array([[1.0, 0], [0.9, 0.1], [0, 1], [-1, 0], [0, 0]])
    assert np.allclose(negatives.references(rows, 3), [[1, 0], [-1, 0], [0, 1]])
    assert negatives.references(np.zeros((3, 2)), 4).shape == (1, 2)
    assert len(negatives.references(rows, 99)) == 4
