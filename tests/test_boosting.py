"""Boosted trees against plain boosting over the same rows (F1, F2)."""

import os
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from courtside.operators import boosting
from courtside.plans.training import Boosting, fit_gbt

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(3)
    rows = []
    for n in range(400):
        a, b, c = pick.random(), pick.choice([None, 1.0, 2.0, 5.0]), pick.choice([float("nan"), *range(12)])
        c = None if n % 50 == 0 else float(c)
        rows.append((n, a, b, c, 3 * a + (b or 4) * a + pick.random(), pick.choice([0.0, 0.5, 1.0, 2.0])))
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y double, w double").repartition(3)


def plain(table, cuts, loss, depth, step, rounds):
    """Every cut of every feature tried on the rows of every node."""
    numbers = np.array([[np.nan if r[f] is None else r[f] for f in FEATURES] for r in table])
    label, weight = (np.array([r[c] for r in table]) for c in "yw")
    total = np.zeros(len(table))
    for turn in range(rounds):
        goal = label if not turn else np.where(label < total, -1.0, 1.0) if loss == "absolute" else 2 * (label - total)
        sse = lambda on: (weight[on] * (goal[on] - np.average(goal[on], weights=weight[on])) ** 2).sum()
        nodes, added = [(np.ones(len(table), bool), 0)], np.zeros(len(table))
        for on, level in nodes:
            added[on] = np.average(goal[on], weights=weight[on])
            if level == depth:
                continue
            found = []
            for f, points in enumerate(cuts):
                for point in points:
                    left = on & (numbers[:, f] <= point)
                    right = on & ~left
                    if weight[left].sum() and weight[right].sum():
                        found.append((sse(left) + sse(right), f, point, left, right))
            if found and (best := min(found, key=lambda x: round(x[0], 9)))[0] < sse(on) - 1e-9:
                nodes += [(best[3], level + 1), (best[4], level + 1)]
        total = total + added * (step if turn else 1.0)
    return total


@pytest.mark.parametrize("loss", ["squared", "absolute"])
def test_forecasts_are_those_of_plain_boosting(spark, rows, monkeypatch, loss):
    """Blocks of 50 rows, and forecasts brought up to date in between, from blocks old and new."""
    for name, value in (("BLOCK_ROWS", 50), ("REFRESH", 2), ("REBASE", 2)):
        monkeypatch.setattr(boosting, name, value)
    settings = Boosting(loss, 2, 0.1, 7)
    model = fit_gbt(rows, FEATURES, "y", "w", settings, "found")
    table = rows.collect()
    wanted = plain(table, boosting.cut_points(rows, FEATURES), loss, 2, 0.1, 7)
    found = {r.id: r.found for r in model.transform(rows).collect()}
    assert np.allclose([found[r.id] for r in table], wanted, atol=1e-9)
    last = model.stages[-1]
    assert last.getNumTrees == last.getMaxIter() == 7 and last.treeWeights == [1.0] + [0.1] * 6
    assert abs(last.featureImportances.toArray().sum() - 1) < 1e-9


def test_rows_take_a_byte_a_feature_and_layout_changes_no_round(spark, rows, monkeypatch):
    cuts = boosting.cut_points(rows, FEATURES)
    numbers = rows.select(*[F.coalesce(c, F.lit(float("nan"))) for c in FEATURES], "y", "w")
    blocks = boosting.to_blocks(numbers.coalesce(1), cuts)
    row = blocks.first()
    assert blocks.count() == 1 and (len(row.bins), len(row.label), len(row.weight)) == (1200, 3200, 3200)
    # A draw belongs to its block, so the same fit again is the same model.
    sampled = Boosting("squared", 2, 0.1, 3, 0.7, 0.7)
    one, two = (fit_gbt(rows.coalesce(1).sortWithinPartitions("id"), FEATURES, "y", None, sampled, "found") for _ in range(2))
    assert one.stages[-1].toDebugString.split("\n")[1:] == two.stages[-1].toDebugString.split("\n")[1:]


def test_labels_and_weights_are_looked_at(rows):
    for column, value in (("y", None), ("w", -1.0)):
        broken = rows.withColumn(column, F.when(F.col("id") == 7, F.lit(value)).otherwise(F.col(column)))
        with pytest.raises(Exception, match="must not be null"):
            fit_gbt(broken, FEATURES, "y", "w", Boosting("squared", 1, 0.1, 1))
    with pytest.raises(ValueError, match="no rows"):
        fit_gbt(rows.where("id < 0"), FEATURES, "y", "w", Boosting("squared", 1, 0.1, 1))


def test_passes_are_sent_numbers_and_lost_copies_change_no_tree(spark, rows, monkeypatch):
    """Between rounds copies are removed or put back to an earlier round (F2, F3)."""
    for name, value in (("BLOCK_ROWS", 50), ("REFRESH", 2), ("REBASE", 2)):
        monkeypatch.setattr(boosting, name, value)
    grow, sent = boosting.grow, set()

    def folder(batches):
        for _ in batches:
            yield pa.record_batch({"at": [os.path.dirname(boosting.Copy.path("", 0, 0))]})

    at = Path(spark.range(1).mapInArrow(folder, "at string").first().at)
    copies = lambda: sorted(at.glob("courtside-*"))

    def disturbed(fit, turn, tree, kept, *others):
        sent.add(tuple(kept.columns))
        for n, path in enumerate(copies() if turn else ()):
            if n % 3 == 0 and turn in (1, 4):
                path.unlink()
            elif n % 3 == 1 and turn in (3, 6):
                boosting.Copy(str(path), len(FEATURES)).head[:] = -1
        grow(fit, turn, tree, kept, *others)

    settings = Boosting("absolute", 3, 0.1, 8, 0.7, 0.7)
    ordered = rows.coalesce(1).sortWithinPartitions("id")
    wanted = fit_gbt(ordered, FEATURES, "y", "w", settings, "found").stages[-1]
    monkeypatch.setattr(boosting, "grow", disturbed)
    found = fit_gbt(ordered, FEATURES, "y", "w", settings, "found").stages[-1]
    assert found.toDebugString.split("\n")[1:] == wanted.toDebugString.split("\n")[1:]
    assert sent == {("part", "block")} and not copies()


@pytest.mark.parametrize("nodes", [4, 100])
def test_histograms_by_two_features_are_those_of_each(nodes):
    draw = np.random.default_rng(1)
    bins, node = draw.integers(0, boosting.BINS, (4, 500)).astype(np.uint8), draw.integers(0, nodes, 500).astype(np.uint8)
    weights = [draw.random(500), draw.random(500)]
    found = boosting.Histograms(4, nodes, [0, 1, 3])
    for part in (slice(0, 300), slice(300, 500)):
        found.add(bins[:, part], node[part], [w[part] for w in weights])
    sums = np.zeros((2, 4, nodes, boosting.BINS))
    for k, w in enumerate(weights):
        for f in (0, 1, 3):
            np.add.at(sums[k, f], (node, bins[f]), w)
    assert np.allclose(found.sums(2), sums)
