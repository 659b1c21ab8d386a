"""Split windows must equal plain windows, whatever the group sizes."""

import math
import random

import pytest
from pyspark.sql import functions as F

from courtside.operators import rolling
from courtside.operators.exact import Bins, exact_sums
from courtside.operators.ordered import find_cuts, ordered
from courtside.operators.tables import fill_along
from tests.conftest import rows_of

SPLIT = 40  # groups above this size are cut in these tests


@pytest.fixture(scope="module")
def hot(spark):
    """One key holds most rows, many rows share a date, keys and values may be missing."""
    rng = random.Random(3)
    rows = []
    for i in range(900):
        key = None if i % 50 == 7 else ("hot" if rng.random() < 0.6 else f"k{rng.randrange(12)}")
        day = 5 if rng.random() < 0.4 else rng.randrange(60)
        value = None if rng.random() < 0.2 else rng.randrange(100)
        rows.append((key, day, i, value, rng.randrange(1, 9)))
    return spark.createDataFrame(rows, "k string, d int, id int, v long, m long").repartition(7).cache()


def both(fn):
    return rows_of(fn(SPLIT)), rows_of(fn(10**9))


def test_cuts_only_where_needed(hot):
    assert find_cuts(hot, "k", ("d", "id"), max_rows=10**6).parts == 0
    cuts = find_cuts(hot, "k", ("d", "id"), max_rows=SPLIT)
    assert cuts.parts == 45
    work = ordered(hot, "k", ("d", "id"), cuts)
    parts = work.df.where("k = 'hot'").groupBy("_part").agg(F.count("*").alias("n"), F.min("d"), F.max("d")).collect()
    assert len(parts) > 5 and max(r.n for r in parts) < 4 * SPLIT
    assert "hot" in {r.k for r in work.crossing.collect()} and work.crossing.count() < cuts.parts


def test_coarse_groups_decide(hot):
    fine = hot.where("m > 100")
    assert find_cuts(fine, ("k", "m"), "id", max_rows=10**6, coarse=(hot, ("k",))).parts == 0
    assert find_cuts(hot, ("k", "m"), "id", max_rows=SPLIT, coarse=(hot, ("k",))).parts > 0


@pytest.mark.parametrize(
    "fn",
    [
        lambda df, n: rolling.lag_features(df, "k", ("d", "id"), ["v", "m"], max_rows=n),
        lambda df, n: rolling.rolling_mean(df, "k", ("d", "id"), ["v"], max_rows=n),
        lambda df, n: rolling.rolling_mean(df, "k", ("d", "id"), "v", (4,), 4, max_rows=n),
        lambda df, n: rolling.rolling_mean(df, "k", ("d", "id"), "v", (50,), max_rows=n),
        lambda df, n: rolling.expanding(df, "k", ("d", "id"), "v", ("avg", "sum", "count"), max_rows=n),
        lambda df, n: rolling.rolling_std(df, "k", ("d", "id"), "v", 6, max_rows=n),
        lambda df, n: rolling.shrunk_rate(df, "k", ("d", "id"), "v", "m", max_rows=n),
        lambda df, n: rolling.rolling_rate(df, "k", ("d", "id"), "v", "m", max_rows=n),
        lambda df, n: rolling.prior_mean(df, ("k", "m"), ("d", "id"), "v", "p", max_rows=n),
        lambda df, n: ordered(df, "k", ("d", "id"), max_rows=n)
        .rows(lambda w: {"nx": F.lead("v", 3).over(w)}, ahead=3)
        .done(),
        lambda df, n: fill_along(df, "v", ("d", "id"), "k", max_rows=n),
        lambda df, n: fill_along(df, "v", ("d", "id"), max_rows=n),
    ],
)
def test_split_equals_plain(hot, fn):
    split, plain = both(lambda n: fn(hot, n))
    assert split == plain


def test_parts_smaller_than_the_frame(hot):
    """Parts of one or two rows, so that frames reach over many of them."""
    some = hot.where("id < 300")
    work = ordered(some, "k", ("d", "id"), max_rows=1)
    frames = lambda w: {"b": F.sum("m").over(w.rowsBetween(-7, -1)), "a": F.sum("m").over(w.rowsBetween(1, 5))}
    split = rows_of(work.rows(frames, back=7, ahead=5).done())
    assert split == rows_of(ordered(some, "k", ("d", "id")).rows(frames, back=7, ahead=5).done())


def test_cutting_changes_no_bit_of_running_totals(spark):
    rng = random.Random(8)
    rows = [("hot" if rng.random() < 0.7 else f"k{i % 5}", i, rng.uniform(-1e6, 1e6) / 3, rng.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, id int, v double, m double").repartition(5)
    exact = lambda frame: sorted(tuple(r) for r in frame.collect())
    for build in (
        lambda n: rolling.expanding(df, "k", "id", "v", ("avg", "sum"), max_rows=n),
        lambda n: rolling.shrunk_rate(df, "k", "id", "v", "m", max_rows=n),
    ):
        assert exact(build(100)) == exact(build(10**9))


def same(a, b):
    return (math.isnan(a) and math.isnan(b)) or a == b if None not in (a, b) else a is b


@pytest.mark.parametrize("max_rows", [3, 10**9])
def test_running_totals_of_what_is_no_number(spark, max_rows):
    inf, nan = float("inf"), float("nan")
    groups = {
        "a": [1.5, nan, inf, None, 1e300, 2.0],
        "b": [None, 2e15, 3.0, 1e-14, 1e-14, -2e15],
        "c": [inf, 1.0, -inf, 5.0],
        "d": [-inf, -1.0, 0.0, -0.0, 5e-324, 7.0],
        "e": [0.0, None, 0.0],
    }
    rows = [(k, i, v) for k, values in groups.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, id int, v double")
    got = {(r.k, r.id): r.Hist_sum_v for r in rolling.expanding(df, "k", "id", "v", ("sum",), max_rows=max_rows).collect()}
    for k, values in groups.items():
        for i in range(len(values)):
            before = [v for v in values[:i] if v is not None]
            finite = [v for v in before if math.isfinite(v)]
            # Of infinities and what is no number the plain sum; of the rest the correctly rounded one.
            want = None if not before else sum(before) if len(finite) < len(before) else math.fsum(before)
            assert same(got[k, i], want), (k, i, got[k, i], want)


def test_sums_of_all_magnitudes(spark):
    """Cut or not, in any order, bit for bit; and next to the correctly rounded sum."""
    rng = random.Random(12)
    rows = [("hot" if rng.random() < 0.6 else f"k{i % 4}", i, rng.choice([-1, 1]) * rng.uniform(1, 2) * 10.0 ** rng.uniform(-300, 300)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, id int, v double")
    bits = lambda frame: {(r.k, r.id): r.Hist_sum_v for r in frame.collect()}
    plain = bits(rolling.expanding(df, "k", "id", "v", ("sum",), max_rows=10**9))
    assert plain == bits(rolling.expanding(df.repartition(7), "k", "id", "v", ("sum",), max_rows=40))
    for key in {r[0] for r in rows}:
        values = [(i, v) for k, i, v in rows if k == key]
        for n, (i, _) in enumerate(values[1:], 1):
            want = math.fsum(v for _, v in values[:n])
            assert abs(plain[key, i] - want) <= math.ulp(want)
    sums = {r.k: r.v for r in exact_sums(df, ["k"], {"v": F.col("v")}).collect()}
    shuffled = df.orderBy(F.rand(3)).repartition(5)
    assert sums == {r.k: r.v for r in exact_sums(shuffled, ["k"], {"v": F.col("v")}).collect()}


def test_usual_data_need_few_bins():
    assert len(Bins.between(0.01, 50_000.0).places) <= 4
    assert Bins.between(None, 0.0).places == (0,)


def test_work_without_keys_is_always_cut(hot):
    assert find_cuts(hot, (), ("d", "id")).parts >= 2


def test_fill_against_pandas(hot):
    pdf = hot.toPandas().sort_values(["d", "id"])
    expect = pdf["v"].ffill().bfill().astype(int).tolist()
    got = fill_along(hot, "v", ("d", "id"), max_rows=SPLIT).toPandas().sort_values(["d", "id"])["v"].tolist()
    assert got == expect


def test_rolling_against_pandas(hot):
    got = rolling.rolling_mean(hot.where("k is not null"), "k", ("d", "id"), "m", (5,), max_rows=SPLIT).toPandas()
    pdf = got.sort_values(["k", "d", "id"]).reset_index(drop=True)
    expect = pdf.groupby("k")["m"].transform(lambda s: s.shift(1).rolling(5, min_periods=1).mean())
    assert (pdf["L5_m"].fillna(-1) - expect.fillna(-1)).abs().max() < 1e-9
