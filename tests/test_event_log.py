"""Presence, stints and next actors against a plain walk through the log."""

import random

import pytest
from pyspark.sql import functions as F

from courtside.operators import event_log


def make_log(seed, matches=8, events=70):
    """Random logs with double comings, absent leavers, equal clocks, strangers and missing scores."""
    rng = random.Random(seed)
    rows, squads = [], []
    for match in range(matches):
        players = [f"p{i}" for i in range(8)]
        squads += [(match, p, int(i < 5)) for i, p in enumerate(players)]
        score = 0
        for seq in range(events if match else 6 * events):
            period, sec = 1 + seq * 4 // events, float(600 - seq % 40 // 2)
            kind = rng.choice(["sub", "score", "assist", "other"])
            score += rng.choice([0, 1, 2, 3]) if kind == "score" else 0
            shown = None if rng.random() < 0.1 else score
            who = rng.choice([*players, "stranger", None])
            change = rng.choice([0, 1]) if kind == "sub" else None
            rows.append((match, min(period, 5), -sec, seq, who, kind, change, shown))
    rng.shuffle(rows)
    return rows, squads


def in_order(rows, match):
    return sorted((r for r in rows if r[0] == match), key=lambda r: r[1:4])


def walk_presence(rows, squads):
    result = {}
    for match in {m for m, _, _ in squads}:
        present = {p for m, p, s in squads if m == match and s}
        credited = {p: [] for m, p, _ in squads if m == match}
        last = known = 0
        for *_, who, _kind, change, shown in in_order(rows, match):
            known = known if shown is None else shown
            if known != last:
                for p in present & credited.keys():
                    credited[p].append(known - last)
            last = known
            if change == 1:
                present.add(who)
            elif change == 0:
                present.discard(who)
        for p, moves in credited.items():
            result[match, p] = sum(moves) / len(moves) if moves else 0.0
    return result


@pytest.fixture(scope="module", params=[1, 2, 3])
def logs(spark, request):
    rows, squads = make_log(request.param)
    schema = "match_id int, period int, neg_sec double, seq int, player string, kind string, change int, score int"
    frames = spark.createDataFrame(rows, schema).repartition(5), spark.createDataFrame(
        squads, "match_id int, player string, starter int"
    )
    return rows, squads, *frames


@pytest.mark.parametrize("max_rows", [10**6, 70])
def test_presence(logs, max_rows):
    rows, squads, events, roster = logs
    got = event_log.presence_mean(
        events, roster, "match_id", "player", event_log.EVENT_ORDER, "score", "change", max_rows=max_rows
    ).collect()
    want = walk_presence(rows, squads)
    assert len(got) == len(want)
    assert all(abs(r.Synergy_Score - want[r.match_id, r.player]) < 1e-9 for r in got)


@pytest.mark.parametrize("max_rows", [10**6, 70])
def test_next_actor(logs, max_rows):
    rows, _, events, _ = logs
    want = {}
    for match in {r[0] for r in rows}:
        ordered = in_order(rows, match)
        for now, after in zip(ordered, ordered[1:]):
            if now[5] == "assist" and after[4] is not None:
                want[match, after[4]] = want.get((match, after[4]), 0) + 1
    action = F.col("kind") == "assist"
    got = event_log.next_actor_count(
        events, "match_id", "player", event_log.EVENT_ORDER, action, max_rows=max_rows
    ).collect()
    assert {(r.match_id, r.player): r.Assisted_Baskets for r in got} == want


def test_stints_cover_presence(logs, spark):
    """Crediting by stint intervals gives the same means as the running totals."""
    rows, squads, events, roster = logs
    place = {(r[0], r[3]): i for m in {r[0] for r in rows} for i, r in enumerate(in_order(rows, m))}
    numbered = [(m, place[m, q], who, change) for m, _, _, q, who, _, change, _ in rows]
    flat = spark.createDataFrame(numbered, "match_id int, at int, player string, change int")
    intervals = event_log.stints(flat, roster, "match_id", "player", "at", "change").collect()
    moves = {}
    for m in {r[0] for r in rows}:
        last = known = 0
        for i, r in enumerate(in_order(rows, m)):
            known = known if r[7] is None else r[7]
            if known != last:
                moves.setdefault(m, []).append((i, known - last))
            last = known
    credited = {}
    for r in intervals:
        inside = [
            d
            for at, d in moves.get(r.match_id, [])
            if (r.came is None or at > r.came) and (r.left is None or at <= r.left)
        ]
        credited.setdefault((r.match_id, r.player), []).extend(inside)
    for key, want in walk_presence(rows, squads).items():
        mine = credited.get(key, [])
        assert abs((sum(mine) / len(mine) if mine else 0.0) - want) < 1e-9


def test_counts_and_pivot(spark):
    rows = [
        (1, "a", 1, "2pt", 1), (1, "a", 1, "3pt", 1), (1, "a", 2, "freethrow", 1), (1, "a", 2, "2pt", 0),
        (1, "b", 5, "2pt", 1), (1, "b", 4, "foulon", 1), (2, "a", 3, "2pt", 1),
    ]
    df = spark.createDataFrame(rows, "match_id int, player string, period int, action_type string, success int")
    scoring = F.col("action_type").rlike(event_log.SCORING_PATTERN) & (F.col("success") == 1)
    got = event_log.activity_pivot(df, ["match_id", "player"], "period", scoring, (1, 2, 3, 4, 5)).collect()
    table = {(r.match_id, r.player): [r[f"Q{p}_Activity"] for p in (1, 2, 3, 4, 5)] for r in got}
    assert table == {(1, "a"): [2, 1, 0, 0, 0], (1, "b"): [0, 0, 0, 0, 1], (2, "a"): [0, 0, 1, 0, 0]}


@pytest.mark.parametrize("max_rows, width", [(10**6, 64), (70, 3)])
def test_presence_by_interval(logs, max_rows, width):
    rows, squads, events, roster = logs
    got = event_log.presence_by_interval(
        events, roster, "match_id", "player", event_log.EVENT_ORDER, "score", "change", width=width, max_rows=max_rows
    ).collect()
    want = walk_presence(rows, squads)
    assert len(got) == len(want)
    assert all(abs(r.Synergy_Score - want[r.match_id, r.player]) < 1e-9 for r in got)


@pytest.mark.parametrize("width", [1, 5, 1000])
def test_interval_join_against_all_pairs(spark, width):
    rng = random.Random(width)
    points = [(rng.choice(["a", "b", None]), rng.choice([None, *range(-20, 80)]), i) for i in range(150)]
    spans = []
    for i in range(60):
        start, length = rng.randrange(-25, 80), rng.choice([-3, 0, 1, 7, 40])
        spans.append((rng.choice(["a", "b", None]), rng.choice([start, start, None]), start + length, i))
    got = event_log.interval_join(
        spark.createDataFrame(points, "k string, at long, point int"),
        spark.createDataFrame(spans, "k string, came long, gone long, span int"),
        "k", "at", "came", "gone", width,
    )
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    want = [
        (p, s) for k, at, p in points for key, came, gone, s in spans
        if k is not None and k == key and at is not None and came is not None and came < at <= gone
    ]
    assert want and sorted((r.point, r.span) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("max_rows", [10**6, 40])
def test_interval_sums_against_all_pairs(spark, max_rows):
    rng = random.Random(max_rows)
    points = [(rng.choice(["a", "b", None]), rng.choice([None, *range(-20, 80)]), rng.randrange(-9, 10)) for _ in range(150)]
    spans = []
    for i in range(90):
        start, length = rng.randrange(-25, 80), rng.choice([-3, 0, 1, 7, 40])
        spans.append((rng.choice(["a", "b", None]), rng.choice([start, start, None]), start + length, rng.choice([None, i % 9])))
    got = event_log.interval_sums(
        spark.createDataFrame(points, "k string, at long, v long"),
        spark.createDataFrame(spans, "k string, came long, gone long, who long"),
        "k", "at", "came", "gone", {"total": F.col("v"), "n": F.lit(1)}, ("who",), max_rows,
    )
    want = {}
    for key, came, gone, who in spans:
        if key is not None and came is not None and came < gone:
            inside = [v for k, at, v in points if k == key and at is not None and came < at <= gone]
            total, n = want.get((key, who), (0, 0))
            want[key, who] = total + sum(inside), n + len(inside)
    assert want and {(r.k, r.who): (r.total, r.n) for r in got.collect()} == want


def test_presence_by_interval_pairs_nothing(spark):
    """1,500 players on the floor of 3,000 scoring events: 4.5 million pairs, of which no join may make any."""
    events = spark.range(3000).select(
        F.lit(1).alias("m"), (F.col("id") % 1500).alias("who"), "id", F.col("id").alias("score"), F.lit(None).cast("int").alias("change")
    )
    roster = spark.range(1500).select(F.lit(1).alias("m"), F.col("id").alias("who"), F.lit(1).alias("starter"))
    got = event_log.presence_by_interval(events, roster, "m", "who", "id", "score", "change")
    assert {r.Synergy_Score for r in got.collect()} == {1.0}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_bin" not in plan
