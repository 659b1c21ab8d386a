"""Known values of a published sample season, found by header under a folder beside the repository.

Nothing of the sample is kept here; without the folder these tests are skipped.
"""

import os
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from courtside.functions import classify, equals_flag, min_distance, quality_flag, ratio_or_zero, shot_zone
from courtside.functions.labels import position_rules
from courtside.operators.boxstats import box_ratios
from courtside.operators.matchups import entity_profile, opponent_map
from courtside.operators.rolling import days_since_prev
from courtside.operators.shots import zone_stats
from courtside.operators.tables import fill_numeric
from courtside.plans.feature_build import build_features
from courtside.sources import files

FOLDER = Path(os.environ.get("COURTSIDE_SAMPLES", Path(__file__).resolve().parents[2] / "reference"))


def find(*columns):
    for path in sorted(FOLDER.rglob("*.csv")) if FOLDER.exists() else []:
        with path.open(encoding="utf-8-sig") as lines:
            header = lines.readline().strip().split(";")
        if set(columns) <= set(header) and ("Tm_MIN" in columns) == ("Tm_MIN" in header):
            return path
    pytest.skip("no sample season")


@pytest.fixture(scope="module")
def box(spark):
    path = find("jersey", "starter", "plus_minus")
    return files.box_table(files.read_delimited(spark, str(path.parent), path.name, files.BOX_SCHEMA)).cache()


@pytest.fixture(scope="module")
def shots(spark):
    path = find("sub_type", "x", "y", "result")
    return files.shot_table(files.read_delimited(spark, str(path.parent), path.name, files.SHOT_SCHEMA)).cache()


@pytest.fixture(scope="module")
def enriched(spark):
    path = find("Tm_MIN", "USG%")
    return files.read_delimited(spark, str(path.parent), path.name).cache()


def test_box(box):
    sides = box.groupBy("match_id", "team").agg(F.sum("points").alias("p"), F.sum("fouls").alias("f"), F.sum("starter").alias("s")).collect()
    assert sorted(r.p for r in sides) == [86, 96, 98, 102]
    assert sorted(r.f for r in sides) == [18, 24, 25, 29]
    assert {r.s for r in sides} == {5}


def test_shots(shots):
    assert {(r.result, r["count"]) for r in shots.groupBy("result").count().collect()} == {("made", 118), ("missed", 152)}
    assert {(r.action, r["count"]) for r in shots.groupBy("action").count().collect()} == {("2pt", 139), ("3pt", 131)}
    flagged = shots.withColumn("q", quality_flag(min_distance("x", "y"), "y"))
    got = {(r["count"], r.q) for r in flagged.groupBy("match_id").agg(F.count("*").alias("count"), F.sum("q").alias("q")).collect()}
    assert got == {(143, 65), (127, 55)}


def test_positions(box):
    profile = entity_profile(box, "player", ["rebounds", "blocks", "assists", "points"])
    got = Counter(r.c for r in profile.select(classify(position_rules()).alias("c")).collect())
    assert got == {"SF": 27, "PF": 9, "PG": 5, "C": 2, "SG": 2}


def test_rest(box):
    rest = days_since_prev(box, "player", ("date", "match_id"), "date").where("Days_Rest <> 7").collect()
    assert [r.Days_Rest for r in rest] == [364]


def assert_same(joined, pairs, tolerance=1e-9):
    gaps = joined.agg(*[F.max(F.abs(F.col(a) - F.col(b))).alias(a) for a, b in pairs]).first()
    assert all(gap is not None and gap <= tolerance for gap in gaps), gaps.asDict()


def test_zones(shots, enriched):
    zoned = shots.withColumn("zone", shot_zone("action", "sub_type", "y"))
    stats = zone_stats(zoned, ["match_id", "player"], "zone", F.col("result") == "made")
    mine = stats.select("match_id", "player", *[F.col(c).alias(f"m_{c}") for c in stats.columns[2:]])
    joined = fill_numeric(enriched.join(mine, ["match_id", "player"], "left"))
    assert joined.count() == 46
    pairs = [(f"m_{z}_{k}", f"{z}_{k}") for z in ("Rim", "Corner3", "MidRange", "Arc3") for k in ("Attempts", "Made", "Points", "Freq", "PPS")]
    assert_same(joined, pairs + [("m_FGA", "FGA"), ("m_FGM", "FGM")])


def test_ratios(enriched):
    given = ["Tm_MIN", "Tm_FGA", "Tm_FTA", "Tm_TOV", "Tm_REB", "Tm_OREB", "Tm_PTS", "Poss", "USG%", "ORtg", "TS%", "eFG%",
             "Reb_Share", "Scoring_Share", "Fouls_Per_Min", "Blowout_Factor", "Is_Home"]
    base = enriched.drop("opponent").withColumnsRenamed({c: f"s_{c}" for c in given})
    mine = box_ratios(opponent_map(base, "match_id", "team")).withColumn("Is_Home", equals_flag("team", "Home_Team_Name"))
    assert_same(mine, [(c, f"s_{c}") for c in given])
    assert_same(mine, [("opp_points_allowed", "Opp_Avg_Pts_Allowed"), ("opp_fg_allowed", "Opp_FG_Allowed")])
    fg = mine.withColumn("fg", ratio_or_zero("Clutch_FGM", "Clutch_FGA"))
    assert_same(fg, [("fg", "Clutch_FG%")])


def test_features_without_a_play_by_play(box, shots, enriched):
    features = build_features(box, None, shots, current_season=2024)
    assert features.count() == 46
    joined = features.join(enriched.select("match_id", "player", F.col("MIN_FL").alias("m"), F.col("opponent").alias("o")), ["match_id", "player"])
    assert joined.where("abs(MIN_FL - m) > 1e-12 or opponent <> o").count() == 0
    row = features.agg(F.sum("Fouls_Drawn"), F.sum("Synergy_Score"), F.sum("Dependency_Index")).first()
    assert tuple(row) == (0, 0.0, 0.0)
    totals = {(r.team, r.Opp_Avg_Pts_Allowed) for r in features.select("match_id", "team", "Opp_Avg_Pts_Allowed").distinct().collect()}
    assert sorted(p for _, p in totals) == [86, 96, 98, 102]


def test_scalar_map(spark):
    paths = sorted(FOLDER.rglob("*.json")) if FOLDER.exists() else []
    if not paths:
        pytest.skip("no scalar map")
    got = files.load_scalar_map(spark, str(paths[0]))
    assert (got.count(), got.where("value is null").count()) == (409, 3)
