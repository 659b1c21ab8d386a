"""Feature building, training and forecasting end to end on a made-up league."""

import datetime as dt
import random
import types

import pytest
from pyspark.sql import functions as F

from courtside.catalog import QUERIES, base, forecasting
from courtside.operators.event_log import order_events
from courtside.operators.matchups import opponent_map
from courtside.plans import feature_build, forecast, training
from courtside.plans.feature_build import ASOF_OUTPUTS, MatchupState, matchup_features_asof
from courtside.plans.training import Boosting
from courtside.session import store
from courtside.sources.files import read_season
from tests.conftest import rows_of

TEAMS = [f"t{i}" for i in range(6)]


@pytest.fixture(scope="module")
def league(spark):
    """Two rounds per week for a year; each player has a level that history reveals."""
    rng = random.Random(5)
    level = {(t, i): (8 + 3 * i, 0.2 + 0.08 * ((i + ord(t[1])) % 5)) for t in TEAMS for i in range(8)}
    box, pbp, shots, match = [], [], [], 0
    for week in range(45):
        teams = rng.sample(TEAMS, 6)
        for a, b in zip(teams[::2], teams[1::2]):
            match += 1
            date = dt.date(2023, 9, 1) + dt.timedelta(days=7 * week)
            seq, score = 0, [0, 0]
            for side, team in enumerate((a, b)):
                for i in range(8):
                    minutes, rate = level[team, i]
                    played = max(0.0, minutes + rng.gauss(0, 2))
                    points = max(0, round(played * rate + rng.gauss(0, 1.5)))
                    box.append((match, date, team, f"{team}-{i}", int(i > 2), played, points, i, i % 4, i % 3, i % 2, 0, i % 2, rng.randrange(-20, 21), points))
                    shots.append((match, team, f"{team}-{i}", "2pt", "layup", 5.0 + i, 50.0, "made"))
                    for k in range(3):
                        seq += 1
                        score[side] += 2
                        kind = ["2pt", "assist", "substitution"][k]
                        pbp.append((match, 1 + seq % 4, f"0{seq % 9}:00", seq, team, f"{team}-{i}", kind, "in" if k == 2 else None, 1, *score))
    schemas = (
        "match_id long, date date, team string, player string, starter int, MIN_FL double, points long, rebounds long, "
        "assists long, fouls long, turnovers long, steals long, blocks long, plus_minus long, efficiency long",
        "match_id long, period int, clock string, seq long, team string, player string, action_type string, sub_type string, "
        "success int, score_home long, score_away long",
        "match_id long, team string, player string, action string, sub_type string, x double, y double, result string",
    )
    box, pbp, shots = (spark.createDataFrame(rows, s).cache() for rows, s in zip((box, pbp, shots), schemas))
    return box, order_events(pbp), shots


@pytest.fixture(scope="module")
def features(league):
    return feature_build.build_features(*league, current_season=2023, as_of=True).cache()


def test_one_row_per_box_row(league, features):
    assert features.count() == league[0].count()
    wanted = {
        "opponent", "Season_Weight", "Synergy_Score", "Assisted_Baskets", "Dependency_Index", "Gravity", "Pace_Est", "Raw_PPM",
        "Fouls_Drawn", "Shot_Quality_Avg", "Pos_Est", "Size_Index", "Opp_Avg_Pts_Allowed", "Opp_Avg_Fouls", "Opp_Avg_Pace",
        "Opp_Max_Foul_Drawer", "Opp_Best_Def_Synergy", "Opp_Allowed_Pos_Avg", "Opp_Avg_Size", "Mismatch_Adv", "Def_Suppressor",
        "Q1_Activity", "Q4_Activity", "Clutch_Events", "GT_Activity_Index",
    }
    assert wanted <= set(features.columns)
    whole = feature_build.build_features(*league, current_season=2023)
    assert wanted <= set(whole.columns) and whole.count() == features.count()
    assert features.agg(F.avg("Shot_Quality_Avg")).first()[0] == 1.0
    assert features.where("Synergy_Score > 0 and Q1_Activity + Q2_Activity + Q3_Activity + Q4_Activity = 1").count() > 0


def test_features_of_a_hot_match(league):
    some = [df.where("match_id <= 12") for df in league]
    columns = ["match_id", "player", "Synergy_Score", "Assisted_Baskets", "Fouls_Drawn"]
    plain = feature_build.build_features(*some).select(*columns)
    split = feature_build.build_features(*some, max_rows=20).select(*columns)
    assert rows_of(plain) == rows_of(split)


def test_history_does_not_know_its_own_match(league):
    """Changing the last match changes no feature of it that training uses."""
    box, pbp, shots = (df.where("match_id <= 40") for df in league)
    last = box.agg(F.max("date")).first()[0]
    bumped = box.withColumn("points", F.when(F.col("date") == last, F.col("points") + 50).otherwise(F.col("points")))
    names = {*training.RECENT_MINUTES_FEATURES, *training.RECENT_RATE_FEATURES} - training.SAME_MATCH_FEATURES

    def last_rows(table):
        ready = training.recent_features(feature_build.build_features(table, pbp, shots, 2023, as_of=True))
        return rows_of(ready.where(F.col("date") == last).select("player", *sorted(names & set(ready.columns))))

    assert last_rows(box) == last_rows(bumped)


def test_recent_features_against_pandas(features):
    got = training.recent_features(features).toPandas().sort_values(["player", "date", "match_id"]).reset_index(drop=True)
    past = got.groupby("player")["points"].transform(lambda s: s.shift(1).rolling(10, min_periods=1).mean()).fillna(0)
    assert (got["L10_points"] - past).abs().max() < 1e-9
    rate = got.groupby("player")["Raw_PPM"].transform(lambda s: s.shift(1).rolling(5).mean()).fillna(0)
    assert (got["L5_Adj_PPM"] - rate).abs().max() < 1e-9


def test_smoothed_features_against_pandas(features):
    got = training.smoothed_features(features).toPandas().sort_values(["player", "date", "match_id"]).reset_index(drop=True)
    by = got.groupby("player")
    minutes = by["MIN_FL"].transform(lambda s: s.expanding().sum().shift(1)).fillna(0)
    points = by["points"].transform(lambda s: s.expanding().sum().shift(1)).fillna(0)
    prior = got["points"].sum() / max(got["MIN_FL"].sum(), 1)
    weight = minutes / (minutes + 30)
    assert (got["Smoothed_PPM"] - (weight * points / minutes.clip(lower=1) + (1 - weight) * prior)).abs().max() < 1e-9
    season = by["MIN_FL"].transform(lambda s: s.expanding().mean().shift(1)).fillna(0)
    assert (got["Season_MIN_Avg"] - season).abs().max() < 1e-9


QUICK = Boosting("absolute", 3, 0.3, 6)
QUICK_RATE = Boosting("absolute", 3, 0.02, 6)  # a step is in units of the target, here points per minute


@pytest.fixture(scope="module")
def trained(features):
    ready = training.recent_features(features)
    return ready, *training.train_two_stage(ready, "recent", QUICK, QUICK_RATE)


def test_models_beat_the_mean(trained):
    ready, models, scored = trained
    assert scored.where("points_hat < 0").count() == 0
    mean = scored.agg(F.avg("points")).first()[0]
    naive = scored.agg(F.avg(F.abs(F.col("points") - mean))).first()[0]
    assert models.stats["mae_points"] < 0.7 * naive
    assert models.stats["sigma"] > 0 and 0 < models.stats["r2_points"] < 1


def test_smoothed_generation(features):
    ready = training.smoothed_features(features)
    models, scored = training.train_two_stage(ready, "smoothed", QUICK, Boosting("squared", 3, 0.3, 6, 0.9, 0.7))
    days = scored.agg(F.datediff(F.max("date"), F.min("date"))).first()[0]
    assert days <= 60 and models.stats["mae_points"] < 6
    assert not set(models.rate_features) & training.SAME_MATCH_FEATURES


def test_store_and_load(spark, trained, tmp_path):
    ready, models, scored = trained
    training.save_model(models, str(tmp_path))
    loaded = training.load_model(spark, str(tmp_path))
    rows = ready.where("match_id > 120")
    assert rows_of(models.predict(rows).select("player", "points_hat")) == rows_of(loaded.predict(rows).select("player", "points_hat"))
    stats = {r.name: r.value for r in training.model_stats(spark, str(tmp_path)).collect()}
    assert stats["mae_points"] == models.stats["mae_points"]
    ranked = training.importances(spark, loaded.minutes, loaded.minutes_features).collect()
    assert len(ranked) == len(loaded.minutes_features) and ranked[0].importance >= ranked[-1].importance


def test_matchup_and_line(trained):
    ready, models, _ = trained
    table = forecast.matchup(ready, models, "t1", "T2")
    rows = table.collect()
    assert {r.team for r in rows} == {"t1", "t2"} and len(rows) == 16
    assert all({r.team, r.opponent} == {"t1", "t2"} for r in rows)
    assert [r.edge for r in rows] == sorted((r.edge for r in rows), reverse=True)
    checked = forecast.check_line(table, "T1-7", 0.5, models.stats["sigma"], models.stats["mae_points"]).collect()
    assert len(checked) == 1 and checked[0].prob_over > 0.5
    assert abs(checked[0].prob_over + checked[0].prob_under - 1) < 1e-12


def test_matchup_knows_the_last_match_and_the_coming_opponent(spark):
    """Forecasts move with the side named, and form includes the last match played."""

    class ByOpponent:
        stats = {"sigma": 1.0}

        def predict(self, df):
            return df.withColumn("points_hat", F.col("Opp_Avg_Pace") + F.col("Is_Home"))

    rows = []
    for n, (one, two) in enumerate([("a", "b"), ("a", "c"), ("b", "c"), ("a", "b")] * 3):
        for side in (one, two):
            for k in range(3):
                pace = {"a": 1.0, "b": 2.0, "c": 5.0}[side]
                rows.append((n, dt.date(2024, 1, 1 + n), side, two if side == one else one, f"{side}{k}", n + k, pace))
    schema = "match_id long, date date, team string, opponent string, player string, points long, Pace_Est double"
    games = spark.createDataFrame(rows, schema)
    for c in ("rebounds", "blocks", "assists", "fouls", "Fouls_Drawn", "Synergy_Score", "MIN_FL", "efficiency"):
        games = games.withColumn(c, F.lit(3.0))
    against = {s: {r.player: r for r in forecast.matchup(games, ByOpponent(), "a", s, home=False).collect()} for s in ("b", "c")}
    assert {p: r.points_hat for p, r in against["b"].items() if r.team == "a"} == {f"a{k}": 2.0 for k in range(3)}
    assert {p: r.points_hat for p, r in against["c"].items() if r.team == "a"} == {f"a{k}": 5.0 for k in range(3)}
    assert {r.points_hat for r in against["c"].values() if r.team == "c"} == {2.0}
    mine = sorted((r[0], r[5]) for r in rows if r[4] == "a0")[-5:]
    assert against["b"]["a0"].form == sum(p for _, p in mine) / 5
    assert {r.last_played for r in against["b"].values()} == {dt.date(2024, 1, 12)}


def test_forecast_features_are_those_of_the_whole_table(spark):
    """The state of the league gives what a recomputation over all rows and the coming ones gives."""
    pick = random.Random(4)
    rows = []
    for n in range(24):
        one, two = pick.sample("abcd", 2)
        for side in (one, two):
            for k in pick.sample(range(6), 5):
                numbers = [pick.randrange(30), *(pick.randrange(12) for _ in range(6)), pick.uniform(0, 2)]
                rows.append((n, dt.date(2024, 1, 1 + n // 2), side, two if side == one else one, f"{side}{k}", *numbers))
    names = "points, rebounds, blocks, assists, fouls, Fouls_Drawn, MIN_FL".split(", ")
    schema = "match_id long, date date, team string, opponent string, player string, " + ", ".join(f"{c} long" for c in names)
    games = spark.createDataFrame(rows, schema + ", Pace_Est double").withColumn("Synergy_Score", F.col("Pace_Est") / 3)
    coming = forecast.next_match(games, "a", "b").where("_next")
    whole = games.withColumn("_next", F.lit(False)).unionByName(coming, allowMissingColumns=True)
    wanted = matchup_features_asof(whole).where("_next").select("player", *ASOF_OUTPUTS)
    got = MatchupState.of(games).attach(coming).select("player", *ASOF_OUTPUTS)
    assert got.count() > 8 and rows_of(got) == rows_of(wanted)
    # Only matches before the day asked for count.
    early = F.lit(dt.date(2024, 1, 7))
    model = type("Size", (), {"stats": {"sigma": 1.0}, "predict": lambda self, df: df.withColumn("points_hat", F.col("Opp_Avg_Size"))})()
    form = lambda df: df.withColumn("L5_points", F.lit(0.0))
    before = games.where(F.col("date") < early)
    now = forecast.matchup(games, model, "a", "b", date=early, prepare=form)
    then = MatchupState.of(before).attach(forecast.next_match(games, "a", "b", date=early).where("_next"))
    assert {r.player: r.points_hat for r in now.collect()} == {r.player: r.Opp_Avg_Size for r in then.collect()}


def test_undated_rows_of_files_are_dated_and_trained_on(spark, tmp_path):
    head = "match_id;date;team;player;starter;minutes;points;rebounds;assists;fouls;turnovers;steals;blocks;plus_minus;efficiency"
    line = lambda m, date, side, k: f"{m};{date};{side};{side}{k};1;20:00;{m + k};1;2;1;0;0;0;3;4"
    for name, first, dates in (("a", 1, ["", "2024-01-02", "", "2024-01-09"]), ("b", 11, ["2024-02-01", "soon", ""])):
        lines = [line(first + n, d, side, k) for n, d in enumerate(dates) for side in "xy" for k in range(2)]
        (tmp_path / f"{name}_box_score.csv").write_text("\n".join([head, *lines]) + "\n")
    box, *_ = read_season(spark, str(tmp_path))
    features = feature_build.build_features(box, current_season=2024, as_of=True)
    days = {r.match_id: str(r.date) for r in training.recent_features(features).select("match_id", "date").distinct().collect()}
    # The rows before the first date of whichever file comes first take that date.
    assert days.pop(1) in ("2024-01-02", "2024-02-01")
    assert days == {
        2: "2024-01-02", 3: "2024-01-02", 4: "2024-01-09", 11: "2024-02-01", 12: "2024-02-01", 13: "2024-02-01",
    }
    assert features.count() == 28 and features.where("date IS NULL").isEmpty()


def test_same_day_is_not_earlier(spark):
    from courtside.operators.matchups import asof_aggregate

    rows = [(1, dt.datetime(2024, 1, 1, 10), 1.0), (1, dt.datetime(2024, 1, 1, 20), 3.0), (1, dt.datetime(2024, 1, 2, 1), 9.0)]
    got = asof_aggregate(spark.createDataFrame(rows, "k int, ts timestamp, v double"), "k", "ts", {"m": "v"}).orderBy("ts").collect()
    assert [r.m for r in got] == [None, None, 2.0]


def test_overtime_counts(spark):
    from courtside.plans.feature_build import event_counts

    rows = [(1, "p", n, "2pt", None, 1, 50, 50, 10) for n in (1, 4, 5, 6)]
    schema = "match_id long, player string, period int, action_type string, sub_type string, success int, score_home long, score_away long, SEC int"
    got = event_counts(spark.createDataFrame(rows, schema)).first()
    assert (got.Q1_Activity, got.Q2_Activity, got.Q4_Activity, got.OT_Activity) == (1, 0, 1, 2)


@pytest.mark.parametrize("name, boosting", [("gbt_minutes", training.SMOOTHED_MINUTES), ("gbt_rate", training.SMOOTHED_RATE)])
def test_model_queries_fit_all_rounds(spark, sf_dir, monkeypatch, name, boosting):
    used = []

    def fit(train, features, label, weight, given, out):
        used.append(given)
        return training.fit_gbt(train, features, label, weight, training.Boosting("squared", 1, 0.1, 1), out)

    monkeypatch.setattr(forecasting, "fit_gbt", fit)
    assert QUERIES[name](spark, sf_dir).count() > 0
    assert used == [boosting] and boosting.rounds >= 300


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_forecast_state_shuffles_once_per_match(spark, monkeypatch):
    """grouping, dating and pairing by match share a shuffle; nothing measured is worked out twice."""
    lines = [(n, k, 1.0 * k, k % 4, 0.05, 0.02, "R", "FO"[k % 2]) for n in range(6) for k in range(5)]
    schema = "l_orderkey long, l_partkey long, l_quantity double, l_linenumber int, l_discount double, l_tax double, "
    lineitem = spark.createDataFrame(lines, schema + "l_returnflag string, l_linestatus string")
    dates = spark.createDataFrame([(n, dt.date(2024, 1, 1 + n)) for n in range(6)], "match_id long, date date")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = base.box(types.SimpleNamespace(lineitem=lineitem)).join(dates, "match_id")
        assert exchanges(rows) == 2
        games = opponent_map(rows, "match_id", "team").withColumns(
            {"Pace_Est": F.col("points") / 2, "Fouls_Drawn": F.col("turnovers"), "Synergy_Score": F.col("assists") / 2}
        )
        written = []
        monkeypatch.setattr(feature_build, "store", lambda df: written.append(exchanges(df)) or store(df))
        state = MatchupState.of(store(games))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The history of players, then the values of sides, each from one pass, then the three states.
    assert len(written) == 5 and sorted(written)[:4] == [1, 1, 1, 1]
    means = {r.player: r._s__p_points / r._n__p_points for r in state.players.collect()}
    assert means == {k: 1.0 * k for k in range(5)}
