"""Shots, team totals, opponents and profiles over lineitem as a box score."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from courtside.catalog.base import (
    DATED_SQL,
    OPPONENT_SQL,
    Tables,
    box,
    box_sql,
    dated_box,
    day_text,
    query,
    r6,
)
from courtside.functions import (
    classify,
    effective_fg,
    equals_flag,
    min_distance,
    off_rating,
    possessions,
    quality_flag,
    ratio_or_zero,
    ratio_zero_one,
    season_weight,
    shot_zone,
    true_shooting,
    usage,
    weighted_sum,
)
from courtside.functions.labels import GRAVITY_WEIGHTS, SIZE_WEIGHTS, position_rules
from courtside.operators import matchups
from courtside.operators.boxstats import box_ratios, side_totals
from courtside.operators.ordered import find_cuts
from courtside.operators.rolling import prior_mean
from courtside.operators.shots import ZONE_POINTS, rate_by, zone_stats
from courtside.session import store

# --- shots: quantity and tax as coordinates -----------------------------------------------

SHOTS_SQL = """shots AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 2 * l_quantity AS x, round(l_tax * 1000) AS y,
  CASE WHEN l_linenumber <= 4 THEN '2pt' ELSE '3pt' END AS action,
  CASE WHEN l_linestatus = 'F' THEN 'drivinglayup' ELSE 'jumpshot' END AS sub_type, l_returnflag = 'R' AS made FROM lineitem)"""
DIST_SQL = "least(sqrt((x - 5) * (x - 5) + (y - 50) * (y - 50)), sqrt((x - 95) * (x - 95) + (y - 50) * (y - 50)))"
QUALITY_SQL = f"CASE WHEN {DIST_SQL} < 8 OR ({DIST_SQL} > 22 AND abs(y - 50) > 35) THEN 1 ELSE 0 END"
SHOT_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _shots(t: Tables) -> DataFrame:
    return t.lineitem.select(
        *SHOT_KEYS,
        (2 * F.col("l_quantity")).alias("x"),
        F.round(F.col("l_tax") * 1000).alias("y"),
        F.when(F.col("l_linenumber") <= 4, "2pt").otherwise("3pt").alias("action"),
        F.when(F.col("l_linestatus") == "F", "drivinglayup").otherwise("jumpshot").alias("sub_type"),
        (F.col("l_returnflag") == "R").alias("made"),
    )


@query("min_distance", f"WITH {SHOTS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round({DIST_SQL}, 6) AS dist FROM shots")
def distance(t: Tables) -> DataFrame:
    return _shots(t).select(*SHOT_KEYS, r6(min_distance("x", "y")).alias("dist"))


@query("quality_flag", f"WITH {SHOTS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {QUALITY_SQL} AS quality FROM shots")
def quality(t: Tables) -> DataFrame:
    return _shots(t).select(*SHOT_KEYS, quality_flag(min_distance("x", "y"), "y").alias("quality"))


@query(
    "quality_rate",
    f"WITH {SHOTS_SQL} SELECT l_orderkey, l_suppkey, round(avg({QUALITY_SQL}), 6) AS Shot_Quality_Avg FROM shots GROUP BY 1, 2",
)
def quality_rate(t: Tables) -> DataFrame:
    flagged = _shots(t).withColumn("q", quality_flag(min_distance("x", "y"), "y"))
    rate = rate_by(flagged, ["l_orderkey", "l_suppkey"], "q", "Shot_Quality_Avg")
    return rate.withColumn("Shot_Quality_Avg", r6("Shot_Quality_Avg"))


def _zone_sql(zone: str, worth: int) -> str:
    made = f"count(CASE WHEN zone = '{zone}' AND made THEN 1 END)"
    tried = f"count(CASE WHEN zone = '{zone}' THEN 1 END)"
    return f"""{tried} AS {zone}_Attempts, {made} AS {zone}_Made, {made} * {worth} AS {zone}_Points,
      round({tried} / count(*), 6) AS {zone}_Freq, round(coalesce({made} * {worth} / nullif({tried}, 0), 0), 6) AS {zone}_PPS"""


@query(
    "zone_stats",
    f"""WITH {SHOTS_SQL}, zoned AS (SELECT *, CASE WHEN action = '2pt' THEN
          CASE WHEN sub_type = 'drivinglayup' THEN 'Rim' ELSE 'MidRange' END
          WHEN abs(y - 50) > 40 THEN 'Corner3' ELSE 'Arc3' END AS zone FROM shots)
        SELECT l_partkey, count(*) AS FGA, count(CASE WHEN made THEN 1 END) AS FGM,
          {", ".join(_zone_sql(z, w) for z, w in ZONE_POINTS.items())} FROM zoned GROUP BY 1""",
)
def zones(t: Tables) -> DataFrame:
    zoned = _shots(t).withColumn("zone", shot_zone("action", "sub_type", "y"))
    stats = zone_stats(zoned, ["l_partkey"], "zone", F.col("made"))
    return stats.withColumns({f"{z}_{k}": r6(f"{z}_{k}") for z in ZONE_POINTS for k in ("Freq", "PPS")})


# --- team totals and shares ---------------------------------------------------------------

KEYS = ("match_id", "team", "player")
_BOX = box_sql("l_partkey")
_TOTALS = """totals AS (SELECT match_id, team, CAST(sum(points) AS BIGINT) AS Tm_points, CAST(sum(rebounds) AS BIGINT) AS Tm_rebounds,
  CAST(sum(minutes) AS BIGINT) AS Tm_minutes, CAST(sum(assists) AS BIGINT) AS Tm_assists,
  CAST(sum(turnovers) AS BIGINT) AS Tm_turnovers FROM box GROUP BY 1, 2)"""
_JOINED = f"WITH {_BOX}, {_TOTALS}, j AS (SELECT box.*, totals.* EXCLUDE (match_id, team) FROM box JOIN totals USING (match_id, team))"


def _with_totals(t: Tables) -> DataFrame:
    return side_totals(box(t), "match_id", "team", ["points", "rebounds", "minutes", "assists", "turnovers"])


@query("team_totals", f"{_JOINED} SELECT match_id, team, player, Tm_points, Tm_rebounds, Tm_minutes FROM j")
def team_totals(t: Tables) -> DataFrame:
    return _with_totals(t).select(*KEYS, "Tm_points", "Tm_rebounds", "Tm_minutes")


@query(
    "usage_rate",
    f"""{_JOINED}, u AS (SELECT *, rebounds + 0.44::DOUBLE * assists + turnovers AS own,
          Tm_rebounds + 0.44::DOUBLE * Tm_assists + Tm_turnovers AS side, rebounds + 0.44::DOUBLE * assists + turnovers - blocks AS p FROM j)
        SELECT match_id, team, player, round(p, 6) AS poss,
          round(CASE WHEN minutes * side = 0 THEN 0 ELSE 100 * own * (Tm_minutes / 5) / (minutes * side) END, 6) AS usg,
          round(CASE WHEN abs(p) < 0.001 THEN 0 ELSE 100 * points / p END, 6) AS ortg FROM u""",
)
def usage_rate(t: Tables) -> DataFrame:
    poss = possessions("rebounds", "assists", "turnovers", "blocks")
    usg = usage("rebounds", "assists", "turnovers", "minutes", "Tm_rebounds", "Tm_assists", "Tm_turnovers", "Tm_minutes")
    settled = F.when(F.abs(poss) < 0.001, 0.0).otherwise(poss)
    return _with_totals(t).select(
        *KEYS, r6(poss).alias("poss"), r6(usg).alias("usg"), r6(off_rating("points", settled)).alias("ortg")
    )


@query(
    "shooting_eff",
    f"""WITH {_BOX} SELECT match_id, team, player,
          round(coalesce(points / nullif(2 * (rebounds + 0.44::DOUBLE * fouls), 0), 0), 6) AS ts,
          round(coalesce((turnovers + 0.5::DOUBLE * fouls) / nullif(assists, 0), 0), 6) AS efg FROM box""",
)
def shooting_eff(t: Tables) -> DataFrame:
    ts, efg = true_shooting("points", "rebounds", "fouls"), effective_fg("turnovers", "fouls", "assists")
    return box(t).select(*KEYS, r6(ts).alias("ts"), r6(efg).alias("efg"))


@query(
    "shares",
    f"""{_JOINED} SELECT match_id, team, player, round(coalesce(rebounds / nullif(Tm_rebounds, 0), 0), 6) AS Reb_Share,
          round(coalesce(points / nullif(Tm_points, 0), 0), 6) AS Scoring_Share,
          round(coalesce(fouls / nullif(minutes, 0), 0), 6) AS Fouls_Per_Min FROM j""",
)
def shares(t: Tables) -> DataFrame:
    return _with_totals(t).select(
        *KEYS,
        r6(ratio_or_zero("rebounds", "Tm_rebounds")).alias("Reb_Share"),
        r6(ratio_or_zero("points", "Tm_points")).alias("Scoring_Share"),
        r6(ratio_or_zero("fouls", "minutes")).alias("Fouls_Per_Min"),
    )


@query(
    "allowed_ratios",
    f"""WITH {_BOX}, tot AS (SELECT match_id, team, CAST(sum(points) AS DOUBLE) AS tp, sum(turnovers) AS tm, sum(rebounds) AS ta
          FROM box GROUP BY 1, 2)
        SELECT match_id, team, player, round(coalesce((points - rebounds) / nullif(minutes, 0), 0), 6) AS Blowout_Factor,
          tp AS opp_points_allowed, round(coalesce(tm / nullif(ta, 0), 0), 6) AS opp_fg_allowed
        FROM box JOIN tot USING (match_id, team)""",
)
def allowed_ratios(t: Tables) -> DataFrame:
    """Points and shooting share that a side gives away, and the margin per minute."""
    counts = {
        "MIN_FL": "minutes", "FGA": "rebounds", "FTA": "assists", "OREB": "blocks", "FGM": "turnovers", "FG3M": "fouls",
    }
    shot = box(t).withColumns({k: F.col(v) for k, v in counts.items()} | {"plus_minus": F.col("points") - F.col("rebounds")})
    return box_ratios(shot).select(
        *KEYS, r6("Blowout_Factor").alias("Blowout_Factor"), "opp_points_allowed", r6("opp_fg_allowed").alias("opp_fg_allowed")
    )


# --- opponents and profiles ---------------------------------------------------------------

_GAMES = f"WITH {_BOX}, {OPPONENT_SQL}"
_PROFILE = """profile AS (SELECT player, avg(rebounds) AS rebounds, avg(blocks) AS blocks, avg(assists) AS assists,
  avg(points) AS points FROM box GROUP BY 1)"""
_CLASSES = """classes AS (SELECT player, rebounds * 2 + blocks * 5 AS size,
  CASE WHEN rebounds * 1.5 > 6 AND blocks / 8 > 0.5 THEN 'C' WHEN assists * 0.7 > 3.5 THEN 'PG' WHEN rebounds * 1.2 > 4.5 THEN 'PF'
       WHEN points / 2 > 12 AND assists * 0.5 < 2.5 THEN 'SG' ELSE 'SF' END AS cls FROM profile)"""
_CLASSED = f"{_GAMES}, {_PROFILE}, {_CLASSES}, cg AS (SELECT games.*, cls, size FROM games JOIN classes USING (player))"


def _games(games: DataFrame) -> DataFrame:
    return matchups.opponent_map(games, "match_id", "team")


def _profile(games: DataFrame) -> DataFrame:
    return matchups.entity_profile(games, "player", ["rebounds", "blocks", "assists", "points"])


def _classes(games: DataFrame) -> DataFrame:
    """The position rules over statistics rescaled so that all classes occur."""
    reb, blk, ast, pts = (F.col(c) for c in ("rebounds", "blocks", "assists", "points"))
    center, guard, *_ = position_rules(reb * 1.5, blk / 8, ast * 0.7, pts / 2)
    *_, forward, shooter = position_rules(reb * 1.2, blk / 8, ast * 0.5, pts / 2)
    profile = _profile(games)
    cls = classify([center, guard, forward, shooter])
    return profile.select("player", cls.alias("cls"), weighted_sum(SIZE_WEIGHTS).alias("size"))


def _classed(t: Tables) -> DataFrame:
    """The box score with opponent, class and size, stored for the aggregates over it."""
    games = box(t)
    return store(_games(games).join(_classes(games), "player"))


@query("opponent_map", f"{_GAMES} SELECT match_id, team, player, opponent FROM games")
def opponent_map(t: Tables) -> DataFrame:
    return _games(box(t)).select(*KEYS, "opponent")


_CROWD = """lines AS (SELECT l_orderkey AS match_id, l_linenumber AS team, l_partkey AS player FROM lineitem),
  sides AS (SELECT DISTINCT match_id, team FROM lines)"""


@query(
    "opponent_map_many",
    f"""WITH {_CROWD} SELECT lines.match_id, lines.team, player, o.team AS opponent FROM lines
        LEFT JOIN sides o ON lines.match_id = o.match_id AND lines.team <> o.team""",
)
def opponent_map_many(t: Tables) -> DataFrame:
    """Groups with any number of sides, here the line numbers of an order."""
    lines = t.lineitem.selectExpr("l_orderkey AS match_id", "l_linenumber AS team", "l_partkey AS player")
    return matchups.opponent_map(lines, "match_id", "team").select("match_id", "team", "player", "opponent")


@query(
    "entity_profile",
    f"""WITH {_BOX}, {_PROFILE} SELECT player, round(rebounds, 6) AS rebounds, round(blocks, 6) AS blocks,
        round(assists, 6) AS assists, round(points, 6) AS points FROM profile""",
)
def entity_profile(t: Tables) -> DataFrame:
    return _profile(box(t)).select("player", *[r6(c).alias(c) for c in ("rebounds", "blocks", "assists", "points")])


@query("classify", f"WITH {_BOX}, {_PROFILE}, {_CLASSES} SELECT player, cls FROM classes")
def classes(t: Tables) -> DataFrame:
    return _classes(box(t)).select("player", "cls")


@query("size_index", f"WITH {_BOX}, {_PROFILE}, {_CLASSES} SELECT player, round(size, 6) AS size FROM classes")
def size_index(t: Tables) -> DataFrame:
    return _classes(box(t)).select("player", r6("size").alias("size"))


@query(
    "opponent_totals",
    f"""{_GAMES}, tot AS (SELECT match_id, team, CAST(sum(points) AS BIGINT) AS Opp_Pts, CAST(sum(fouls) AS BIGINT) AS Opp_Fouls,
          avg(rebounds) AS Opp_Pace, max(assists) AS Opp_Max FROM box GROUP BY 1, 2)
        SELECT games.match_id, games.team, player, opponent, Opp_Pts, Opp_Fouls, round(Opp_Pace, 6) AS Opp_Pace, Opp_Max
        FROM games LEFT JOIN tot ON games.match_id = tot.match_id AND games.opponent = tot.team""",
)
def opponent_totals(t: Tables) -> DataFrame:
    aggs = {
        "points": ("sum", "Opp_Pts"),
        "fouls": ("sum", "Opp_Fouls"),
        "rebounds": ("avg", "Opp_Pace"),
        "assists": ("max", "Opp_Max"),
    }
    done = matchups.opponent_totals(_games(box(t)), "match_id", "team", "opponent", aggs)
    return done.select(*KEYS, "opponent", "Opp_Pts", "Opp_Fouls", r6("Opp_Pace").alias("Opp_Pace"), "Opp_Max")


def _allowed_sql(value: str, out: str) -> str:
    return f"""{_CLASSED}, al AS (SELECT opponent, cls, avg({value}) AS v FROM cg GROUP BY 1, 2)
      SELECT cg.match_id, cg.team, cg.player, cg.cls, round(al.v, 6) AS {out} FROM cg
      LEFT JOIN al ON cg.opponent = al.opponent AND cg.cls = al.cls"""


@query("allowed_by_class", _allowed_sql("points", "allowed"))
def allowed_by_class(t: Tables) -> DataFrame:
    done = matchups.mean_by_class(_classed(t), "opponent", "cls", {"allowed": "points"})
    return done.select(*KEYS, "cls", r6("allowed").alias("allowed"))


@query("allowed_minutes", _allowed_sql("minutes", "allowed"))
def allowed_minutes(t: Tables) -> DataFrame:
    done = matchups.mean_by_class(_classed(t), "opponent", "cls", {"allowed": "minutes"})
    return done.select(*KEYS, "cls", r6("allowed").alias("allowed"))


@query(
    "mismatch",
    f"""{_CLASSED}, al AS (SELECT opponent, cls, avg(size) AS v FROM cg GROUP BY 1, 2)
      SELECT cg.match_id, cg.team, cg.player, round(size - al.v, 6) + 0.0 AS Mismatch_Adv FROM cg
      LEFT JOIN al ON cg.opponent = al.opponent AND cg.cls = al.cls""",
)
def mismatch(t: Tables) -> DataFrame:
    done = matchups.mean_by_class(_classed(t), "opponent", "cls", {"faced_size_mean": "size"})
    return done.select(*KEYS, (r6(F.col("size") - F.col("faced_size_mean")) + 0.0).alias("Mismatch_Adv"))


@query(
    "suppressor",
    f"""{_CLASSED}, al AS (SELECT opponent, cls, avg(points) AS v FROM cg GROUP BY 1, 2)
      SELECT cg.match_id, cg.team, cg.player, round(al.v - profile.points, 6) + 0.0 AS Def_Suppressor FROM cg
      LEFT JOIN al ON cg.opponent = al.opponent AND cg.cls = al.cls JOIN profile ON cg.player = profile.player""",
)
def suppressor(t: Tables) -> DataFrame:
    games = _classed(t)
    allowed = matchups.mean_by_class(games, "opponent", "cls", {"allowed": "points"})
    done = matchups.suppressor(allowed, "player", "points", "allowed", base=games)
    return done.select(*KEYS, (r6("Def_Suppressor") + 0.0).alias("Def_Suppressor"))


@query(
    "rates",
    f"""WITH {_BOX} SELECT match_id, team, player,
          round((points + rebounds + turnovers) / CASE WHEN minutes = 0 THEN 1 ELSE minutes END, 6) AS Pace_Est,
          round(points / CASE WHEN minutes = 0 THEN 1 ELSE minutes END, 6) AS Raw_PPM FROM box""",
)
def rates(t: Tables) -> DataFrame:
    actions = F.col("points") + F.col("rebounds") + F.col("turnovers")
    return box(t).select(
        *KEYS,
        r6(ratio_zero_one(actions, "minutes")).alias("Pace_Est"),
        r6(ratio_zero_one("points", "minutes")).alias("Raw_PPM"),
    )


@query(
    "gravity",
    f"""WITH {_BOX} SELECT match_id, team, player,
        round(points * 0.4::DOUBLE + (points - 2 * turnovers) * 0.6::DOUBLE, 6) AS Gravity FROM box""",
)
def gravity(t: Tables) -> DataFrame:
    rated = box(t).withColumn("efficiency", F.col("points") - 2 * F.col("turnovers"))
    return rated.select(*KEYS, r6(weighted_sum(GRAVITY_WEIGHTS)).alias("Gravity"))


@query(
    "season_weight",
    """SELECT o_orderkey, CAST(CASE WHEN o_orderdate >= TIMESTAMP '1999-08-06' THEN 1.0
         WHEN o_orderdate >= TIMESTAMP '1998-08-06' THEN 0.7 ELSE 0.4 END AS DOUBLE) AS Season_Weight FROM orders""",
)
def season_weights(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", season_weight("o_orderdate", "1999-10-01").alias("Season_Weight"))


@query("is_home", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS Is_Home FROM lineitem")
def is_home(t: Tables) -> DataFrame:
    home = equals_flag("l_linestatus", F.lit("F"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", home.alias("Is_Home"))


@query(
    "vs_opponent_hist",
    f"""WITH {box_sql("l_suppkey")}, {OPPONENT_SQL}, {DATED_SQL}
      SELECT match_id, team, player, opponent, CASE WHEN opponent IS NOT NULL THEN round(avg(points) OVER (PARTITION BY player,
        opponent ORDER BY date, match_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6) END AS vs_mean FROM dated""",
)
def vs_opponent_hist(t: Tables) -> DataFrame:
    games = matchups.opponent_map(dated_box(t, "l_suppkey"), "match_id", "team")
    keys, order = ("player", "opponent"), ("date", "match_id")
    cuts = find_cuts(games, keys, order, coarse=(t.lineitem, ("l_suppkey",)))
    done = prior_mean(games, keys, order, "points", "vs_mean", cuts)
    return done.select(*KEYS, "opponent", F.when(F.col("opponent").isNotNull(), r6("vs_mean")).alias("vs_mean"))


@query(
    "allowed_asof",
    f"""{_CLASSED}, d AS (SELECT cg.*, CAST(o_orderdate AS DATE) AS date FROM cg JOIN orders ON match_id = o_orderkey)
      SELECT match_id, team, player, strftime(date, '%Y-%m-%d') AS date, CASE WHEN opponent IS NOT NULL THEN round(avg(points)
        OVER (PARTITION BY opponent, cls ORDER BY date RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING), 6) END
        AS allowed FROM d""",
)
def allowed_asof(t: Tables) -> DataFrame:
    dates = t.orders.select(F.col("o_orderkey").alias("match_id"), F.col("o_orderdate").cast("date").alias("date"))
    games = _classed(t).join(dates, "match_id")
    done = matchups.asof_aggregate(games, ["opponent", "cls"], "date", {"allowed": "points"})
    return done.select(*KEYS, day_text("date").alias("date"), r6("allowed").alias("allowed"))
