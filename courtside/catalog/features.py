"""The whole feature build over events: a day is a match, a user a player, parity the team."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from courtside.catalog.base import Tables, query
from courtside.catalog.playbyplay import LOG_SQL, SQUAD_SQL, _events, _log
from courtside.operators.event_log import order_events
from courtside.plans.feature_build import build_features

_MATCH = "CAST(replace(day, '-', '') AS BIGINT)"
_BOX = """SELECT day, user_id, CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS team,
  CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS starter, CAST(sum(pts) * 5 AS BIGINT) AS points,
  count(CASE WHEN event_type = 'click' THEN 1 END) * 6 AS rebounds, count(CASE WHEN event_type = 'view' THEN 1 END) AS blocks,
  count(CASE WHEN event_type = 'error' THEN 1 END) * 4 AS assists, count(CASE WHEN event_type = 'signup' THEN 1 END) AS turnovers,
  count(CASE WHEN event_type = 'view' THEN 1 END) * 2 AS fouls, count(*) % 7 AS mins
  FROM {events} GROUP BY day, user_id"""

_SQL = f"""WITH {LOG_SQL}, {SQUAD_SQL}, box AS ({_BOX.format(events="ev")}),
  grid AS (SELECT s.day, s.user_id, s.starter, e.ts, e.event_id, e.pts,
    CASE WHEN e.user_id = s.user_id AND e.event_type = 'signup' THEN 1
         WHEN e.user_id = s.user_id AND e.event_type = 'error' THEN 0 END AS change
    FROM squad s JOIN ev e ON s.day = e.day),
  states AS (SELECT *, coalesce(last_value(change IGNORE NULLS) OVER (PARTITION BY day, user_id ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), starter) AS present FROM grid),
  syn AS (SELECT day, user_id, coalesce(avg(CASE WHEN present = 1 AND pts <> 0 THEN pts END), 0) AS syn
    FROM states GROUP BY 1, 2),
  nxt AS (SELECT day, event_type, lead(user_id) OVER (PARTITION BY day ORDER BY ts, event_id) AS actor FROM ev),
  assisted AS (SELECT day, actor AS user_id, count(*) AS n FROM nxt WHERE event_type = 'click' AND actor IS NOT NULL GROUP BY 1, 2),
  counted AS (SELECT day, user_id, count(CASE WHEN event_type = 'view' THEN 1 END) AS drawn,
    count(CASE WHEN event_type = 'purchase' AND pts > 0 AND period = 1 THEN 1 END) AS q1,
    count(CASE WHEN event_type = 'purchase' AND pts > 0 AND period = 4 THEN 1 END) AS q4,
    count(CASE WHEN event_type = 'purchase' AND pts > 0 AND period > 4 THEN 1 END) AS ot,
    count(CASE WHEN period = 4 AND abs(score_home - score_away) <= 5 AND sec <= 300 THEN 1 END) AS clutch,
    count(CASE WHEN period = 4 AND abs(score_home - score_away) >= 20 THEN 1 END) AS gt FROM log GROUP BY 1, 2),
  shots AS (SELECT day, user_id, floor(value) % 100 AS x, event_id % 100 AS y FROM (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events)
    WHERE event_type = 'purchase'),
  dists AS (SELECT *, least(sqrt((x - 5) * (x - 5) + (y - 50) * (y - 50)), sqrt((x - 95) * (x - 95) + (y - 50) * (y - 50))) AS d FROM shots),
  quality AS (SELECT day, user_id, avg(CASE WHEN d < 8 OR (d > 22 AND abs(y - 50) > 35) THEN 1 ELSE 0 END) AS q FROM dists GROUP BY 1, 2),
  profile AS (SELECT user_id, avg(rebounds) AS reb, avg(blocks) AS blk, avg(assists) AS ast, avg(points) AS pts FROM box GROUP BY 1),
  pos AS (SELECT user_id, pts AS own, reb * 2 + blk * 5 AS size, CASE WHEN reb > 6 AND blk > 0.5 THEN 'C' WHEN ast > 3.5 THEN 'PG'
    WHEN reb > 4.5 THEN 'PF' WHEN pts > 12 AND ast < 2.5 THEN 'SG' ELSE 'SF' END AS pos FROM profile),
  styled AS (SELECT box.*, syn, coalesce(n, 0) / CASE WHEN points = 0 THEN 1 ELSE points END AS dep, q1, q4, ot, clutch, gt, drawn,
    sum(points) OVER (PARTITION BY day, team) AS tm, coalesce(CAST(day AS DATE) - lag(CAST(day AS DATE)) OVER (PARTITION BY user_id
      ORDER BY day), 7) AS rest,
    (points + rebounds + turnovers) / CASE WHEN mins = 0 THEN 1 ELSE mins END AS pace, coalesce(q, 0) AS q, own, size, pos
    FROM box JOIN syn USING (day, user_id) JOIN counted USING (day, user_id) JOIN pos USING (user_id)
    LEFT JOIN assisted USING (day, user_id) LEFT JOIN quality USING (day, user_id)),
  teams AS (SELECT day, team, sum(points) AS tp, sum(fouls) AS tf, avg(pace) AS tpace, max(drawn) AS td, max(syn) AS ts
    FROM styled GROUP BY 1, 2),
  games AS (SELECT styled.*, teams.team AS opponent, tp, tf, tpace, td, ts FROM styled LEFT JOIN teams
    ON styled.day = teams.day AND styled.team <> teams.team),
  allowed AS (SELECT opponent, pos, avg(points) AS ap, avg(size) AS asz FROM games GROUP BY 1, 2)
  SELECT {_MATCH} AS match_id, concat('u', user_id) AS player, games.opponent, games.pos AS Pos_Est,
    round(syn, 6) AS Synergy_Score, round(dep, 6) AS Dependency_Index,
    round(points * 0.4::DOUBLE + (points - turnovers) * 0.6::DOUBLE, 6) AS Gravity, round(pace, 6) AS Pace_Est,
    drawn AS Fouls_Drawn, round(q, 6) AS Shot_Quality_Avg, round(size, 6) AS Size_Index,
    CAST(coalesce(tp, 0) AS BIGINT) AS Opp_Avg_Pts_Allowed, CAST(coalesce(tf, 0) AS BIGINT) AS Opp_Avg_Fouls,
    round(coalesce(tpace, 0), 6) AS Opp_Avg_Pace, CAST(coalesce(td, 0) AS BIGINT) AS Opp_Max_Foul_Drawer,
    round(coalesce(ts, 0), 6) AS Opp_Best_Def_Synergy, round(coalesce(ap, 0), 6) AS Opp_Allowed_Pos_Avg,
    round(coalesce(size - asz, 0), 6) + 0.0 AS Mismatch_Adv, round(coalesce(ap - own, 0), 6) + 0.0 AS Def_Suppressor,
    CAST(tm AS BIGINT) AS Tm_PTS, CAST(rest AS INTEGER) AS Days_Rest, ot AS OT_Activity,
    q1 AS Q1_Activity, q4 AS Q4_Activity, clutch AS Clutch_Events, gt AS GT_Activity_Index,
    CAST(CASE WHEN day >= '2024-01-11' THEN 1.0 ELSE 0.7 END AS DOUBLE) AS Weight
  FROM games LEFT JOIN allowed ON games.opponent = allowed.opponent AND games.pos = allowed.pos"""


def _tables(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    match, player = F.expr(_MATCH).alias("match_id"), F.concat(F.lit("u"), "user_id").alias("player")
    counted = t.spark.sql(_BOX.format(events="{events}"), events=_events(t))
    box = counted.select(
        match, player, "team", "starter", "points", "rebounds", "blocks", "assists", "turnovers", "fouls",
        F.col("mins").cast("double").alias("MIN_FL"), (F.col("points") - F.col("turnovers")).alias("efficiency"),
        F.to_date("day").alias("date"),
    )
    kinds = {"signup": "substitution", "error": "substitution", "purchase": "2pt", "click": "assist", "view": "foulon"}
    kind = F.create_map(*[F.lit(v) for pair in kinds.items() for v in pair])[F.col("event_type")]
    pbp = _log(t).select(
        match, player, "period", F.concat(F.floor(F.col("sec") / 60), F.lit(":"), F.col("sec") % 60).alias("clock"),
        F.col("event_id").alias("seq"), kind.alias("action_type"), "score_home", "score_away",
        F.when(F.col("event_type") == "signup", "in").when(F.col("event_type") == "error", "out").alias("sub_type"),
        F.when(F.col("pts") > 0, 1).otherwise(0).alias("success"),
    )
    tries = t.events.where("event_type = 'purchase'").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    shots = tries.select(match, player, (F.floor("value") % 100).alias("x"), (F.col("event_id") % 100).alias("y"))
    return box, order_events(pbp), shots


@query("feature_build", _SQL)
def feature_build(t: Tables) -> DataFrame:
    """All features of a box score, a play-by-play and shots in one table."""
    features = build_features(*_tables(t), current_season=2024).withColumn(
        "Weight", F.when(F.col("date") >= F.lit("2024-01-11").cast("date"), 1.0).otherwise(F.col("Season_Weight"))
    )
    rounded = [
        "Synergy_Score", "Dependency_Index", "Gravity", "Pace_Est", "Shot_Quality_Avg", "Size_Index", "Opp_Avg_Pace",
        "Opp_Best_Def_Synergy", "Opp_Allowed_Pos_Avg", "Mismatch_Adv", "Def_Suppressor",
    ]
    whole = [
        "Fouls_Drawn", "Opp_Avg_Pts_Allowed", "Opp_Avg_Fouls", "Opp_Max_Foul_Drawer", "Q1_Activity", "Q4_Activity",
        "Clutch_Events", "GT_Activity_Index", "OT_Activity", "Tm_PTS", "Days_Rest",
    ]
    return features.select(
        "match_id", "player", "opponent", "Pos_Est", "Weight", *whole, *[(F.round(c, 6) + 0.0).alias(c) for c in rounded]
    )
