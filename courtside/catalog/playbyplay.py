"""Events as a play-by-play log: a day is a match, a user a player.

Sign-ups come in, errors go out, purchases score for the side of the user's parity, clicks are
assists and views are fouls drawn; a quarter of the day is a period.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from courtside.catalog.base import Tables, query, r6
from courtside.operators import event_log
from courtside.operators.ordered import Cuts, ordered

ORDER = ("ts", "event_id")

LOG_SQL = """ev AS (
  SELECT strftime(ts, '%Y-%m-%d') AS day, user_id, event_id, event_type, ts,
         CAST(hour(ts) // 6 + 1 AS INTEGER) AS period,
         (21599 - (hour(ts) % 6 * 3600 + minute(ts) * 60 + second(ts))) // 30 AS sec,
         CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) % 4 ELSE 0 END AS pts
  FROM events),
log AS (
  SELECT *, CAST(sum(CASE WHEN user_id % 2 = 0 THEN pts ELSE 0 END) OVER w AS BIGINT) AS score_home,
            CAST(sum(CASE WHEN user_id % 2 = 1 THEN pts ELSE 0 END) OVER w AS BIGINT) AS score_away
  FROM ev WINDOW w AS (PARTITION BY day ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))"""
SQUAD_SQL = "squad AS (SELECT DISTINCT day, user_id, CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS starter FROM ev)"


def _events(t: Tables) -> DataFrame:
    secs = F.hour("ts") % 6 * 3600 + F.minute("ts") * 60 + F.floor(F.second("ts"))
    return t.events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        "user_id",
        "event_id",
        "event_type",
        "ts",
        F.floor(F.hour("ts") / 6 + 1).cast("int").alias("period"),
        F.floor((21599 - secs) / 30).alias("sec"),
        F.when(F.col("event_type") == "purchase", F.floor("value") % 4).otherwise(0).alias("pts"),
    )


def _log(t: Tables, cuts: Cuts | None = None) -> DataFrame:
    events = _events(t)
    side = lambda parity: F.when(F.col("user_id") % 2 == parity, F.col("pts")).otherwise(0)
    work = ordered(events, "day", ORDER, cuts)
    return work.running({"score_home": side(0), "score_away": side(1)}).done()


def _squad(t: Tables) -> DataFrame:
    starter = F.when(F.col("user_id") % 3 == 0, 1).otherwise(0)
    return _events(t).select("day", "user_id", starter.alias("starter")).distinct()


def _subs(log: DataFrame) -> DataFrame:
    """Score after each event, missing on every 17th, and who comes or goes with it."""
    total = F.when(F.col("event_id") % 17 != 0, F.col("score_home") + F.col("score_away"))
    change = F.when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "error", 0)
    return log.withColumns({"score": total, "change": change})


PRESENCE_SQL = f"""WITH {LOG_SQL}, {SQUAD_SQL},
  scored AS (SELECT *, coalesce(last_value(CASE WHEN event_id % 17 <> 0 THEN score_home + score_away END IGNORE NULLS)
    OVER (PARTITION BY day ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS total FROM log),
  moved AS (SELECT *, total - lag(total, 1, 0) OVER (PARTITION BY day ORDER BY ts, event_id) AS diff FROM scored),
  grid AS (SELECT s.day, s.user_id, s.starter, m.ts, m.event_id, m.diff,
    CASE WHEN m.user_id = s.user_id AND m.event_type = 'signup' THEN 1
         WHEN m.user_id = s.user_id AND m.event_type = 'error' THEN 0 END AS change
    FROM squad s JOIN moved m ON s.day = m.day),
  states AS (SELECT *, coalesce(last_value(change IGNORE NULLS) OVER (PARTITION BY day, user_id ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), starter) AS present FROM grid)
  SELECT day, user_id, round(coalesce(avg(CASE WHEN present = 1 AND diff <> 0 THEN diff END), 0), 6) AS Synergy_Score
  FROM states GROUP BY day, user_id"""


@query("presence_mean", PRESENCE_SQL)
def presence_mean(t: Tables) -> DataFrame:
    done = event_log.presence_mean(_subs(_log(t)), _squad(t), "day", "user_id", ORDER, "score", "change")
    return done.withColumn("Synergy_Score", r6("Synergy_Score"))


@query("presence_mean_split", PRESENCE_SQL)
def presence_mean_split(t: Tables) -> DataFrame:
    """The same result with the log cut into 32 parts, across the days."""
    cuts = Cuts(("day",), ORDER, parts=32)
    log = _subs(_log(t, cuts))
    done = event_log.presence_mean(log, _squad(t), "day", "user_id", ORDER, "score", "change", cuts=cuts)
    return done.withColumn("Synergy_Score", r6("Synergy_Score"))


@query("presence_by_interval", PRESENCE_SQL)
def presence_by_interval(t: Tables) -> DataFrame:
    """The same by a join of presence intervals with the events that score."""
    done = event_log.presence_by_interval(_subs(_log(t)), _squad(t), "day", "user_id", ORDER, "score", "change")
    return done.select("day", "user_id", r6("Synergy_Score").alias("Synergy_Score"))


@query(
    "stint_intervals",
    f"""WITH {LOG_SQL}, {SQUAD_SQL},
      turns AS (SELECT l.day, l.user_id, l.event_id, CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS change, s.starter
        FROM log l JOIN squad s ON l.day = s.day AND l.user_id = s.user_id WHERE event_type IN ('signup', 'error')),
      flips AS (SELECT * FROM (SELECT *, lag(change, 1, starter) OVER (PARTITION BY day, user_id ORDER BY event_id) AS was
        FROM turns) WHERE change <> was),
      starts AS (SELECT day, user_id, CAST(NULL AS BIGINT) AS came FROM squad WHERE starter = 1
        UNION ALL SELECT day, user_id, event_id FROM flips WHERE change = 1)
      SELECT s.day, s.user_id, s.came, (SELECT min(f.event_id) FROM flips f WHERE f.day = s.day AND f.user_id = s.user_id
        AND f.change = 0 AND f.event_id > coalesce(s.came, -1)) AS "left" FROM starts s""",
)
def stint_intervals(t: Tables) -> DataFrame:
    return event_log.stints(_subs(_log(t)), _squad(t), "day", "user_id", "event_id", "change")


@query(
    "stint_intervals_ordered",
    f"""WITH {LOG_SQL}, {SQUAD_SQL},
      turns AS (SELECT l.day, l.user_id, l.ts, l.event_id, CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS change, s.starter
        FROM log l JOIN squad s ON l.day = s.day AND l.user_id = s.user_id WHERE event_type IN ('signup', 'error')),
      flips AS (SELECT * FROM (SELECT *, lag(change, 1, starter) OVER (PARTITION BY day, user_id ORDER BY ts, event_id) AS was
        FROM turns) WHERE change <> was),
      chain AS (SELECT *, lead(event_id) OVER (PARTITION BY day, user_id ORDER BY ts, event_id) AS nxt,
        row_number() OVER (PARTITION BY day, user_id ORDER BY ts, event_id) AS rn FROM flips)
      SELECT day, user_id, event_id AS came, nxt AS "left" FROM chain WHERE change = 1
      UNION ALL SELECT s.day, s.user_id, NULL, c.event_id FROM squad s LEFT JOIN chain c ON s.day = c.day AND s.user_id = c.user_id
        AND c.rn = 1 WHERE s.starter = 1""",
)
def stint_intervals_ordered(t: Tables) -> DataFrame:
    """Stints in the order of time and event, shown by their events."""
    found = event_log.stints(_subs(_log(t)), _squad(t), "day", "user_id", ORDER, "change")
    return found.select("day", "user_id", F.col("came.event_id").alias("came"), F.col("left.event_id").alias("left"))


NEXT_SQL = """nxt AS (SELECT day, event_type, lead(user_id) OVER (PARTITION BY day ORDER BY ts, event_id) AS actor FROM ev),
  assisted AS (SELECT day, actor AS user_id, count(*) AS Assisted_Baskets FROM nxt
    WHERE event_type = 'click' AND actor IS NOT NULL GROUP BY 1, 2)"""


def _assisted(t: Tables) -> DataFrame:
    return event_log.next_actor_count(_events(t), "day", "user_id", ORDER, F.col("event_type") == "click")


@query("next_actor", f"WITH {LOG_SQL}, {NEXT_SQL} SELECT * FROM assisted")
def next_actor(t: Tables) -> DataFrame:
    return _assisted(t)


@query(
    "dependency",
    f"""WITH {LOG_SQL}, {NEXT_SQL}, pts AS (SELECT day, user_id, CAST(sum(pts) AS BIGINT) AS points FROM ev GROUP BY 1, 2)
      SELECT pts.day, pts.user_id, points, round(coalesce(Assisted_Baskets, 0) / CASE WHEN points = 0 THEN 1 ELSE points END, 6)
        AS Dependency_Index FROM pts LEFT JOIN assisted ON pts.day = assisted.day AND pts.user_id = assisted.user_id""",
)
def dependency(t: Tables) -> DataFrame:
    points = _events(t).groupBy("day", "user_id").agg(F.sum("pts").alias("points"))
    done = event_log.dependency_index(points, _assisted(t), "day", "user_id", "points")
    return done.select("day", "user_id", "points", r6("Dependency_Index").alias("Dependency_Index"))


@query(
    "count_action",
    f"WITH {LOG_SQL} SELECT day, user_id, count(CASE WHEN event_type = 'view' THEN 1 END) AS Fouls_Drawn FROM ev GROUP BY 1, 2",
)
def count_action(t: Tables) -> DataFrame:
    drawn = F.col("event_type") == "view"
    return event_log.conditional_count(_events(t), ["day", "user_id"], {"Fouls_Drawn": drawn})


@query(
    "period_pivot",
    f"""WITH {LOG_SQL} SELECT day, user_id, count(CASE WHEN period = 1 THEN 1 END) AS Q1_Activity,
      count(CASE WHEN period = 2 THEN 1 END) AS Q2_Activity, count(CASE WHEN period = 3 THEN 1 END) AS Q3_Activity,
      count(CASE WHEN period = 4 THEN 1 END) AS Q4_Activity FROM ev
      WHERE regexp_matches(event_type, 'purch|view') AND pts < 3 GROUP BY 1, 2""",
)
def period_pivot(t: Tables) -> DataFrame:
    active = F.col("event_type").rlike("purch|view") & (F.col("pts") < 3)
    return event_log.activity_pivot(_events(t), ["day", "user_id"], "period", active)


@query(
    "clutch_count",
    f"""WITH {LOG_SQL} SELECT day, user_id, count(CASE WHEN period = 4 AND abs(score_home - score_away) <= 5
      AND sec <= 300 THEN 1 END) AS Clutch_Events FROM log GROUP BY 1, 2""",
)
def clutch_count(t: Tables) -> DataFrame:
    clutch = event_log.is_clutch("period", F.col("score_home") - F.col("score_away"), "sec")
    return event_log.conditional_count(_log(t), ["day", "user_id"], {"Clutch_Events": clutch})


@query(
    "clutch_shooting",
    f"""WITH {LOG_SQL}, c AS (SELECT *, period = 4 AND abs(score_home - score_away) <= 5 AND sec <= 300 AND event_type = 'purchase'
        AS tried FROM log), n AS (SELECT day, user_id, count(CASE WHEN tried THEN 1 END) AS fga,
        count(CASE WHEN tried AND pts >= 2 THEN 1 END) AS fgm FROM c GROUP BY 1, 2)
      SELECT day, user_id, fga AS Clutch_FGA, fgm AS Clutch_FGM, round(coalesce(fgm / nullif(fga, 0), 0), 6) AS Clutch_Share FROM n""",
)
def clutch_shooting(t: Tables) -> DataFrame:
    clutch = event_log.is_clutch("period", F.col("score_home") - F.col("score_away"), "sec")
    tried, made = F.col("event_type") == "purchase", F.col("pts") >= 2
    done = event_log.clutch_shooting(_log(t), ["day", "user_id"], clutch, tried, made)
    return done.select("day", "user_id", "Clutch_FGA", "Clutch_FGM", r6("Clutch_FG%").alias("Clutch_Share"))


@query(
    "garbage_count",
    f"""WITH {LOG_SQL} SELECT day, user_id, count(CASE WHEN period = 4 AND abs(score_home - score_away) >= 20
      THEN 1 END) AS GT_Activity_Index FROM log GROUP BY 1, 2""",
)
def garbage_count(t: Tables) -> DataFrame:
    garbage = event_log.is_garbage("period", F.col("score_home") - F.col("score_away"))
    return event_log.conditional_count(_log(t), ["day", "user_id"], {"GT_Activity_Index": garbage})
