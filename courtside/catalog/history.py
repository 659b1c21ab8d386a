"""Lag, rolling and expanding features over orders as a player's history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from courtside.catalog.base import BY_PLAYER, HISTORY_SQL, PLAYER_ORDER, Tables, day_text, history, query, r6
from courtside.functions import abs_over, code_map, month_of
from courtside.operators import rolling
from courtside.operators.ordered import Cuts

KEYS = ("player", "match_id")
FORCED = Cuts(("player",), PLAYER_ORDER, parts=32)


def _frame(n: int | str) -> str:
    return f"OVER ({BY_PLAYER} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


def _mean_sql(col: str, n: int | str) -> str:
    return f"avg({col}) {_frame(n)}"


@query("lag1", f"WITH {HISTORY_SQL} SELECT player, match_id, lag(points) OVER ({BY_PLAYER}) AS L1_points, lag(minutes) OVER ({BY_PLAYER}) AS L1_minutes FROM hist")
def lag1(t: Tables) -> DataFrame:
    done = rolling.lag_features(history(t), "player", PLAYER_ORDER, ["points", "minutes"])
    return done.select(*KEYS, "L1_points", "L1_minutes")


ROLLING_SQL = f"""WITH {HISTORY_SQL} SELECT player, match_id,
  round({_mean_sql('points', 3)}, 6) AS L3_points, round({_mean_sql('points', 5)}, 6) AS L5_points,
  round({_mean_sql('points', 10)}, 6) AS L10_points, round({_mean_sql('minutes', 3)}, 6) AS L3_minutes,
  round({_mean_sql('minutes', 5)}, 6) AS L5_minutes, round({_mean_sql('minutes', 10)}, 6) AS L10_minutes FROM hist"""


def _rolling(t: Tables, **options) -> DataFrame:
    done = rolling.rolling_mean(history(t), "player", PLAYER_ORDER, ["points", "minutes"], **options)
    return done.select(*KEYS, *[r6(f"L{n}_{c}").alias(f"L{n}_{c}") for c in ("points", "minutes") for n in (3, 5, 10)])


@query("rolling_mean", ROLLING_SQL)
def rolling_mean(t: Tables) -> DataFrame:
    return _rolling(t)


@query("rolling_mean_split", ROLLING_SQL)
def rolling_mean_split(t: Tables) -> DataFrame:
    """The same result with the table cut into 32 parts, across the players' histories."""
    return _rolling(t, cuts=FORCED)


@query(
    "rolling_full",
    f"""WITH {HISTORY_SQL} SELECT player, match_id,
        round(CASE WHEN count(points) {_frame(5)} >= 5 THEN {_mean_sql('points', 5)} END, 6) AS L5_points FROM hist""",
)
def rolling_full(t: Tables) -> DataFrame:
    done = rolling.rolling_mean(history(t), "player", PLAYER_ORDER, "points", (5,), min_periods=5)
    return done.select(*KEYS, r6("L5_points").alias("L5_points"))


EXPANDING_SQL = f"""WITH {HISTORY_SQL} SELECT player, match_id,
  CAST(sum(points) {_frame('UNBOUNDED')} AS BIGINT) AS Hist_sum_points,
  round({_mean_sql('points', 'UNBOUNDED')}, 6) AS Hist_avg_points FROM hist"""


def _expanding(t: Tables, **options) -> DataFrame:
    done = rolling.expanding(history(t), "player", PLAYER_ORDER, "points", **options)
    return done.select(*KEYS, "Hist_sum_points", r6("Hist_avg_points").alias("Hist_avg_points"))


@query("expanding", EXPANDING_SQL)
def expanding(t: Tables) -> DataFrame:
    return _expanding(t)


@query("expanding_split", EXPANDING_SQL)
def expanding_split(t: Tables) -> DataFrame:
    """The same result with the table cut into 32 parts, across the players' histories."""
    return _expanding(t, cuts=FORCED)


@query(
    "expanding_double",
    f"""WITH hist AS (SELECT o_orderkey AS match_id, o_custkey AS player, o_orderdate AS date,
          CAST((o_orderkey % 1001) * (o_orderkey % 3 - 1) AS DOUBLE) * CASE WHEN o_orderkey % 2 = 0 THEN 4096.0::DOUBLE
            ELSE 1.0::DOUBLE / 1048576 END AS x FROM orders)
        SELECT player, match_id, sum(x) {_frame('UNBOUNDED')} + 0.0 AS Hist_sum_x, avg(x) {_frame('UNBOUNDED')} + 0.0 AS Hist_avg_x FROM hist""",
)
def expanding_double(t: Tables) -> DataFrame:
    """Running sums of fractions with the table cut into 32 parts, not rounded anywhere."""
    scale = F.when(F.col("match_id") % 2 == 0, 4096.0).otherwise(1 / 1048576)
    x = ((F.col("match_id") % 1001) * (F.col("match_id") % 3 - 1)).cast("double") * scale
    done = rolling.expanding(history(t).withColumn("x", x), "player", PLAYER_ORDER, "x", cuts=FORCED)
    return done.select(*KEYS, *[(F.col(c) + 0.0).alias(c) for c in ("Hist_sum_x", "Hist_avg_x")])


@query(
    "trend",
    f"WITH {HISTORY_SQL} SELECT player, match_id, round({_mean_sql('minutes', 5)} - {_mean_sql('minutes', 10)}, 6) AS Trend_minutes FROM hist",
)
def trend(t: Tables) -> DataFrame:
    done = rolling.rolling_mean(history(t), "player", PLAYER_ORDER, "minutes", (5, 10))
    return done.select(*KEYS, r6(rolling.difference("L5_minutes", "L10_minutes")).alias("Trend_minutes"))


@query(
    "blend",
    f"""WITH {HISTORY_SQL}, m AS (SELECT player, match_id, {_mean_sql('minutes', 3)} AS l3,
          {_mean_sql('minutes', 5)} AS l5, {_mean_sql('minutes', 10)} AS l10 FROM hist)
        SELECT player, match_id, round(l5 * 0.7 + l10 * 0.3, 6) AS two_windows,
          round(l3 * 0.5 + l5 * 0.3 + l10 * 0.2, 6) AS three_windows FROM m""",
)
def blend(t: Tables) -> DataFrame:
    done = rolling.rolling_mean(history(t), "player", PLAYER_ORDER, "minutes")
    two = rolling.blend({"L5_minutes": 0.7, "L10_minutes": 0.3})
    three = rolling.blend({"L3_minutes": 0.5, "L5_minutes": 0.3, "L10_minutes": 0.2})
    return done.select(*KEYS, r6(two).alias("two_windows"), r6(three).alias("three_windows"))


@query(
    "rolling_rate",
    f"""WITH {HISTORY_SQL}, m AS (SELECT player, match_id, {_mean_sql('points', 5)} AS num,
          {_mean_sql('minutes', 5)} AS den FROM hist)
        SELECT player, match_id, round(num / CASE WHEN den = 0 THEN 1 ELSE den END, 6) AS rate FROM m""",
)
def rolling_rate(t: Tables) -> DataFrame:
    done = rolling.rolling_rate(history(t), "player", PLAYER_ORDER, "points", "minutes", out="rate")
    return done.select(*KEYS, r6("rate").alias("rate"))


@query(
    "shrunk_rate",
    f"""WITH {HISTORY_SQL}, prior AS (SELECT sum(points) / greatest(sum(minutes), 1) AS p FROM hist),
        s AS (SELECT player, match_id, coalesce(sum(points) {_frame('UNBOUNDED')}, 0) AS pts,
                coalesce(sum(minutes) {_frame('UNBOUNDED')}, 0) AS mins FROM hist)
        SELECT player, match_id, round(mins / (mins + 30.0) * (pts / greatest(mins, 1))
          + (1 - mins / (mins + 30.0)) * p, 6) AS rate FROM s, prior""",
)
def shrunk_rate(t: Tables) -> DataFrame:
    done = rolling.shrunk_rate(history(t), "player", PLAYER_ORDER, "points", "minutes", out="rate")
    return done.select(*KEYS, r6("rate").alias("rate"))


@query(
    "shrunk_rate_split",
    f"""WITH {HISTORY_SQL}, parts AS (SELECT *, points / 64.0::DOUBLE AS x, minutes / 4.0::DOUBLE AS y FROM hist),
        prior AS (SELECT sum(x) / greatest(sum(y), 1) AS p FROM parts),
        s AS (SELECT player, match_id, coalesce(sum(x) {_frame('UNBOUNDED')}, 0) AS pts,
                coalesce(sum(y) {_frame('UNBOUNDED')}, 0) AS mins FROM parts)
        SELECT player, match_id, round(mins / (mins + 30.0::DOUBLE) * (pts / greatest(mins, 1))
          + (1 - mins / (mins + 30.0::DOUBLE)) * p, 6) AS rate FROM s, prior""",
)
def shrunk_rate_split(t: Tables) -> DataFrame:
    """Rates of fractions with the table cut into 32 parts, across the players' histories."""
    parts = history(t).withColumns({"x": F.col("points") / 64, "y": F.col("minutes") / 4})
    done = rolling.shrunk_rate(parts, "player", PLAYER_ORDER, "x", "y", out="rate", cuts=FORCED)
    return done.select(*KEYS, r6("rate").alias("rate"))


@query(
    "blowout_flag",
    f"WITH {HISTORY_SQL} SELECT player, match_id, CASE WHEN abs(plus_minus) > 15 THEN 1 ELSE 0 END AS flag FROM hist",
)
def blowout_flag(t: Tables) -> DataFrame:
    return history(t).select(*KEYS, abs_over("plus_minus").alias("flag"))


_LABEL = "CASE o_orderkey % 8 WHEN 0 THEN 'PG' WHEN 1 THEN 'SG' WHEN 2 THEN 'SF' WHEN 3 THEN 'PF' WHEN 4 THEN 'C' WHEN 5 THEN 'F' WHEN 6 THEN 'XX' END"


@query(
    "code_map",
    f"""SELECT o_orderkey, CASE {_LABEL} WHEN 'PG' THEN 1 WHEN 'SG' THEN 2 WHEN 'SF' THEN 3 WHEN 'PF' THEN 4
        WHEN 'C' THEN 5 ELSE 3 END AS code FROM orders""",
)
def code_maps(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", code_map(F.expr(_LABEL)).alias("code"))


@query("month_of", "SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders")
def month(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", month_of("o_orderdate").alias("month"))


@query(
    "consistency",
    f"""WITH {HISTORY_SQL} SELECT player, match_id, round(stddev_pop(minutes) {_frame(10)}, 6) AS Consistency_Index FROM hist""",
)
def consistency(t: Tables) -> DataFrame:
    done = rolling.rolling_std(history(t), "player", PLAYER_ORDER, "minutes", 10)
    return done.select(*KEYS, r6("Consistency_Index").alias("Consistency_Index"))


@query(
    "recency_filter",
    f"""WITH {HISTORY_SQL} SELECT player, match_id, points FROM hist WHERE player IN (
        SELECT player FROM hist GROUP BY player
        HAVING CAST(max(date) AS DATE) >= (SELECT CAST(max(date) AS DATE) - 60 FROM hist))""",
)
def recency_filter(t: Tables) -> DataFrame:
    return rolling.recent_only(history(t), "player", "date").select(*KEYS, "points")


@query(
    "latest_snapshot",
    f"""WITH {HISTORY_SQL} SELECT player, match_id, strftime(date, '%Y-%m-%d') AS date, points FROM (
        SELECT *, row_number() OVER (PARTITION BY player ORDER BY date DESC, match_id DESC) AS rn FROM hist) WHERE rn = 1""",
)
def latest_snapshot(t: Tables) -> DataFrame:
    last = rolling.latest_snapshot(history(t), "player", PLAYER_ORDER)
    return last.select(*KEYS, day_text("date").alias("date"), "points")


@query(
    "days_rest",
    f"""WITH {HISTORY_SQL} SELECT player, match_id, CAST(coalesce(date_diff('day', lag(date) OVER ({BY_PLAYER}), date), 7)
        AS INTEGER) AS Days_Rest FROM hist""",
)
def days_rest(t: Tables) -> DataFrame:
    return rolling.days_since_prev(history(t), "player", PLAYER_ORDER, "date").select(*KEYS, "Days_Rest")
