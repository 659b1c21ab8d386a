"""Registry of queries and the roles the test tables play.

Floating results are rounded to six places on both sides; everything summed is a whole number
first (cents, counts), so that both engines agree whatever order they add in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from courtside.session import store, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The parquet tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tune(spark), folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable:
    """Register a query; without ``sql`` it is checked for rows only."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def r6(value: Column | str) -> Column:
    return F.round(value if isinstance(value, Column) else F.col(value), 6)


def day_text(value: Column | str) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


# --- orders as the history of a player (customer) -----------------------------------------

HISTORY_SQL = """hist AS (
  SELECT o_orderkey AS match_id, o_custkey AS player, o_orderdate AS date,
         CAST(round(o_totalprice * 100) AS BIGINT) AS points, o_orderkey % 41 AS minutes,
         (o_orderkey * 7 + o_custkey) % 61 - 30 AS plus_minus
  FROM orders)"""
BY_PLAYER = "PARTITION BY player ORDER BY date, match_id"
PLAYER_ORDER = ("date", "match_id")


def history(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("match_id"),
        F.col("o_custkey").alias("player"),
        F.col("o_orderdate").alias("date"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("points"),
        (F.col("o_orderkey") % 41).alias("minutes"),
        ((F.col("o_orderkey") * 7 + F.col("o_custkey")) % 61 - 30).alias("plus_minus"),
    )


# --- lineitem as a box score: order = match, status and order number = team ----------------


def box_sql(player: str) -> str:
    return f"""box AS (
  SELECT l_orderkey AS match_id, concat(l_linestatus, '-', l_orderkey % 30) AS team, {player} AS player,
         CAST(sum(l_quantity) AS BIGINT) AS points, CAST(sum(l_linenumber) AS BIGINT) AS rebounds,
         CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS assists,
         CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS blocks,
         count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS turnovers,
         count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS fouls,
         CAST(sum(l_quantity) AS BIGINT) * 3 % 41 AS minutes
  FROM lineitem GROUP BY 1, 2, 3)"""


#: Pairs of teams of a match, and the box score with the opponent attached.
OPPONENT_SQL = """sides AS (SELECT DISTINCT match_id, team FROM box),
pairs AS (SELECT a.match_id, a.team, b.team AS opponent FROM sides a JOIN sides b
          ON a.match_id = b.match_id AND a.team <> b.team),
games AS (SELECT box.*, opponent FROM box LEFT JOIN pairs USING (match_id, team))"""


def box(t: Tables, player: str = "l_partkey") -> DataFrame:
    cents = lambda c: F.round(F.col(c) * 100).cast("bigint")
    lines = t.lineitem.withColumns(
        {
            "match_id": F.col("l_orderkey"),
            "team": F.concat("l_linestatus", F.lit("-"), F.col("l_orderkey") % 30),
            "player": F.col(player),
        }
    )
    quantity = F.sum("l_quantity").cast("bigint")
    # By match, so that grouping and whatever is joined or grouped by match afterwards share one shuffle.
    lines = lines.repartition("match_id")
    return lines.groupBy("match_id", "team", "player").agg(
        quantity.alias("points"),
        F.sum("l_linenumber").alias("rebounds"),
        F.sum(cents("l_discount")).alias("assists"),
        F.sum(cents("l_tax")).alias("blocks"),
        F.count_if(F.col("l_returnflag") == "R").alias("turnovers"),
        F.count_if(F.col("l_returnflag") == "A").alias("fouls"),
        (quantity * 3 % 41).alias("minutes"),
    )


def stored_box(t: Tables, player: str = "l_partkey") -> DataFrame:
    """The box score stored once, as ingest would have it, for queries that read it repeatedly."""
    return store(box(t, player))


def dated_box(t: Tables, player: str = "l_partkey") -> DataFrame:
    dates = t.orders.select(F.col("o_orderkey").alias("match_id"), F.col("o_orderdate").alias("date"))
    return store(box(t, player).join(dates, "match_id"))


DATED_SQL = "dated AS (SELECT games.*, o_orderdate AS date FROM games JOIN orders ON match_id = o_orderkey)"
