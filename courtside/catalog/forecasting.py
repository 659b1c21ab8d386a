"""Temporal splits, weights, models, errors and probabilities over orders as match history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from courtside.catalog.base import BY_PLAYER, HISTORY_SQL, PLAYER_ORDER, Tables, box, box_sql, day_text, history, query, r6
from courtside.functions import combine, edge_rule, over_under, rate_target, sample_weight, season_weight
from courtside.functions.scoring import ERF_A, ERF_P
from courtside.operators import evaluation, matchups
from courtside.operators.rolling import history_features, recent_only
from courtside.plans.feature_build import ASOF_OUTPUTS, MatchupState
from courtside.plans.forecast import matchup, next_match
from courtside.plans.training import SMOOTHED_MINUTES, SMOOTHED_RATE, Boosting, fit_gbt
from courtside.session import store

KEYS = ("player", "match_id")


def _split(train: DataFrame, test: DataFrame) -> DataFrame:
    marked = [part.select(*KEYS, F.lit(name).alias("part")) for part, name in ((train, "train"), (test, "test"))]
    return marked[0].unionByName(marked[1])


@query(
    "split_quantile_date",
    f"""WITH {HISTORY_SQL}, days AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i, count(*) OVER () AS n
          FROM (SELECT DISTINCT CAST(date AS DATE) AS d FROM hist)),
        cut AS (SELECT d FROM days WHERE i = CAST(floor(n * 0.8) AS BIGINT))
        SELECT player, match_id, CASE WHEN CAST(date AS DATE) < d THEN 'train' ELSE 'test' END AS part FROM hist, cut""",
)
def split_quantile_date(t: Tables) -> DataFrame:
    return _split(*evaluation.split_by_date_rank(history(t), "date"))


@query(
    "split_days",
    f"""WITH {HISTORY_SQL}, cut AS (SELECT CAST(max(date) AS DATE) - 60 AS d FROM hist)
        SELECT player, match_id, CASE WHEN CAST(date AS DATE) < d THEN 'train' ELSE 'test' END AS part FROM hist, cut""",
)
def split_days(t: Tables) -> DataFrame:
    return _split(*evaluation.split_by_days(history(t), "date"))


@query(
    "sample_weight",
    f"""WITH {HISTORY_SQL} SELECT player, match_id, round(greatest(minutes, 1) * CASE
          WHEN date >= TIMESTAMP '2000-08-06' THEN 1.0::DOUBLE WHEN date >= TIMESTAMP '1999-08-06' THEN 0.7 ELSE 0.4 END, 6)
        AS weight FROM hist""",
)
def sample_weights(t: Tables) -> DataFrame:
    return history(t).select(*KEYS, r6(sample_weight("minutes", season_weight("date", 2000))).alias("weight"))


@query(
    "train_filter",
    f"""WITH {HISTORY_SQL} SELECT player, match_id, round(points / greatest(minutes, 1), 6) AS target FROM hist
        WHERE minutes >= 3""",
)
def train_filter(t: Tables) -> DataFrame:
    return history(t).where("minutes >= 3").select(*KEYS, r6(rate_target("points", "minutes")).alias("target"))


# Forecast = mean of the last five; points in units of 100,000 so that errors stay near one.
_SCORED_SQL = f"""{HISTORY_SQL}, lagged AS (SELECT *, avg(points) OVER ({BY_PLAYER} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
    / 10000000.0::DOUBLE AS yhat, avg(minutes) OVER ({BY_PLAYER} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS form,
    points / 10000000.0::DOUBLE AS y FROM hist),
  scored AS (SELECT * FROM lagged WHERE yhat IS NOT NULL)"""


def _scored(t: Tables) -> DataFrame:
    means = {"_p": ("points", 5, 1), "form": ("minutes", 5, 1)}
    done = history_features(history(t), "player", PLAYER_ORDER, (), means).where("_p is not null")
    return done.withColumns({"yhat": F.col("_p") / 1e7, "y": F.col("points") / 1e7})


@query(
    "combine_pred",
    f"""WITH {_SCORED_SQL} SELECT player, match_id, round(greatest(form - 10, 0) * greatest(plus_minus / 10, 0), 6) + 0.0 AS pred
        FROM scored""",
)
def combine_pred(t: Tables) -> DataFrame:
    pred = combine(F.col("form") - 10, F.col("plus_minus") / 10)
    return _scored(t).select(*KEYS, (r6(pred) + 0.0).alias("pred"))


_METRICS_SQL = """count(*) AS n, round(avg(abs(y - yhat)), 6) AS mae,
  round(1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)), 6) AS r2"""


def _metrics(df: DataFrame) -> DataFrame:
    return df.select("n", r6("mae").alias("mae"), r6("r2").alias("r2"))


@query("eval_metrics", f"WITH {_SCORED_SQL} SELECT {_METRICS_SQL} FROM scored")
def eval_metrics(t: Tables) -> DataFrame:
    return _metrics(evaluation.regression_metrics(_scored(t), "y", "yhat"))


@query("segment_mae", f"WITH {_SCORED_SQL} SELECT {_METRICS_SQL} FROM scored WHERE minutes > 15")
def segment_mae(t: Tables) -> DataFrame:
    return _metrics(evaluation.regression_metrics(_scored(t), "y", "yhat", F.col("minutes") > 15))


_SIGMA_SQL = """round(stddev_pop(y - yhat), 6) AS residual, round(avg(abs(y - yhat)) + stddev_pop(abs(y - yhat)), 6) AS mean_plus_std,
  round(avg(abs(y - yhat)) * 1.2533::DOUBLE, 6) AS mae_scaled"""


@query("sigma_variants", f"WITH {_SCORED_SQL} SELECT {_SIGMA_SQL} FROM scored")
def sigma_variants(t: Tables) -> DataFrame:
    return _scored(t).agg(*[r6(c).alias(kind) for kind, c in evaluation.sigma_columns("y", "yhat").items()])


_PERIODS_SQL = "minutes % 7 AS Q1, minutes % 5 AS Q2, minutes % 3 AS Q3, minutes % 2 AS Q4"


@query(
    "period_share",
    f"""WITH {_SCORED_SQL}, p AS (SELECT yhat, {_PERIODS_SQL} FROM scored),
        s AS (SELECT *, CASE WHEN Q1 + Q2 + Q3 + Q4 = 0 THEN 1 ELSE Q1 + Q2 + Q3 + Q4 END AS total FROM p)
        SELECT {", ".join(f"round(avg(yhat * (Q{q} / total)), 6) AS mean_Q{q}" for q in (1, 2, 3, 4))} FROM s""",
)
def period_share(t: Tables) -> DataFrame:
    scored = _scored(t).withColumns({f"Q{q}": F.col("minutes") % m for q, m in ((1, 7), (2, 5), (3, 3), (4, 2))})
    shares = evaluation.period_breakdown(scored, "yhat", ["Q1", "Q2", "Q3", "Q4"])
    return shares.select(*[r6(c).alias(c) for c in shares.columns])


def _cdf_sql(z: str) -> str:
    x = f"(abs({z}) / sqrt(2.0::DOUBLE))"
    t = f"(1 / (1 + {ERF_P}::DOUBLE * {x}))"
    a = [f"({v}::DOUBLE)" for v in ERF_A]
    poly = f"{t} * ({a[0]} + {t} * ({a[1]} + {t} * ({a[2]} + {t} * ({a[3]} + {t} * {a[4]}))))"
    erf = f"(1 - {poly} * exp(-{x} * {x}))"
    return f"CASE WHEN {z} < 0 THEN (1 - {erf}) / 2 ELSE (1 + {erf}) / 2 END"


# A betting line per row, and one spread for all rows.
_LINE = "(y + (match_id % 9 - 4) / 4.0)"
_PROBS_SQL = f"""{_SCORED_SQL}, spread AS (SELECT avg(abs(y - yhat)) AS mae FROM scored),
  lines AS (SELECT player, match_id, date, yhat, {_LINE} AS line, mae, (yhat - {_LINE}) / (mae * 1.2533::DOUBLE) AS z FROM scored, spread),
  probs AS (SELECT *, {_cdf_sql('z')} AS prob FROM lines)"""


def _lines(t: Tables) -> DataFrame:
    scored = _scored(t).withColumn("line", F.col("y") + (F.col("match_id") % 9 - 4) / 4)
    spread = scored.agg(F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("mae")).scalar()
    lines = scored.withColumn("mae", spread)
    return lines.withColumn("prob", over_under("yhat", F.col("mae") * 1.2533, "line"))


@query("over_under_prob", f"WITH {_PROBS_SQL} SELECT player, match_id, round(prob, 6) AS prob_over FROM probs")
def over_under_prob(t: Tables) -> DataFrame:
    return _lines(t).select(*KEYS, r6("prob").alias("prob_over"))


@query(
    "edge_rule",
    f"""WITH {_PROBS_SQL}, bets AS (SELECT *, CASE WHEN abs(yhat - line) > mae AND prob > 0.65 THEN 'over'
          WHEN abs(yhat - line) > mae AND 1 - prob > 0.65 THEN 'under' END AS bet FROM probs)
        SELECT player, match_id, bet FROM bets WHERE bet IS NOT NULL AND player IN (SELECT player FROM bets
          GROUP BY player HAVING CAST(max(date) AS DATE) >= (SELECT CAST(max(date) AS DATE) - 60 FROM bets))""",
)
def edge_rules(t: Tables) -> DataFrame:
    bets = _lines(t).withColumn("bet", edge_rule("yhat", "line", "prob", F.col("mae")))
    return recent_only(bets, "player", "date").where("bet is not null").select(*KEYS, "bet")


class _Form:
    """A stand-in for trained models: the form, moved by the opponent."""

    stats = {"sigma": 10_000.0}

    def predict(self, df: DataFrame) -> DataFrame:
        return df.withColumn("points_hat", F.col("L5_points") * 0.75 + F.length("opponent") * 1000.0)


@query(
    "matchup_list",
    f"""WITH {HISTORY_SQL}, ranked AS (SELECT player, date, points, row_number() OVER (PARTITION BY player ORDER BY date DESC,
          match_id DESC) AS rn FROM hist),
        forms AS (SELECT player, avg(points) AS form, max(date) AS last FROM ranked WHERE rn <= 5 GROUP BY player),
        active AS (SELECT *, c_mktsegment AS team, CASE WHEN c_mktsegment = 'BUILDING' THEN 'machinery' ELSE 'building' END AS opponent
          FROM forms JOIN customer ON player = c_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
          AND CAST(last AS DATE) >= (SELECT CAST(max(date) AS DATE) - 60 FROM hist))
        SELECT player, team, opponent, strftime(last, '%Y-%m-%d') AS last_played, round(form, 6) AS form,
          round(form * 0.75 + length(opponent) * 1000.0 - form, 6) + 0.0 AS edge FROM active""",
)
def matchup_list(t: Tables) -> DataFrame:
    """The active players of two sides before their next match, the largest expected gain first."""
    teams = t.customer.select(F.col("c_custkey").alias("player"), F.col("c_mktsegment").alias("team"))
    games = history(t).join(teams, "player")
    last_five = lambda df: history_features(df, "player", PLAYER_ORDER, (), {"L5_points": ("points", 5, 1)})
    listed = matchup(games, _Form(), "BUILDING", "MACHINERY", prepare=last_five)
    gap = (r6("edge") + 0.0).alias("edge")
    return listed.select("player", "team", "opponent", day_text("last_played").alias("last_played"), r6("form").alias("form"), gap)


# Teams in lower case; a player of both sides of an order is two players.
_BEFORE = "OVER (PARTITION BY player ORDER BY date RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING)"
_CLASS_SQL = """CASE WHEN r > 6 AND k > 0.5 THEN 'C' WHEN a > 3.5 THEN 'PG' WHEN r > 4.5 THEN 'PF'
  WHEN q > 12 AND a < 2.5 THEN 'SG' ELSE 'SF' END"""
_OUT_SQL = {
    "Opp_Avg_Pts_Allowed": "p", "Opp_Avg_Fouls": "f", "Opp_Avg_Pace": "pace", "Opp_Max_Foul_Drawer": "drawn", "Opp_Best_Def_Synergy": "synergy",
}
NEXT_MATCH_SQL = f"""WITH {box_sql("l_partkey")},
  b AS (SELECT box.* REPLACE (lower(team) AS team, player * 2 + CASE WHEN starts_with(team, 'O') THEN 1 ELSE 0 END AS player),
      CASE WHEN minutes = 0 THEN 1 ELSE minutes END AS m, CAST(o_orderdate AS DATE) AS date FROM box JOIN orders ON match_id = o_orderkey),
  sides AS (SELECT DISTINCT match_id, team FROM b),
  g AS (SELECT b.*, s.team AS opponent, (points + rebounds + turnovers) / m AS pace
      FROM b LEFT JOIN sides s ON b.match_id = s.match_id AND b.team <> s.team),
  h AS (SELECT *, avg(rebounds) {_BEFORE} AS r, avg(blocks) {_BEFORE} AS k, avg(assists) {_BEFORE} AS a, avg(points) {_BEFORE} AS q FROM g),
  classes AS (SELECT opponent, {_CLASS_SQL} AS cls, avg(points) AS allowed, avg(2 * r + 5 * k) AS faced FROM h GROUP BY 1, 2),
  values_of AS (SELECT match_id, team, sum(points) AS p, sum(fouls) AS f, avg(pace) AS pace, max(turnovers) AS drawn,
      max(assists / 2.0::DOUBLE) AS synergy FROM g GROUP BY 1, 2),
  totals AS (SELECT team, {", ".join(f"avg({c}) AS {out}" for out, c in _OUT_SQL.items())} FROM values_of GROUP BY 1),
  own AS (SELECT player, avg(rebounds) AS r, avg(blocks) AS k, avg(assists) AS a, avg(points) AS q FROM g GROUP BY 1),
  latest AS (SELECT *, row_number() OVER (PARTITION BY player ORDER BY date DESC, match_id DESC) AS rn FROM g
      WHERE date >= (SELECT max(date) - 60 FROM g)),
  coming AS (SELECT player, team, CASE WHEN team = 'o-1' THEN 'o-2' ELSE 'o-1' END AS opponent, date FROM latest
      WHERE rn = 1 AND team IN ('o-1', 'o-2')),
  known AS (SELECT coming.*, {_CLASS_SQL} AS cls, 2 * r + 5 * k AS size, q FROM coming JOIN own USING (player))
  SELECT player, known.team, known.opponent, strftime(date, '%Y-%m-%d') AS last_played, cls AS Pos_Est, round(size, 6) AS Size_Index,
    {", ".join(f"round({out}, 6) AS {out}" for out in _OUT_SQL)}, round(allowed, 6) AS Opp_Allowed_Pos_Avg, round(faced, 6) AS Opp_Avg_Size,
    round(size - faced, 6) AS Mismatch_Adv, round(allowed - q, 6) AS Def_Suppressor
  FROM known LEFT JOIN totals ON known.opponent = totals.team LEFT JOIN classes USING (opponent, cls)"""


@query("next_match_features", NEXT_MATCH_SQL)
def next_match_features(t: Tables) -> DataFrame:
    """Matchup columns of the active players of two sides before their next match, from the state of the whole league."""
    dates = t.orders.select(F.col("o_orderkey").alias("match_id"), F.col("o_orderdate").cast("date").alias("date"))
    rows = box(t).withColumn("player", F.col("player") * 2 + F.when(F.col("team").startswith("O"), 1).otherwise(0))
    rows = rows.withColumn("team", F.lower("team")).join(dates, "match_id")
    pace = (F.col("points") + F.col("rebounds") + F.col("turnovers")) / F.when(F.col("minutes") == 0, 1).otherwise(F.col("minutes"))
    rows = rows.withColumns({"Pace_Est": pace, "Fouls_Drawn": F.col("turnovers"), "Synergy_Score": F.col("assists") / 2})
    games = store(matchups.opponent_map(rows, "match_id", "team"))
    coming = MatchupState.of(games).attach(next_match(games, "o-1", "o-2").where("_next"))
    numbers = [c for c in ASOF_OUTPUTS if c != "Pos_Est"]
    return coming.select(
        "player", "team", "opponent", day_text("_last_played").alias("last_played"), "Pos_Est", *[r6(c).alias(c) for c in numbers]
    )


_MODEL_MEANS = {
    "L3_points": ("points", 3, 1),
    "L5_points": ("points", 5, 1),
    "L10_points": ("points", 10, 1),
    "L5_minutes": ("minutes", 5, 1),
}


def _forecast(t: Tables, label: str, boosting: Boosting) -> DataFrame:
    """Fit on all but the last 60 days, score those; the rows are written once, as every round reads them."""
    rows = history_features(history(t), "player", PLAYER_ORDER, ("points", "minutes"), _MODEL_MEANS).fillna(0)
    rows = rows.withColumns(
        {"rate": rate_target("points", "minutes"), "weight": sample_weight("minutes", season_weight("date", 2000))}
    )
    features = [*_MODEL_MEANS, "L1_points", "L1_minutes"]
    rows = store(rows.select(*KEYS, "date", "minutes", "rate", "weight", *features))
    train, test = evaluation.split_by_days(rows, "date")
    model = fit_gbt(train, features, label, "weight", boosting, "prediction")
    return model.transform(test).select(*KEYS, F.col(label).cast("double").alias("actual"), "prediction")


@query("gbt_minutes")
def gbt_minutes(t: Tables) -> DataFrame:
    return _forecast(t, "minutes", SMOOTHED_MINUTES)


@query("gbt_rate")
def gbt_rate(t: Tables) -> DataFrame:
    return _forecast(t, "rate", SMOOTHED_RATE)
