"""Scoring players of an upcoming match and checking lines against the forecast."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from courtside.functions import edge_rule, normalize_name, over_under
from courtside.operators.rolling import latest_snapshot
from courtside.plans.feature_build import ASOF_INPUTS, ASOF_OUTPUTS, MatchupState, matchup_features_asof
from courtside.plans.training import ORDER, PLAYER, TwoStage, recent_features
from courtside.session import store

_NEXT, _PLAYED = "_next", "_last_played"


def next_match(
    features: DataFrame, side_a: str, side_b: str, home: bool = True, date: Column | None = None, days: int = 60
) -> DataFrame:
    """The rows of the players of two sides, and one new row for each that is active: the coming match.

    The new rows (``_next`` is true) have the date of the match (by default the day after the newest
    one), the other side as opponent and no statistics; ``_last_played`` is the date of the row that they
    follow. A player's own history is to be computed over the result; what sides and opponents did comes
    from the whole table (``MatchupState``), most of which is not in it.
    """
    newest = features.agg(F.max("date").alias("newest")).scalar()
    team_a, team_b = (normalize_name(F.lit(side)) for side in (side_a, side_b))
    is_a, is_b = ((F.col("team") == name) | (F.col("team") == side) for name, side in ((team_a, side_a), (team_b, side_b)))
    latest = latest_snapshot(features.where(F.col("date") >= F.date_sub(newest, days)), PLAYER, ORDER).where(is_a | is_b)
    types = dict(features.dtypes)
    when = F.date_add(newest, 1) if date is None else date
    new = latest.select(
        PLAYER,
        "team",
        F.lit(-1).cast(types["match_id"]).alias("match_id"),
        when.cast(types["date"]).alias("date"),
        F.when(is_a, team_b).otherwise(team_a).alias("opponent"),
        F.when(is_a, int(home)).otherwise(int(not home)).alias("Is_Home"),
        F.lit(True).alias(_NEXT),
        F.col("date").alias(_PLAYED),
    )
    squads = latest.select(PLAYER).distinct()
    past = features.join(squads, PLAYER, "left_semi")
    return past.withColumn(_NEXT, F.lit(False)).unionByName(new, allowMissingColumns=True)


def matchup(
    features: DataFrame,
    models: TwoStage,
    side_a: str,
    side_b: str,
    home: bool = True,
    form: str = "L5_points",
    days: int = 60,
    date: Column | None = None,
    prepare: Callable[[DataFrame], DataFrame] = recent_features,
    state: MatchupState | None = None,
) -> DataFrame:
    """Active players of both sides with forecast, gap to form and chance to beat it, best gap first.

    ``home`` says whether ``side_a`` plays at home. The teams are matched by normalised name. The
    forecast row of a player comes after the last match played: ``prepare`` computes the history up to and
    including that match, and the matchup columns are those of the coming opponent, as the whole table of
    ``features`` gives them: from ``state``, or computed here from all rows before the match.
    """
    if set(ASOF_INPUTS) <= set(features.columns):
        if state is None:
            state = MatchupState.of(features if date is None else features.where(F.col("date").cast("date") < date.cast("date")))
        if not set(ASOF_OUTPUTS) <= set(features.columns):
            features = store(matchup_features_asof(features.drop(*ASOF_OUTPUTS)))
    rows = next_match(features, side_a, side_b, home, date, days)
    if state is not None:
        coming = state.attach(rows.where(_NEXT))
        rows = rows.where(~F.col(_NEXT)).unionByName(coming, allowMissingColumns=True)
    coming = prepare(rows).where(_NEXT)
    scored = models.predict(coming)
    sigma = F.lit(models.stats["sigma"])
    return scored.select(
        PLAYER,
        "team",
        "opponent",
        F.col(_PLAYED).alias("last_played"),
        F.col("points_hat"),
        F.col(form).alias("form"),
        (F.col("points_hat") - F.col(form)).alias("edge"),
        over_under("points_hat", sigma, form).alias("prob_over_form"),
    ).orderBy(F.desc("edge"), PLAYER)


def check_line(forecast: DataFrame, player: str, line: float, sigma: float, mae: float, p: float = 0.65) -> DataFrame:
    """Over and under probabilities of one line for the players whose name contains ``player``."""
    found = forecast.where(F.col(PLAYER).contains(normalize_name(F.lit(player))))
    over = over_under("points_hat", F.lit(sigma), F.lit(float(line)))
    return found.withColumns({"line": F.lit(float(line)), "prob_over": over, "prob_under": 1 - over}).withColumn(
        "bet", edge_rule("points_hat", "line", "prob_over", mae, p)
    )
