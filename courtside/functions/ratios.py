"""Box-score ratios. A zero denominator gives zero throughout."""

from __future__ import annotations

from pyspark.sql import Column

from courtside.functions.cleaning import ColumnLike, as_column, ratio_or_zero

#: Fixed value: share of free throws that end a possession.
FT_WEIGHT = 0.44


def efficiency(
    points: ColumnLike,
    rebounds: ColumnLike,
    assists: ColumnLike,
    steals: ColumnLike,
    blocks: ColumnLike,
    fg_attempts: ColumnLike,
    fg_made: ColumnLike,
    ft_attempts: ColumnLike,
    ft_made: ColumnLike,
    turnovers: ColumnLike,
) -> Column:
    """Good actions minus missed field goals, missed free throws and turnovers."""
    good = sum((as_column(c) for c in (rebounds, assists, steals, blocks)), as_column(points))
    missed = (as_column(fg_attempts) - as_column(fg_made)) + (as_column(ft_attempts) - as_column(ft_made))
    return good - missed - as_column(turnovers)


def _plays(fga: ColumnLike, fta: ColumnLike, tov: ColumnLike) -> Column:
    return as_column(fga) + FT_WEIGHT * as_column(fta) + as_column(tov)


def possessions(fga: ColumnLike, fta: ColumnLike, tov: ColumnLike, oreb: ColumnLike) -> Column:
    return _plays(fga, fta, tov) - as_column(oreb)


def usage(
    fga: ColumnLike,
    fta: ColumnLike,
    tov: ColumnLike,
    minutes: ColumnLike,
    team_fga: ColumnLike,
    team_fta: ColumnLike,
    team_tov: ColumnLike,
    team_minutes: ColumnLike,
) -> Column:
    """Percent of the side's plays a player ended while on the floor."""
    own = 100 * _plays(fga, fta, tov) * (as_column(team_minutes) / 5)
    return ratio_or_zero(own, as_column(minutes) * _plays(team_fga, team_fta, team_tov))


def off_rating(points: ColumnLike, poss: ColumnLike) -> Column:
    return ratio_or_zero(100 * as_column(points), poss)


def true_shooting(points: ColumnLike, fga: ColumnLike, fta: ColumnLike) -> Column:
    return ratio_or_zero(points, 2 * (as_column(fga) + FT_WEIGHT * as_column(fta)))


def effective_fg(fgm: ColumnLike, fg3m: ColumnLike, fga: ColumnLike) -> Column:
    return ratio_or_zero(as_column(fgm) + 0.5 * as_column(fg3m), fga)
