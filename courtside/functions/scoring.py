"""Combining forecasts, training targets and weights, and over/under probabilities."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from courtside.functions.cleaning import ColumnLike, as_column, ratio_floor_one

#: The polynomial approximation 7.1.26 of erf by Abramowitz and Stegun.
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)

#: Fixed value: standard deviation of a normal error per unit of mean absolute error.
SIGMA_PER_MAE = 1.2533


def combine(minutes_hat: ColumnLike, rate_hat: ColumnLike) -> Column:
    """Product of both forecasts, neither taken below zero."""
    zero = F.lit(0.0)
    return F.greatest(as_column(minutes_hat), zero) * F.greatest(as_column(rate_hat), zero)


def sample_weight(minutes: ColumnLike, season: ColumnLike) -> Column:
    """Season weight times minutes, minutes counted as at least one."""
    return F.greatest(as_column(minutes), F.lit(1.0)) * as_column(season)


def rate_target(points: ColumnLike, minutes: ColumnLike) -> Column:
    return ratio_floor_one(points, minutes)


def normal_cdf(z: ColumnLike) -> Column:
    """Standard normal distribution function (absolute error below 1e-7)."""
    z = as_column(z)
    x = F.abs(z) / F.lit(2.0**0.5)
    t = 1 / (1 + ERF_P * x)
    poly = F.lit(0.0)
    for a in reversed(ERF_A):
        poly = (poly + a) * t
    erf = 1 - poly * F.exp(-(x * x))
    return F.when(z < 0, (1 - erf) / 2).otherwise((1 + erf) / 2)


def over_under(mu: ColumnLike, sigma: ColumnLike, line: ColumnLike) -> Column:
    """Probability that a normal outcome around ``mu`` lands above ``line``.

    Without spread the outcome is certain: 1, 0, or one half on the line itself.
    """
    mu, sigma, line = as_column(mu), as_column(sigma), as_column(line)
    gap = mu - line
    certain = F.when(gap > 0, 1.0).when(gap < 0, 0.0).otherwise(0.5)
    return F.when(sigma > 0, normal_cdf(gap / F.nullif(sigma, F.lit(0)))).otherwise(certain)


def edge_rule(
    mu: ColumnLike, line: ColumnLike, prob_over: ColumnLike, mae: ColumnLike | float, p: float = 0.65
) -> Column:
    """'over', 'under' or null: a likely side whose gap to the line exceeds the usual error."""
    mu, line, prob = as_column(mu), as_column(line), as_column(prob_over)
    mae = F.lit(mae) if isinstance(mae, (int, float)) else as_column(mae)
    wide = F.abs(mu - line) > mae
    return F.when(wide & (prob > p), "over").when(wide & (1 - prob > p), "under")
