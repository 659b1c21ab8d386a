"""Temporal splits and forecast errors, all as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from courtside.functions.cleaning import ratio_zero_one
from courtside.functions.scoring import SIGMA_PER_MAE


def rank_cutoff(df: DataFrame, date: str, frac: float = 0.8) -> Column:
    """The date at ``frac`` of the sorted distinct dates, as a scalar subquery.

    Dates are cut to the day, so the collected set is bounded by the calendar.
    """
    days = F.array_sort(F.collect_set(F.col(date).cast("date")))
    return df.agg(F.get(days, F.floor(F.size(days) * F.lit(frac)).cast("int")).alias("cutoff")).scalar()


def days_cutoff(df: DataFrame, date: str, days: int = 60) -> Column:
    """The newest date minus ``days``, as a scalar subquery."""
    return df.agg(F.date_sub(F.max(F.col(date).cast("date")), days).alias("cutoff")).scalar()


def split_at(df: DataFrame, date: str, cutoff: Column) -> tuple[DataFrame, DataFrame]:
    day = F.col(date).cast("date")
    return df.where(day < cutoff), df.where(day >= cutoff)


def split_by_date_rank(df: DataFrame, date: str, frac: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Train before, test from the date at ``frac`` of the distinct dates."""
    return split_at(df, date, rank_cutoff(df, date, frac))


def split_by_days(df: DataFrame, date: str, days: int = 60) -> tuple[DataFrame, DataFrame]:
    """Test on the last ``days`` days, train on what is before."""
    return split_at(df, date, days_cutoff(df, date, days))


def regression_metrics(df: DataFrame, y: str, yhat: str, where: Column | None = None) -> DataFrame:
    """One row: rows used, MAE and R2, optionally over a segment only."""
    rows = df if where is None else df.where(where)
    rows = rows.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    error = F.col(y) - F.col(yhat)
    sst = F.var_pop(y) * F.count(F.lit(1))
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.sum(error * error) / F.nullif(sst, F.lit(0.0))).alias("r2"),
    )


def sigma_columns(y: str, yhat: str) -> dict[str, Column]:
    """The three spread estimates as aggregates, by kind."""
    error = F.col(y) - F.col(yhat)
    mae = F.avg(F.abs(error))
    return {
        "residual": F.stddev_pop(error),
        "mean_plus_std": mae + F.stddev_pop(F.abs(error)),
        "mae_scaled": mae * F.lit(SIGMA_PER_MAE),
    }


def sigma(df: DataFrame, y: str, yhat: str, kind: str = "residual") -> DataFrame:
    """One row with the spread of the errors by the chosen definition."""
    return df.agg(sigma_columns(y, yhat)[kind].alias("sigma"))


def period_breakdown(df: DataFrame, yhat: str, period_cols: Sequence[str]) -> DataFrame:
    """One row: mean forecast per period, each row's forecast shared out by past activity."""
    total = sum((F.col(c) for c in period_cols[1:]), F.col(period_cols[0]))
    return df.agg(*[F.avg(F.col(yhat) * ratio_zero_one(c, total)).alias(f"mean_{c}") for c in period_cols])
