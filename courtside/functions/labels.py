"""Rules that turn numbers and dates into classes, codes, flags and weights."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from courtside.functions.cleaning import ColumnLike, as_column

#: Position codes, and the code of an unknown position.
POSITION_CODES = {"PG": 1, "SG": 2, "SF": 3, "PF": 4, "C": 5, "F": 3}
POSITION_DEFAULT = 3

#: Season start (month, day) and weights of current, previous and older seasons.
SEASON_START = (8, 6)
SEASON_WEIGHTS = (1.0, 0.7, 0.4)

#: Weights of the size index and of gravity.
SIZE_WEIGHTS = {"rebounds": 2, "blocks": 5}
GRAVITY_WEIGHTS = {"points": 0.4, "efficiency": 0.6}


def position_rules(
    rebounds: ColumnLike = "rebounds",
    blocks: ColumnLike = "blocks",
    assists: ColumnLike = "assists",
    points: ColumnLike = "points",
) -> list[tuple[Column, str]]:
    """The position thresholds over a player's mean statistics, in order."""
    reb, blk, ast, pts = map(as_column, (rebounds, blocks, assists, points))
    return [
        ((reb > 6) & (blk > 0.5), "C"),
        (ast > 3.5, "PG"),
        (reb > 4.5, "PF"),
        ((pts > 12) & (ast < 2.5), "SG"),
    ]


def classify(rules: Sequence[tuple[Column, str]], default: str = "SF") -> Column:
    """Label of the first rule that holds."""
    (first, label), *rest = rules
    chain = F.when(first, F.lit(label))
    for condition, label in rest:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(default))


def weighted_sum(weights: Mapping[str, float]) -> Column:
    """Sum of columns times their weights (size index, gravity, baseline blends)."""
    terms = [F.col(name) * F.lit(weight) for name, weight in weights.items()]
    return sum(terms[1:], terms[0])


def code_map(
    label: ColumnLike, codes: Mapping[str, int] = POSITION_CODES, default: int = POSITION_DEFAULT
) -> Column:
    """Code of a label; unknown and missing labels take ``default``."""
    label = as_column(label)
    chain = None
    for name, code in codes.items():
        chain = F.when(label == name, code) if chain is None else chain.when(label == name, code)
    return F.lit(default) if chain is None else chain.otherwise(default)


def season_weight(
    date: ColumnLike,
    current_year: int | str | dt.date | None,
    start: tuple[int, int] = SEASON_START,
    weights: tuple[float, float, float] = SEASON_WEIGHTS,
) -> Column:
    """Weight by season: current, previous, older (a missing date counts as older).

    ``current_year`` may be a whole number, a date, or a text that is or begins with a year
    (``2024``, ``2024-25``, ``2024-09-01``); without a readable year every row weighs the same as the current season.
    """
    current, previous, older = weights
    year = getattr(current_year, "year", current_year)
    if isinstance(year, str):
        found = re.match(r"\s*(\d{4})(?!\d)", year)
        year = int(found.group(1)) if found else None
    if not isinstance(year, int) or not dt.MINYEAR < year <= dt.MAXYEAR:
        return F.lit(current)
    cuts = [dt.date(year, *start), dt.date(year - 1, *start)]
    date = as_column(date)
    return F.when(date >= F.lit(cuts[0]), current).when(date >= F.lit(cuts[1]), previous).otherwise(older)


def abs_over(value: ColumnLike, bound: float = 15) -> Column:
    """1 where the absolute value exceeds ``bound``, else 0 (also for a missing value)."""
    return F.when(F.abs(as_column(value)) > bound, 1).otherwise(0)


def equals_flag(a: ColumnLike, b: ColumnLike) -> Column:
    """1 where both are equal, else 0 (also where either is missing)."""
    return F.when(as_column(a) == as_column(b), 1).otherwise(0)


def month_of(date: ColumnLike) -> Column:
    return F.month(as_column(date))
