"""Registered queries over the star-schema test tables, each with its SQL counterpart."""

from courtside.catalog import (  # noqa: F401  (importing registers the queries)
    boxscore,
    cleaning,
    features,
    flattening,
    forecasting,
    history,
    playbyplay,
)
from courtside.catalog.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
