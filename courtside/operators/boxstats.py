"""Side totals and the ratios of a player to their side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from courtside.functions.cleaning import ratio_or_zero
from courtside.functions.ratios import effective_fg, off_rating, possessions, true_shooting, usage


def side_totals(
    df: DataFrame, grp: str, side: str, cols: Sequence[str] | Mapping[str, str], prefix: str = "Tm_"
) -> DataFrame:
    """Attach the side's sum of each column (``{column: short name}`` names the outputs).

    Summed by aggregation and joined back, so that one large side is summed map-side and does
    not have to pass through a single window task.
    """
    names = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}
    totals = df.groupBy(grp, side).agg(*[F.sum(c).alias(prefix + n) for c, n in names.items()])
    return df.join(totals, [grp, side], "left")


#: Box columns summed per side, and the short names of their totals.
SIDE_COLUMNS = {
    "MIN_FL": "MIN",
    "FGA": "FGA",
    "FTA": "FTA",
    "turnovers": "TOV",
    "rebounds": "REB",
    "OREB": "OREB",
    "points": "PTS",
    "FGM": "FGM",
}


def box_ratios(df: DataFrame, grp: str = "match_id", side: str = "team") -> DataFrame:
    """Add side totals and every box ratio to a box score that carries shooting counts."""
    totals = side_totals(df, grp, side, SIDE_COLUMNS)
    return totals.withColumns(
        {
            "Poss": possessions("FGA", "FTA", "turnovers", "OREB"),
            "USG%": usage("FGA", "FTA", "turnovers", "MIN_FL", "Tm_FGA", "Tm_FTA", "Tm_TOV", "Tm_MIN"),
            "TS%": true_shooting("points", "FGA", "FTA"),
            "eFG%": effective_fg("FGM", "FG3M", "FGA"),
            "Reb_Share": ratio_or_zero("rebounds", "Tm_REB"),
            "Scoring_Share": ratio_or_zero("points", "Tm_PTS"),
            "Fouls_Per_Min": ratio_or_zero("fouls", "MIN_FL"),
            "Blowout_Factor": ratio_or_zero("plus_minus", "MIN_FL"),
            "opp_points_allowed": F.col("Tm_PTS").cast("double"),
            "opp_fg_allowed": ratio_or_zero("Tm_FGM", "Tm_FGA"),
        }
    ).withColumn("ORtg", off_rating("points", "Poss"))
