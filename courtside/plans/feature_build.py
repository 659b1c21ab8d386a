"""Box score, play-by-play and shots to one row of features per player and match.

Everything is keyed by (match, player), so the aggregates of the play-by-play and of the shots
meet the box score in joins over one and the same partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from courtside.functions import (
    classify,
    equals_flag,
    min_distance,
    normalize_name,
    quality_flag,
    ratio_zero_one,
    season_weight,
    weighted_sum,
)
from courtside.functions.labels import GRAVITY_WEIGHTS, SIZE_WEIGHTS, position_rules
from courtside.operators import event_log, matchups
from courtside.operators.boxstats import side_totals
from courtside.operators.ordered import MAX_GROUP_ROWS, find_cuts
from courtside.operators.rolling import days_since_prev
from courtside.operators.shots import rate_by
from courtside.operators.tables import fill_dates, fill_numeric
from courtside.session import store

KEYS = ["match_id", "player"]
#: Fixed value: the periods of regular time.
PERIODS = (1, 2, 3, 4)
PROFILE = ["rebounds", "blocks", "assists", "points"]
#: Fixed value: shot quality assumed when there are no shots at all.
UNKNOWN_SHOT_QUALITY = 0.5


def lineup_features(box: DataFrame, pbp: DataFrame | None, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Synergy_Score, Dependency_Index and, with a play-by-play, Gravity."""
    if pbp is None:
        return box.withColumns({"Synergy_Score": F.lit(0.0), "Dependency_Index": F.lit(0.0)})
    sub = F.col("action_type") == event_log.SUBSTITUTION
    events = pbp.withColumns(
        {
            "_score": F.col("score_home") + F.col("score_away"),
            "_change": F.when(sub & (F.col("sub_type") == event_log.SUB_IN), 1).when(
                sub & (F.col("sub_type") == event_log.SUB_OUT), 0
            ),
        }
    )
    cuts = find_cuts(pbp, "match_id", event_log.EVENT_ORDER, max_rows)
    synergy = event_log.presence_mean(
        events, box, "match_id", "player", event_log.EVENT_ORDER, "_score", "_change", cuts=cuts, max_rows=max_rows
    )
    assist = F.col("action_type") == event_log.ASSIST
    assisted = event_log.next_actor_count(pbp, "match_id", "player", event_log.EVENT_ORDER, assist, cuts=cuts)
    joined = event_log.dependency_index(box.join(synergy, KEYS, "left"), assisted, "match_id", "player", "points")
    return joined.withColumn("Gravity", weighted_sum(GRAVITY_WEIGHTS))


def event_counts(pbp: DataFrame, periods: tuple[int, ...] = PERIODS) -> DataFrame:
    """Fouls drawn, scoring activity per period, clutch and garbage-time events in one pass.

    Scoring after the last of ``periods`` is counted as overtime.
    """
    margin = F.col("score_home") - F.col("score_away")
    scoring = F.col("action_type").rlike(event_log.SCORING_PATTERN) & (F.col("success") == 1)
    counts = {
        "Fouls_Drawn": F.col("action_type") == event_log.FOUL_DRAWN,
        "Clutch_Events": event_log.is_clutch("period", margin, "SEC"),
        "GT_Activity_Index": event_log.is_garbage("period", margin),
    }
    counts |= {f"Q{p}_Activity": scoring & (F.col("period") == p) for p in periods}
    counts["OT_Activity"] = scoring & (F.col("period") > max(periods))
    return event_log.conditional_count(pbp.where("player is not null"), KEYS, counts)


def context_features(df: DataFrame, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Points of the side, days since the player's last match and, with the home side known, whether at home."""
    df = side_totals(df, "match_id", "team", {"points": "PTS"})
    if "Home_Team_Name" in df.columns:
        df = df.withColumn("Is_Home", equals_flag(normalize_name("team"), normalize_name("Home_Team_Name")))
    if "date" in df.columns:
        df = days_since_prev(df, "player", ("date", "match_id"), "date", max_rows=max_rows)
    return df


def style_features(
    df: DataFrame, pbp: DataFrame | None, shots: DataFrame | None, periods: tuple[int, ...] = PERIODS
) -> DataFrame:
    """Pace, scoring rate, event counts and shot quality."""
    actions = F.col("points") + F.col("rebounds") + F.col("turnovers")
    styled = df.withColumns(
        {"Pace_Est": ratio_zero_one(actions, "MIN_FL"), "Raw_PPM": ratio_zero_one("points", "MIN_FL")}
    )
    if pbp is None:
        styled = styled.withColumn("Fouls_Drawn", F.lit(0).cast("bigint"))
    else:
        styled = styled.join(event_counts(pbp, periods), KEYS, "left").fillna(0, ["Fouls_Drawn"])
    if shots is None:
        return styled.withColumn("Shot_Quality_Avg", F.lit(UNKNOWN_SHOT_QUALITY))
    flagged = shots.withColumn("_q", quality_flag(min_distance("x", "y"), "y"))
    return styled.join(rate_by(flagged, KEYS, "_q", "Shot_Quality_Avg"), KEYS, "left")


_SIDE_AGGREGATES = {
    "points": ("sum", "Opp_Avg_Pts_Allowed"),
    "fouls": ("sum", "Opp_Avg_Fouls"),
    "Pace_Est": ("avg", "Opp_Avg_Pace"),
    "Fouls_Drawn": ("max", "Opp_Max_Foul_Drawer"),
    "Synergy_Score": ("max", "Opp_Best_Def_Synergy"),
}


#: What ``matchup_features_asof`` reads and what it adds.
ASOF_INPUTS = ("match_id", "team", "opponent", "date", *PROFILE, *_SIDE_AGGREGATES)
ASOF_OUTPUTS = (
    "Pos_Est", "Size_Index", *[out for _, out in _SIDE_AGGREGATES.values()], "Opp_Allowed_Pos_Avg", "Opp_Avg_Size",
    "Mismatch_Adv", "Def_Suppressor",
)


def matchup_features(df: DataFrame, box: DataFrame) -> DataFrame:
    """Positions, opponent totals, what opponents allow: means over the whole period."""
    profile = matchups.entity_profile(box, "player", PROFILE)
    positions = profile.select(
        "player", classify(position_rules()).alias("Pos_Est"), weighted_sum(SIZE_WEIGHTS).alias("Size_Index")
    )
    full = matchups.opponent_totals(df.join(positions, "player", "left"), "match_id", "team", "opponent", _SIDE_AGGREGATES)
    full = matchups.mean_by_class(
        full, "opponent", "Pos_Est", {"Opp_Allowed_Pos_Avg": "points", "Opp_Avg_Size": "Size_Index"}
    )
    full = full.withColumn("Mismatch_Adv", F.col("Size_Index") - F.col("Opp_Avg_Size"))
    return matchups.suppressor(full, "player", "points", "Opp_Allowed_Pos_Avg", base=df)


#: Names of a player's own means, and of the means by opponent and class with what they are taken of.
_OWN = {f"_p_{c}": c for c in PROFILE}
_ALLOWED = {"Opp_Allowed_Pos_Avg": "points", "Opp_Avg_Size": "Size_Index"}
_SIDES = {out: f"_t_{out}" for _, out in _SIDE_AGGREGATES.values()}


def _with_class(df: DataFrame) -> DataFrame:
    """Position and size by the player's own means."""
    return df.withColumns(
        {
            "Pos_Est": classify(position_rules("_p_rebounds", "_p_blocks", "_p_assists", "_p_points")),
            "Size_Index": weighted_sum({f"_p_{c}": w for c, w in SIZE_WEIGHTS.items()}),
        }
    )


def _with_edges(df: DataFrame) -> DataFrame:
    """The player against what the opponent allows."""
    return df.withColumns(
        {
            "Mismatch_Adv": F.col("Size_Index") - F.col("Opp_Avg_Size"),
            "Def_Suppressor": F.col("Opp_Allowed_Pos_Avg") - F.col("_p_points"),
        }
    ).drop(*_OWN)


def _side_values(df: DataFrame) -> DataFrame:
    """One row per match and side with its ``_t_`` values, stored, as its sums are measured before they are taken."""
    by = ["match_id", "team", "date"]
    sums = {out: c for c, (fn, out) in _SIDE_AGGREGATES.items() if fn in ("sum", "avg")}
    most = {out: c for c, (fn, out) in _SIDE_AGGREGATES.items() if fn == "max"}
    found = matchups.state(df, by, sums, [F.max(c).alias(f"_t_{out}") for out, c in most.items()])
    means = matchups.state_means(sums)
    values = {out: F.col(f"_s_{out}") if fn == "sum" else means[out] for fn, out in _SIDE_AGGREGATES.values() if out in sums}
    return store(found.select(*by, *[c.alias(f"_t_{out}") for out, c in values.items()], *[f"_t_{out}" for out in most]))


def matchup_features_asof(df: DataFrame) -> DataFrame:
    """The same columns, each from strictly earlier dates only, so that none knows its own match."""
    past = _with_class(matchups.asof_aggregate(df, "player", "date", _OWN))
    sides = matchups.asof_aggregate(_side_values(df), "team", "date", _SIDES)
    sides = sides.select("match_id", F.col("team").alias("opponent"), *_SIDES)
    # Measured, summed by day and joined back to: read three times from here.
    full = store(past.join(sides, ["match_id", "opponent"], "left"))
    return _with_edges(matchups.asof_aggregate(full, ["opponent", "Pos_Est"], "date", _ALLOWED))


@dataclass(frozen=True)
class MatchupState:
    """Sums and counts of all that was played, from which the matchup columns of a coming match follow.

    ``players`` is keyed by player, ``sides`` by team, ``classes`` by opponent and position. The tables are
    as small as the league; stored once, they serve every forecast until the next match is played.
    """

    players: DataFrame
    sides: DataFrame
    classes: DataFrame

    @classmethod
    def of(cls, df: DataFrame) -> "MatchupState":
        """State after all rows of ``df``, which are rows of matches with ``ASOF_INPUTS``.

        Classes hold the positions and sizes that the players had when they played, which is what
        ``matchup_features_asof`` averages.
        """
        played = df.where("date IS NOT NULL").select(*dict.fromkeys(("player", *ASOF_INPUTS)))
        then = _with_class(matchups.asof_aggregate(played, "player", "date", _OWN))
        # Measured before it is summed, so without the copy the whole history would be worked out twice.
        then = store(then.select("opponent", "Pos_Est", *_ALLOWED.values()))
        return cls(
            store(matchups.state(played, "player", _OWN)),
            store(matchups.state(_side_values(played), "team", _SIDES)),
            store(matchups.state(then, ["opponent", "Pos_Est"], _ALLOWED)),
        )

    def attach(self, coming: DataFrame) -> DataFrame:
        """Add ``ASOF_OUTPUTS`` to rows of a coming match, of which player and opponent are known."""
        coming = coming.drop(*ASOF_OUTPUTS)
        players = self.players.withColumns(matchups.state_means(_OWN)).select("player", *_OWN)
        sides = self.sides.withColumns(matchups.state_means(_SIDES)).select(F.col("team").alias("opponent"), *_SIDES)
        classes = self.classes.withColumns(matchups.state_means(_ALLOWED)).select("opponent", "Pos_Est", *_ALLOWED)
        full = _with_class(coming.join(players, "player", "left")).join(sides, "opponent", "left")
        return _with_edges(full.join(classes, ["opponent", "Pos_Est"], "left"))


def build_features(
    box: DataFrame,
    pbp: DataFrame | None = None,
    shots: DataFrame | None = None,
    current_season: int | str | None = None,
    as_of: bool = False,
    max_rows: int = MAX_GROUP_ROWS,
    periods: tuple[int, ...] = PERIODS,
) -> DataFrame:
    """One row per box-score row with all features; missing numbers are 0.

    With ``as_of`` the matchup columns use earlier dates only; train on those. Without it they
    are means over the whole period, which suits description but leaks into training. Rows without a
    date get one from their neighbours in ``seq``, where the box score carries that.
    """
    box = fill_dates(box, max_rows=max_rows)
    df = matchups.opponent_map(context_features(box, max_rows), "match_id", "team")
    weight = season_weight("date", current_season) if "date" in box.columns else F.lit(1.0)
    df = df.withColumn("Season_Weight", weight)
    df = lineup_features(df, pbp, max_rows)
    # Every matchup aggregate reads the rows so far once more, so these are stored.
    df = store(style_features(df, pbp, shots, periods))
    df = matchup_features_asof(df) if as_of else matchup_features(df, box)
    return fill_numeric(df)
