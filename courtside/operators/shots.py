"""Shot aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from courtside.functions.cleaning import ratio_or_zero

#: The zones and what a made shot from each is worth.
ZONE_POINTS = {"Rim": 2, "MidRange": 2, "Corner3": 3, "Arc3": 3}


def rate_by(df: DataFrame, keys: Sequence[str], flag: str, out: str) -> DataFrame:
    """Mean of a flag per key."""
    return df.groupBy(*keys).agg(F.avg(flag).alias(out))


def zone_stats(
    df: DataFrame, keys: Sequence[str], zone: str, made: Column, zones: Mapping[str, int] = ZONE_POINTS
) -> DataFrame:
    """Attempts, made, points, share of attempts and points per shot by zone, in one aggregation."""
    counts = []
    for name in zones:
        here = F.col(zone) == name
        counts += [F.count_if(here).alias(f"{name}_Attempts"), F.count_if(here & made).alias(f"{name}_Made")]
    counted = df.groupBy(*keys).agg(*counts, F.count(zone).alias("FGA"), F.count_if(made & F.col(zone).isNotNull()).alias("FGM"))
    scored = counted.withColumns({f"{z}_Points": F.col(f"{z}_Made") * worth for z, worth in zones.items()})
    return scored.withColumns(
        {f"{z}_Freq": ratio_or_zero(f"{z}_Attempts", "FGA") for z in zones}
        | {f"{z}_PPS": ratio_or_zero(f"{z}_Points", f"{z}_Attempts") for z in zones}
    )
