"""Shot geometry on a court in percent coordinates (0 to 100 both ways)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from courtside.functions.cleaning import ColumnLike, as_column

#: Both baskets, and the bounds of a quality shot.
BASKETS = ((5, 50), (95, 50))
NEAR, FAR, SIDE = 8, 22, 35


def min_distance(x: ColumnLike, y: ColumnLike, anchors: Sequence[tuple[float, float]] = BASKETS) -> Column:
    """Euclidean distance to the nearest anchor."""
    x, y = as_column(x), as_column(y)
    distances = [F.sqrt((x - ax) * (x - ax) + (y - ay) * (y - ay)) for ax, ay in anchors]
    return F.least(*distances) if len(distances) > 1 else distances[0]


def quality_flag(
    dist: ColumnLike, y: ColumnLike, near: float = NEAR, far: float = FAR, side: float = SIDE
) -> Column:
    """1 for a shot at the rim or from the far corner, else 0."""
    dist, y = as_column(dist), as_column(y)
    good = (dist < near) | ((dist > far) & (F.abs(y - 50) > side))
    return F.when(good, F.lit(1)).otherwise(F.lit(0))


def shot_zone(action: ColumnLike, sub_type: ColumnLike, y: ColumnLike) -> Column:
    """Rim, MidRange, Corner3 or Arc3; null for an action that is neither a two nor a three."""
    action, sub_type, y = as_column(action), as_column(sub_type), as_column(y)
    return (
        F.when((action == "2pt") & sub_type.rlike("layup|dunk"), "Rim")
        .when(action == "2pt", "MidRange")
        .when((action == "3pt") & (F.abs(y - 50) > 40), "Corner3")
        .when(action == "3pt", "Arc3")
    )
