"""Column expressions: everything here takes and returns ``Column`` and stays on the JVM."""

from courtside.functions.cleaning import (
    clock_seconds,
    minutes_lenient,
    minutes_of,
    ratio_floor_one,
    ratio_or_zero,
    ratio_zero_one,
    to_date_safe,
    to_num,
)
from courtside.functions.labels import (
    abs_over,
    classify,
    code_map,
    equals_flag,
    month_of,
    season_weight,
    weighted_sum,
)
from courtside.functions.markup import hrefs, html_text, labelled_date, link_id
from courtside.functions.names import normalize_name
from courtside.functions.ratios import (
    effective_fg,
    efficiency,
    off_rating,
    possessions,
    true_shooting,
    usage,
)
from courtside.functions.scoring import combine, edge_rule, normal_cdf, over_under, rate_target, sample_weight
from courtside.functions.shooting import min_distance, quality_flag, shot_zone

__all__ = [name for name in dir() if not name.startswith("_")]
