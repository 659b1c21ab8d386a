"""Opponents, entity profiles and what a side allows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from courtside.operators.exact import exact_sums
from courtside.operators.ordered import Cuts, _names, ordered


def opponent_map(df: DataFrame, grp: str, side: str, out: str = "opponent") -> DataFrame:
    """Add the other side of the group; null if there is none.

    One aggregation gathers the distinct sides of each group (never more than a match has); a row
    is repeated for every side other than its own.
    """
    sides = df.where(F.col(grp).isNotNull() & F.col(side).isNotNull()).groupBy(grp).agg(F.collect_set(side).alias("_sides"))
    others = F.filter("_sides", lambda s: s != F.col(side))
    return df.join(sides, grp, "left").withColumn(out, F.explode_outer(others)).drop("_sides")


def entity_profile(df: DataFrame, ent: str | Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Mean of each metric per entity, under the metric's own name."""
    return df.groupBy(*_names(ent)).agg(*[F.avg(m).alias(m) for m in metrics])


def opponent_totals(
    df: DataFrame, grp: str, side: str, opp: str, aggs: Mapping[str, tuple[Column, str]] | Sequence[Column]
) -> DataFrame:
    """Aggregate every side of a group and attach the result to the rows of its opponent.

    ``aggs`` are aliased aggregates, or ``{column: (function name, out)}``.
    """
    if isinstance(aggs, Mapping):
        aggs = [getattr(F, fn)(col).alias(out) for col, (fn, out) in aggs.items()]
    totals = df.groupBy(grp, F.col(side).alias(opp)).agg(*aggs)
    return df.join(totals, [grp, opp], "left")


def mean_by_class(df: DataFrame, opp: str, cls: str, means: Mapping[str, str]) -> DataFrame:
    """Attach ``{out: value}`` means per (opponent, class): points allowed, size faced, minutes."""
    allowed = df.groupBy(opp, cls).agg(*[F.avg(value).alias(out) for out, value in means.items()])
    return df.join(allowed, [opp, cls], "left")


def suppressor(
    df: DataFrame, ent: str, value: str, allowed: str, out: str = "Def_Suppressor", base: DataFrame | None = None
) -> DataFrame:
    """What the opponent allows minus what the entity averages.

    ``base`` is a cheaper table with the same values to average, where ``df`` is costly.
    """
    own = (df if base is None else base).groupBy(ent).agg(F.avg(value).alias("_own"))
    return df.join(own, ent, "left").withColumn(out, F.col(allowed) - F.col("_own")).drop("_own")


def state(df: DataFrame, keys: str | Sequence[str], aggs: Mapping[str, str], others: Sequence[Column] = ()) -> DataFrame:
    """Sums ``_s_{out}`` (exact) and counts ``_n_{out}`` of the values ``{out: value}`` per key.

    States of separate days, or of old and new rows, merge by adding up. ``others`` are aliased aggregates
    of the same groups.
    """
    counts = {f"_n_{o}": F.when(F.col(v).isNotNull(), 1).otherwise(0) for o, v in aggs.items()}
    return exact_sums(df, list(_names(keys)), {f"_s_{o}": F.col(v) for o, v in aggs.items()} | counts, others)


def state_means(aggs: Mapping[str, str]) -> dict[str, Column]:
    """The means that sums and counts of a state stand for."""
    return {o: F.col(f"_s_{o}") / F.nullif(F.col(f"_n_{o}"), F.lit(0)) for o in aggs}


def asof_aggregate(
    df: DataFrame,
    keys: str | Sequence[str],
    date: str,
    aggs: Mapping[str, str],
) -> DataFrame:
    """Attach ``{out: value}`` means over rows of strictly earlier days with the same keys.

    ``date`` may be a timestamp: what counts is its day. Rows are first summed per key and day, so a
    key's running work is over its days. A row with a missing key gets no mean.
    """
    keys = list(_names(keys))
    df = df.withColumn("_day", F.col(date).cast("date"))
    daily = state(df, [*keys, "_day"], aggs)
    sums = [f"_{m}_{o}" for o in aggs for m in "sn"]
    # One row per key and calendar day: no group can be large, so nothing is measured.
    past = ordered(daily.withColumnsRenamed({c: f"_d{c}" for c in sums}), keys, "_day", Cuts(tuple(keys), ("_day",)))
    past = past.running({c: f"_d{c}" for c in sums}, include_current=False).done()
    return df.join(past.withColumns(state_means(aggs)).select(*keys, "_day", *aggs), [*keys, "_day"], "left").drop("_day")
