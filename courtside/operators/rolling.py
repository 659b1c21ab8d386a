"""Features from an entity's own past. No frame includes the current row.

Chained calls over the same entity and order share one shuffle and one sort; pass ``cuts`` from
``find_cuts`` to measure the groups once for the whole chain.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from courtside.functions.cleaning import ratio_zero_one
from courtside.functions.labels import weighted_sum
from courtside.operators.exact import exact_sums
from courtside.operators.ordered import MAX_GROUP_ROWS, Cuts, _names, ordered


def lag_features(
    df: DataFrame,
    ent: str | Sequence[str],
    ord: str | Sequence[str],
    cols: str | Sequence[str],
    k: int = 1,
    cuts: Cuts | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """``L{k}_{col}``: the value ``k`` rows back."""
    work = ordered(df, ent, ord, cuts, max_rows)
    return work.rows(lambda w: {f"L{k}_{c}": F.lag(c, k).over(w) for c in _names(cols)}, back=k).done()


def _window_mean(w, col: str, n: int, min_periods: int) -> Column:
    frame = w.rowsBetween(-n, -1)
    mean = F.avg(col).over(frame)
    return mean if min_periods <= 1 else F.when(F.count(col).over(frame) >= min_periods, mean)


def rolling_mean(
    df: DataFrame,
    ent: str | Sequence[str],
    ord: str | Sequence[str],
    cols: str | Sequence[str],
    windows: Sequence[int] = (3, 5, 10),
    min_periods: int = 1,
    cuts: Cuts | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """``L{n}_{col}``: mean over the previous ``n`` rows with at least ``min_periods`` values."""
    work = ordered(df, ent, ord, cuts, max_rows)
    return work.rows(
        lambda w: {f"L{n}_{c}": _window_mean(w, c, n, min_periods) for c in _names(cols) for n in windows},
        back=max(windows),
    ).done()


def history_features(
    df: DataFrame,
    ent: str | Sequence[str],
    ord: str | Sequence[str],
    lags: Sequence[str] = (),
    means: Mapping[str, tuple[str, int, int]] | None = None,
    cuts: Cuts | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Lag-1 columns and named means ``{out: (col, n, min_periods)}`` in one pass."""
    means = dict(means or {})
    reach = max([1] + [n for _, n, _ in means.values()])

    def build(w) -> dict[str, Column]:
        lagged = {f"L1_{c}": F.lag(c, 1).over(w) for c in lags}
        return lagged | {out: _window_mean(w, c, n, least) for out, (c, n, least) in means.items()}

    return ordered(df, ent, ord, cuts, max_rows).rows(build, back=reach).done()


def expanding(
    df: DataFrame,
    ent: str | Sequence[str],
    ord: str | Sequence[str],
    cols: str | Sequence[str],
    fns: Sequence[str] = ("avg", "sum"),
    cuts: Cuts | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """``Hist_{fn}_{col}`` over all earlier rows (null before the first value)."""
    cols = _names(cols)
    totals: dict[str, Column] = {}
    for c in cols:
        totals[f"_s_{c}"] = F.col(c)
        totals[f"_n_{c}"] = F.when(F.col(c).isNotNull(), F.lit(1)).otherwise(F.lit(0))
    done = ordered(df, ent, ord, cuts, max_rows).running(totals, include_current=False).done()
    outputs = {
        "sum": lambda c: F.col(f"_s_{c}"),
        "avg": lambda c: F.col(f"_s_{c}") / F.nullif(F.col(f"_n_{c}"), F.lit(0)),
        "count": lambda c: F.coalesce(F.col(f"_n_{c}"), F.lit(0)),
    }
    return done.withColumns({f"Hist_{fn}_{c}": outputs[fn](c) for c in cols for fn in fns}).drop(*totals)


def prior_mean(
    df: DataFrame,
    keys: str | Sequence[str],
    ord: str | Sequence[str],
    value: str,
    out: str,
    cuts: Cuts | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Mean of ``value`` over the earlier rows with the same keys (a player against an opponent)."""
    done = expanding(df, keys, ord, value, ("avg",), cuts, max_rows)
    return done.withColumnRenamed(f"Hist_avg_{value}", out)


def difference(a: str, b: str) -> Column:
    """Trend: short window minus long window."""
    return F.col(a) - F.col(b)


def blend(weights: Mapping[str, float]) -> Column:
    """Weighted baseline of several windows."""
    return weighted_sum(weights)


def rolling_rate(
    df: DataFrame,
    ent: str | Sequence[str],
    ord: str | Sequence[str],
    num: str,
    den: str,
    n: int = 5,
    min_periods: int = 1,
    out: str | None = None,
    cuts: Cuts | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Mean of ``num`` over mean of ``den`` in the last ``n`` rows; a zero denominator counts as one."""
    means = {"_num": (num, n, min_periods), "_den": (den, n, 1)}
    done = history_features(df, ent, ord, (), means, cuts, max_rows)
    name = out or f"L{n}_{num}_per_{den}"
    return done.withColumn(name, ratio_zero_one("_num", "_den")).drop("_num", "_den")


def global_rate(df: DataFrame, num: str, den: str) -> Column:
    """Total ``num`` over total ``den`` (at least one) as a scalar subquery; doubles are summed exactly."""
    sums = exact_sums(df, [], {"_num": F.col(num), "_den": F.col(den)})
    return sums.select((F.col("_num") / F.when(F.col("_den") < 1, F.lit(1)).otherwise(F.col("_den"))).alias("rate")).scalar()


def shrunk_rate(
    df: DataFrame,
    ent: str | Sequence[str],
    ord: str | Sequence[str],
    num: str,
    den: str,
    k: float = 30.0,
    prior: Column | None = None,
    out: str = "Smoothed_Rate",
    cuts: Cuts | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """An entity's past rate pulled towards ``prior``, the less history the stronger.

    Without ``prior`` the rate of the whole table is used; for training pass the rate of the
    training rows only (``global_rate(train, ...)``).
    """
    prior = global_rate(df, num, den) if prior is None else prior
    work = ordered(df, ent, ord, cuts, max_rows)
    done = work.running({"_num": num, "_den": den}, include_current=False).done()
    history, gained = F.coalesce("_den", F.lit(0.0)), F.coalesce("_num", F.lit(0.0))
    weight = history / (history + F.lit(k))
    past = gained / F.when(history < 1, F.lit(1.0)).otherwise(history)
    return done.withColumn(out, weight * past + (1 - weight) * prior).drop("_num", "_den")


def rolling_std(
    df: DataFrame,
    ent: str | Sequence[str],
    ord: str | Sequence[str],
    col: str,
    n: int = 10,
    out: str = "Consistency_Index",
    cuts: Cuts | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Population standard deviation over the previous ``n`` rows."""
    work = ordered(df, ent, ord, cuts, max_rows)
    return work.rows(lambda w: {out: F.stddev_pop(col).over(w.rowsBetween(-n, -1))}, back=n).done()


def days_since_prev(
    df: DataFrame,
    ent: str | Sequence[str],
    ord: str | Sequence[str],
    date: str,
    default: int = 7,
    out: str = "Days_Rest",
    cuts: Cuts | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Days since the entity's previous row; ``default`` for its first one."""
    work = ordered(df, ent, ord, cuts, max_rows)
    gap = lambda w: F.coalesce(F.date_diff(F.col(date), F.lag(date).over(w)), F.lit(default))
    return work.rows(lambda w: {out: gap(w)}, back=1).done()


def recent_only(
    df: DataFrame, ent: str, date: str, days: int = 60, asof: Column | None = None
) -> DataFrame:
    """All rows of entities seen within ``days`` of ``asof`` (by default the newest date)."""
    if asof is None:
        since = df.agg(F.date_sub(F.max(date), days).alias("since")).scalar()
    else:
        since = F.date_sub(asof, days)
    # An entity is recent exactly if one of its rows is, so the filter reaches the scan.
    seen = df.where(F.col(date) >= since).select(ent).distinct()
    return df.join(seen, ent, "left_semi")


def latest_snapshot(df: DataFrame, ent: str | Sequence[str], ord: str | Sequence[str]) -> DataFrame:
    """The last row of every entity.

    A rank of one lets each task drop all but its last row per entity before the shuffle.
    """
    latest = Window.partitionBy(*_names(ent)).orderBy(*[F.desc(c) for c in _names(ord)])
    return df.withColumn("_rn", F.row_number().over(latest)).where("_rn = 1").drop("_rn")
