"""Play-by-play operators: who was on the floor, who acted next, what was counted when.

Events are ordered by match, period, clock running down, then their place in the feed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from courtside.functions.cleaning import clock_seconds, ratio_or_zero, ratio_zero_one
from courtside.operators.ordered import MAX_GROUP_ROWS, Cuts, _names, find_cuts, ordered
from courtside.session import store

#: Order of events inside a match; ``neg_sec`` is made by ``order_events``.
EVENT_ORDER = ("period", "neg_sec", "seq")

#: Event names, the scoring pattern, and the clutch and garbage-time bounds.
SUBSTITUTION, SUB_IN, SUB_OUT = "substitution", "in", "out"
ASSIST, FOUL_DRAWN = "assist", "foulon"
SCORING_PATTERN = "2pt|3pt|freethrow"
CLUTCH_PERIOD, CLUTCH_MARGIN, CLUTCH_SECONDS, GARBAGE_MARGIN = 4, 5, 300, 20


def order_events(pbp: DataFrame, clock: str = "clock") -> DataFrame:
    """Add seconds left (``SEC``) and the column that orders them downwards (``neg_sec``)."""
    return pbp.withColumn("SEC", clock_seconds(clock)).withColumn("neg_sec", -F.col("SEC"))


def presence_mean(
    events: DataFrame,
    roster: DataFrame,
    grp: str,
    ent: str,
    ord: str | Sequence[str],
    score: str,
    change: str,
    starter: str = "starter",
    out: str = "Synergy_Score",
    cuts: Cuts | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Mean score change while an entity was present, per roster row (0 if none).

    ``score`` is the running total after each event (gaps take the last known one), ``change`` is
    1 when ``ent`` comes in with this event, 0 when it goes out, null otherwise. An event's own
    score change still belongs to those present before it. Since the score is itself a running
    total, what a stint is credited with is the total at its end minus the total at its start:
    only come-and-go events take part in per-entity work, and no event meets every entity.
    """
    ord = _names(ord)
    work = ordered(events.select(grp, ent, *ord, score, change), grp, ord, cuts, max_rows)
    work = work.fill({"_total": score})
    known, previous = F.coalesce("_total", F.lit(0)), lambda w: F.coalesce(F.lag("_total").over(w), F.lit(0))
    work = work.rows(
        lambda w: {
            "_moved": F.when(known != previous(w), 1).otherwise(0),
            "_last": F.lead(F.lit(True)).over(w).isNull(),
        },
        back=1,
        ahead=1,
    )
    logged = work.running({"_moves": "_moved"}).done().withColumn("_total", known)
    # From here on only the comings and goings and each match's last event matter. They are a
    # fraction of the log and read twice, so they are stored.
    logged = store(logged.where(F.col(change).isNotNull() | F.col("_last")))
    match_end = logged.where("_last").select(grp, F.col("_total").alias("_end_total"), F.col("_moves").alias("_end_moves"))

    squad = roster.groupBy(grp, ent).agg(F.max(F.coalesce(starter, F.lit(0))).alias("_starter"))
    turns = logged.where(F.col(change).isNotNull()).join(squad, [grp, ent])
    turn_cuts = find_cuts(turns, (grp, ent), ord, max_rows, coarse=(logged, (grp, ent)))
    turns = ordered(turns, (grp, ent), ord, turn_cuts).rows(
        lambda w: {"_before": F.coalesce(F.lag(change).over(w), F.col("_starter"))}, back=1
    )
    sign = F.when(F.col(change) == 1, -1).otherwise(1)
    stints = (
        turns.done()
        .where(F.col(change) != F.col("_before"))
        .groupBy(grp, ent)
        .agg(
            F.sum(sign * F.col("_total")).alias("_credit"),
            F.sum(sign * F.col("_moves")).alias("_count"),
            F.max_by(change, F.struct(*ord)).alias("_final"),
        )
    )
    present = F.coalesce("_final", "_starter") == 1
    credit = F.coalesce("_credit", F.lit(0)) + F.when(present, F.coalesce("_end_total", F.lit(0))).otherwise(0)
    count = F.coalesce("_count", F.lit(0)) + F.when(present, F.coalesce("_end_moves", F.lit(0))).otherwise(0)
    mean = F.when(count == 0, F.lit(0.0)).otherwise(credit / F.nullif(count, F.lit(0)))
    return squad.join(match_end, grp, "left").join(stints, [grp, ent], "left").select(grp, ent, mean.alias(out))


def stints(
    events: DataFrame,
    roster: DataFrame,
    grp: str,
    ent: str,
    ord: str | Sequence[str],
    change: str,
    starter: str = "starter",
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Presence intervals ``(came, left]`` in terms of ``ord``; null is an open end.

    With several order columns an end is a struct of them.
    """
    ord = _names(ord)
    at = F.col(ord[0]) if len(ord) == 1 else F.struct(*ord)
    squad = roster.groupBy(grp, ent).agg(F.max(F.coalesce(starter, F.lit(0))).alias("_starter"))
    turns = events.where(F.col(change).isNotNull()).select(grp, ent, *ord, change).join(squad, [grp, ent])
    flips = (events.where(F.col(change).isNotNull()), (grp, ent))
    turn_cuts = find_cuts(turns, (grp, ent), ord, max_rows, coarse=flips)
    real = ordered(turns, (grp, ent), ord, turn_cuts).rows(
        lambda w: {"_before": F.coalesce(F.lag(change).over(w), F.col("_starter"))}, back=1
    )
    real_turns = real.done().where(F.col(change) != F.col("_before")).select(grp, ent, *ord, change)
    paired = ordered(real_turns, (grp, ent), ord, turn_cuts).rows(
        lambda w: {"_came": F.lag(at).over(w)}, back=1
    )
    closed = paired.done().where(F.col(change) == 0).select(grp, ent, F.col("_came").alias("came"), at.alias("left"))
    last = real_turns.groupBy(grp, ent).agg(F.max_by(change, at).alias("_final"), F.max(at).alias("_at"))
    still = (
        squad.join(last, [grp, ent], "left")
        .where(F.coalesce("_final", "_starter") == 1)
        .withColumns({"came": F.col("_at"), "left": F.when(F.lit(False), F.col("_at"))})
        .select(grp, ent, "came", "left")
    )
    return closed.unionByName(still)


def interval_join(
    points: DataFrame, spans: DataFrame, keys: str | Sequence[str], at: str, start: str, end: str, width: int = 64
) -> DataFrame:
    """Every point with every span of the same keys that holds it: ``start < at <= end``.

    ``at``, ``start`` and ``end`` are whole numbers. Both sides are cut into bins of ``width``: a point is in one
    bin, a span in each that it touches, so that the join is one on equal keys and bins, and what a key
    with many points and spans has to do is spread over its bins. A span is repeated once per
    ``width`` of its length; choose it near the usual length. Nulls meet nothing; columns other than the keys
    must have different names on both sides.
    """
    keys = list(_names(keys))
    bin_of = lambda c: F.floor(c / width)
    placed = points.withColumn("_bin", bin_of(F.col(at)))
    touched = F.explode(F.sequence(bin_of(F.col(start) + 1), bin_of(F.col(end))))
    cut = spans.where(F.col(start) < F.col(end)).withColumn("_bin", touched)
    return placed.join(cut, [*keys, "_bin"]).where((F.col(at) > F.col(start)) & (F.col(at) <= F.col(end))).drop("_bin")


def interval_sums(
    points: DataFrame,
    spans: DataFrame,
    keys: str | Sequence[str],
    at: str,
    start: str,
    end: str,
    sums: Mapping[str, Column],
    by: Sequence[str],
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Sums over what ``interval_join`` pairs, per ``keys`` and the columns ``by`` of the spans.

    ``sums`` are whole numbers of the points. A span's sum is the running total at its end less
    that at its start: points and ends of spans are put in one order, so nothing is paired and the
    work grows with the rows of both sides, however long the spans are. Keys or places that are null
    meet nothing; a group whose spans hold no point has sums of 0.
    """
    keys, by = list(_names(keys)), list(by)
    known = lambda df, *columns: df.dropna(subset=[*keys, *columns])
    placed = known(points, at).select(*keys, F.col(at).cast("bigint").alias("_place"), *[c.alias(o) for o, c in sums.items()])
    closed = known(spans, start, end).where(F.col(start) < F.col(end))
    ends = F.array(*[F.struct(F.col(c).cast("bigint").alias("_place"), F.lit(s).alias("_sign")) for c, s in ((start, -1), (end, 1))])
    marks = closed.select(*keys, *by, F.inline(ends))
    # At equal places points come first: a span holds the points at its end, not those at its start.
    rows = placed.withColumn("_sign", F.lit(0)).unionByName(marks, allowMissingColumns=True)
    rows = store(rows.withColumn("_mark", F.abs("_sign")))
    totals = ordered(rows, keys, ("_place", "_mark"), max_rows=max_rows).running({f"_to_{o}": o for o in sums}).done()
    kept = totals.where("_sign <> 0").groupBy(*keys, *by)
    return kept.agg(*[F.coalesce(F.sum(F.col("_sign") * F.col(f"_to_{o}")), F.lit(0)).alias(o) for o in sums])


def presence_by_interval(
    events: DataFrame,
    roster: DataFrame,
    grp: str,
    ent: str,
    ord: str | Sequence[str],
    score: str,
    change: str,
    starter: str = "starter",
    out: str = "Synergy_Score",
    width: int | None = None,
    cuts: Cuts | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """What ``presence_mean`` gives, from sums of the scoring events inside each stint.

    No event meets those present, so the work grows with events and stints, not with their pairs
    (``interval_sums``); the pairs themselves are ``interval_join`` over ``stints``. ``width`` was that of
    the bins of the join and has no effect.
    """
    ord = _names(ord)
    work = ordered(events.select(grp, ent, *ord, score, change), grp, ord, cuts, max_rows).fill({"_total": score})
    known, before = F.coalesce("_total", F.lit(0)), lambda w: F.coalesce(F.lag("_total").over(w), F.lit(0))
    work = work.rows(lambda w: {"_diff": known - before(w)}, back=1).running({"_at": F.lit(1)})
    # Read for the stints, the ends of matches and the scoring events.
    log = store(work.done().select(grp, ent, "_at", "_diff", change))
    ends = log.groupBy(grp).agg(F.max("_at").alias("_end"))
    spans = stints(log, roster, grp, ent, "_at", change, starter, max_rows).join(ends, grp)
    spans = spans.select(grp, ent, F.coalesce("came", F.lit(0)).alias("came"), F.coalesce("left", "_end").alias("left"))
    scoring = log.where("_diff <> 0").select(grp, "_at", "_diff")
    held = interval_sums(scoring, spans, grp, "_at", "came", "left", {"_sum": F.col("_diff"), "_n": F.lit(1)}, (ent,), max_rows)
    means = held.where("_n > 0").select(grp, ent, (F.col("_sum") / F.col("_n")).alias("_mean"))
    squad = roster.select(grp, ent).distinct()
    return squad.join(means, [grp, ent], "left").select(grp, ent, F.coalesce("_mean", F.lit(0.0)).alias(out))


def next_actor_count(
    df: DataFrame,
    grp: str,
    ent: str,
    ord: str | Sequence[str],
    action: Column,
    out: str = "Assisted_Baskets",
    cuts: Cuts | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """How often an entity is the next one in the group's log after ``action``."""
    ord = _names(ord)
    slim = df.select(grp, ent, *ord, action.alias("_hit"))
    following = ordered(slim, grp, ord, cuts, max_rows).rows(lambda w: {"_next": F.lead(ent).over(w)}, ahead=1)
    hits = following.done().where(F.col("_hit") & F.col("_next").isNotNull())
    return hits.groupBy(grp, F.col("_next").alias(ent)).agg(F.count(F.lit(1)).alias(out))


def dependency_index(
    box: DataFrame, assisted: DataFrame, grp: str, ent: str, points: str, count: str = "Assisted_Baskets"
) -> DataFrame:
    """Add ``Dependency_Index``: assisted baskets over points, zero points counting as one."""
    joined = box.join(assisted, [grp, ent], "left")
    return joined.withColumn("Dependency_Index", ratio_zero_one(F.coalesce(count, F.lit(0)), points))


def conditional_count(df: DataFrame, keys: Sequence[str], counts: Mapping[str, Column]) -> DataFrame:
    """Several conditional counts per key in one aggregation."""
    return df.groupBy(*keys).agg(*[F.count_if(cond).alias(out) for out, cond in counts.items()])


def activity_pivot(
    df: DataFrame, keys: Sequence[str], period: str, when: Column, periods: Sequence[int] = (1, 2, 3, 4)
) -> DataFrame:
    """``Q{p}_Activity``: rows meeting ``when`` per period, 0 where there are none."""
    counted = df.where(when).groupBy(*keys).pivot(period, list(periods)).agg(F.count(F.lit(1)))
    named = counted.withColumnsRenamed({str(p): f"Q{p}_Activity" for p in periods})
    return named.fillna(0, subset=[f"Q{p}_Activity" for p in periods])


def is_clutch(period: str, margin: Column, sec: str) -> Column:
    return (F.col(period) == CLUTCH_PERIOD) & (F.abs(margin) <= CLUTCH_MARGIN) & (F.col(sec) <= CLUTCH_SECONDS)


def clutch_shooting(
    df: DataFrame, keys: Sequence[str], clutch: Column, attempt: Column, made: Column
) -> DataFrame:
    """``Clutch_FGA``, ``Clutch_FGM`` and ``Clutch_FG%`` per key; without an attempt the share is 0."""
    counts = {"Clutch_FGA": clutch & attempt, "Clutch_FGM": clutch & attempt & made}
    return conditional_count(df, keys, counts).withColumn("Clutch_FG%", ratio_or_zero("Clutch_FGM", "Clutch_FGA"))


def is_garbage(period: str, margin: Column) -> Column:
    return (F.col(period) == CLUTCH_PERIOD) & (F.abs(margin) >= GARBAGE_MARGIN)
