"""Ordered work inside groups (lag, rolling, running totals, fills) that survives a hot group.

A window over ``partitionBy(keys)`` puts a whole group into one task. That is the cheapest plan
while groups are small, and a dead end when one group holds a third of the table. So the group
sizes are measured first (``find_cuts``). If none is too large the plain window runs. Otherwise
the table is range-partitioned by keys and order, which cuts a large group into parts along its
order, and stored with the part number. Each part of a group is then a window partition of its
own, and what crosses a part border is carried over exactly:

* a bounded frame gets copies of the few rows before (after) the part, dropped afterwards;
* a running total or fill gets one summary row per part, combined over the parts of a group.

At most one group crosses each border, so whatever is carried over is bounded by the number of
parts; whether it is broadcast or shuffled is left to its size. Work without keys is always cut. The
order columns together must be unique within a group. Where the borders fall only balances the
work: every row takes part in the result, and running totals are exact, so that cutting changes no
bit of them. Between chained steps the table is stored again, since each step reads it twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from courtside.operators.exact import Split
from courtside.session import store

#: Largest group a single window task is given.
MAX_GROUP_ROWS = 4_000_000
_PART, _GHOST, _RN, _UNTIL = "_part", "_ghost", "_rn", "_until"


@dataclass(frozen=True)
class Cuts:
    """Into how many parts a table is cut along keys and order; 0 leaves it whole."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    parts: int = 0


def _names(columns: str | Sequence[str]) -> tuple[str, ...]:
    return (columns,) if isinstance(columns, str) else tuple(columns)


def _largest(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows of the largest group and of the whole table."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    largest, total = sizes.agg(F.max("n"), F.sum("n")).first()
    return largest or 0, total or 0


def find_cuts(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    max_rows: int = MAX_GROUP_ROWS,
    coarse: tuple[DataFrame, Sequence[str]] | None = None,
) -> Cuts:
    """Measure the groups of ``df`` and decide whether it has to be cut.

    Runs one count per group (pre-aggregated before its shuffle, only the key columns are read).
    Without keys the table is one group, which is cut whatever its size.
    Pass the result on to several operators over the same keys and order to measure once. Where
    ``df`` is costly to compute, ``coarse`` names a cheaper table and keys whose groups are at
    least as large: if those are small enough, ``df`` itself is not touched.
    """
    keys, order = _names(keys), _names(order)
    if keys and coarse is not None and _largest(*coarse)[0] <= max_rows:
        return Cuts(keys, order)
    largest, total = _largest(df, keys)
    if keys and largest <= max_rows:
        return Cuts(keys, order)
    return Cuts(keys, order, max(2, -(-2 * total // max_rows)))


def _matching(keys: Sequence[str]) -> list[Column]:
    """Keys equal those of the other side (``_r_`` columns), a missing key matching a missing one."""
    return [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]


def _renamed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_r_{k}" for k in keys})


@dataclass(frozen=True)
class Ordered:
    """A table with its group keys, order and, where it is cut, the groups that cross borders."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    crossing: DataFrame | None = None
    split: bool = False
    stored: bool = True

    @property
    def window(self) -> WindowSpec:
        parts = (_PART,) if self.split else ()
        return Window.partitionBy(*self.keys, *parts).orderBy(*self.order)

    def rows(
        self, build: Callable[[WindowSpec], Mapping[str, Column]], back: int = 0, ahead: int = 0
    ) -> "Ordered":
        """Add the columns ``build(window)`` whose frames reach ``back`` rows back, ``ahead`` ahead."""
        if not self.split:
            return replace(self, df=self.df.withColumns(dict(build(self.window))))
        self = self._stored()
        merged = self.df.withColumn(_GHOST, F.lit(False))
        for copies in (self._copies(back, forward=True), self._copies(ahead, forward=False)):
            if copies is not None:
                merged = merged.unionByName(copies.withColumn(_GHOST, F.lit(True)))
        result = merged.withColumns(dict(build(self.window))).where(~F.col(_GHOST)).drop(_GHOST)
        return replace(self, df=result, stored=False)

    def _copies(self, reach: int, forward: bool) -> DataFrame | None:
        """Rows that frames of ``reach`` rows need in parts other than their own.

        The last (first) ``reach`` rows of every part are enough to choose from. Such a row goes to
        each later (earlier) part up to the one that holds the ``reach``-th of these rows after it.
        """
        if not reach:
            return None
        near, far = (F.desc_nulls_last, F.asc_nulls_first) if forward else (F.asc_nulls_first, F.desc_nulls_last)
        rank = F.row_number().over(Window.partitionBy(*self.keys, _PART).orderBy(*map(near, self.order)))
        edge = self._crossing_rows().withColumn(_RN, rank).where(F.col(_RN) <= reach).drop(_RN)
        group = Window.partitionBy(*self.keys)
        end = (F.max if forward else F.min)(_PART).over(group)
        until = F.coalesce(F.lead(_PART, reach).over(group.orderBy(*map(far, self.order))), end)
        step = 1 if forward else -1
        wanted = edge.withColumn(_UNTIL, until).where(F.col(_UNTIL) != F.col(_PART))
        parts = F.explode(F.sequence(F.col(_PART) + step, F.col(_UNTIL), F.lit(step)))
        return wanted.withColumn(_PART, parts).drop(_UNTIL)

    def _crossing_rows(self) -> DataFrame:
        if not self.keys:
            return self.df
        return self.df.join(_renamed(self.crossing, self.keys), _matching(self.keys), "left_semi")

    def running(self, totals: Mapping[str, Column | str], include_current: bool = True) -> "Ordered":
        """Add running sums from the start of the group up to (or just before) each row.

        Doubles are summed exactly, so that cutting a group changes no bit of them (``exact``).
        """
        self = self._stored()
        columns = {out: F.col(value) if isinstance(value, str) else value for out, value in totals.items()}
        split = Split.of(self.df, columns)
        done = self._running(split.whole, include_current)
        return replace(done, df=split.merged(done.df))

    def _running(self, columns: Mapping[str, Column], include_current: bool) -> "Ordered":
        """Running sums of whole numbers and decimals."""
        frame = self.window.rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
        inner = self.df.withColumns({out: F.sum(value).over(frame) for out, value in columns.items()})
        if not self.split:
            return replace(self, df=inner)
        per_part = self._per_part([F.sum(value).alias(f"_c_{out}") for out, value in columns.items()])
        before = Window.partitionBy(*self.keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
        carry = per_part.withColumns({f"_c_{o}": F.sum(f"_c_{o}").over(before) for o in columns})
        joined = self._attach(inner, carry)
        merged = {o: F.coalesce(F.col(f"_c_{o}") + F.col(o), F.col(f"_c_{o}"), F.col(o)) for o in columns}
        return replace(self, df=joined.withColumns(merged).drop(*[f"_c_{o}" for o in columns]), stored=False)

    def fill(self, columns: Mapping[str, str], backward: bool = False) -> "Ordered":
        """Add ``{out: column}`` filled with the last value present so far in the group.

        With ``backward`` the rows before the first value take that first value.
        """
        self = self._stored()
        before = self.window.rowsBetween(Window.unboundedPreceding, 0)
        whole = self.window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        inner = self.df.withColumns({o: F.last(c, ignorenulls=True).over(before) for o, c in columns.items()})
        if backward:
            inner = inner.withColumns(
                {f"_f_{o}": F.first(c, ignorenulls=True).over(whole) for o, c in columns.items()}
            )
        chain = {o: [F.col(o)] + ([F.col(f"_f_{o}")] if backward else []) for o in columns}
        if self.split:
            row = F.struct(*self.order)
            present = {o: F.when(F.col(c).isNotNull(), row) for o, c in columns.items()}
            per_part = self._per_part(
                [F.max_by(c, present[o]).alias(f"_l_{o}") for o, c in columns.items()]
                + [F.min_by(c, present[o]).alias(f"_g_{o}") for o, c in columns.items()]
            )
            parts = Window.partitionBy(*self.keys).orderBy(_PART)
            earlier = parts.rowsBetween(Window.unboundedPreceding, -1)
            group = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            carry = per_part.withColumns(
                {f"_l_{o}": F.last(f"_l_{o}", ignorenulls=True).over(earlier) for o in columns}
                | {f"_g_{o}": F.first(f"_g_{o}", ignorenulls=True).over(group) for o in columns}
            )
            inner = self._attach(inner, carry)
            chain = {
                o: [F.col(o), F.col(f"_l_{o}")]
                + ([F.col(f"_g_{o}"), F.col(f"_f_{o}")] if backward else [])
                for o in columns
            }
        filled = inner.withColumns({o: F.coalesce(*options) for o, options in chain.items()})
        done = filled.drop(*[f"_{m}_{o}" for o in columns for m in "flg"])
        return replace(self, df=done, stored=not self.split)

    def _stored(self) -> "Ordered":
        return self if self.stored else replace(self, df=store(self.df), stored=True)

    def _per_part(self, aggregates: Sequence[Column]) -> DataFrame:
        return self._crossing_rows().groupBy(*self.keys, _PART).agg(*aggregates)

    def _attach(self, df: DataFrame, per_part: DataFrame) -> DataFrame:
        keys = (*self.keys, _PART)
        return df.join(_renamed(per_part, keys), _matching(keys), "left").drop(*[f"_r_{k}" for k in keys])

    def done(self) -> DataFrame:
        return self.df.drop(_PART) if self.split else self.df


def ordered(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    cuts: Cuts | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> Ordered:
    """Prepare ``df`` for ordered work by ``keys`` along ``order`` (unique within a group)."""
    keys, order = _names(keys), _names(order)
    if cuts is None:
        cuts = find_cuts(df, keys, order, max_rows)
    if cuts.keys != keys or cuts.order != order:
        raise ValueError(f"cuts were made for {cuts.keys} along {cuts.order}")
    if not cuts.parts:
        return Ordered(df, keys, order)
    ranged = df.repartitionByRange(cuts.parts, *keys, *order)
    df = store(ranged.withColumn(_PART, F.spark_partition_id()))
    spans = df.groupBy(*keys).agg(F.min(_PART).alias("_lo"), F.max(_PART).alias("_hi"))
    crossing = store(spans.where("_lo < _hi").select(*keys)) if keys else None
    return Ordered(df, keys, order, crossing, split=True)
