"""Sums of doubles that do not depend on the order of adding.

A double is cut by its binary places into bins of whole numbers, each bin 24 places wide. Whole
numbers add up exactly in any order and in any grouping, so bins are summed, carried over parts and
merged like counts, and only the finished sums are put together to a double again. Which bins there are
follows from the largest and smallest magnitude in the data, so that usual data need two to four.
Nothing is rounded before the end and no value is left out, however large or small.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Binary places of a bin: sums of up to 2^39 rows fit a long.
PLACES = 24
#: Binary places of a double's fraction, and the lowest place of any double.
FRACTION, LOWEST = 53, -1074
#: Sums of values that are not finite, kept apart as counts.
SPECIAL = {"nan": lambda v: F.isnan(v), "up": lambda v: v == float("inf"), "down": lambda v: v == float("-inf")}


@dataclass(frozen=True)
class Bins:
    """How the values of one column are cut: the lowest place of each bin, from the highest bin down."""

    places: tuple[int, ...] = (0,)
    special: bool = False

    @classmethod
    def between(cls, least: float | None, most: float | None, special: bool = False) -> "Bins":
        """Bins for magnitudes from ``least`` (above zero) to ``most``; without either all values are zero."""
        if not most:
            return cls(special=special)
        top = math.frexp(most)[1]
        lowest = max(LOWEST, math.frexp(least)[1] - FRACTION)
        count = -(-(top - lowest) // PLACES)
        return cls(tuple(max(LOWEST, top - PLACES * (i + 1)) for i in range(count)), special)

    def parts(self, value: Column) -> dict[str, Column]:
        """Whole numbers to be summed, by name; all are null for a null value."""
        value = value.cast("double")
        finite = F.when(F.isnan(value) | (F.abs(value) == float("inf")), 0.0).otherwise(value) if self.special else value
        parts, above = {}, None
        for at, place in enumerate(self.places):
            # The remainder and the division by a power of two are exact.
            rest = finite if above is None else finite % F.lit(math.ldexp(1.0, above))
            parts[str(at)] = (rest / F.lit(math.ldexp(1.0, place))).cast("bigint")
            above = place
        if self.special:
            parts |= {name: F.when(value.isNotNull(), test(value).cast("bigint")) for name, test in SPECIAL.items()}
        return parts

    def total(self, sums: Mapping[str, Column]) -> Column:
        """The double that the sums of the parts stand for; null where they are."""
        # From the highest bin down, as bins of opposite signs then cancel before anything is rounded.
        total = None
        for at, place in enumerate(self.places):
            term = sums[str(at)].cast("double") * F.lit(math.ldexp(1.0, place))
            total = term if total is None else total + term
        if not self.special:
            return total
        nan, up, down = (sums[name] > 0 for name in SPECIAL)
        return F.when(nan | (up & down), float("nan")).when(up, float("inf")).when(down, float("-inf")).otherwise(total)


def is_inexact(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DoubleType, T.FloatType))


def find_bins(df: DataFrame, columns: Mapping[str, Column]) -> dict[str, Bins]:
    """Bins of each named column of doubles, from one pass over the table; whole numbers get none."""
    kinds = {f.name: f.dataType for f in df.select(*[c.alias(o) for o, c in columns.items()]).schema}
    names = [o for o in columns if is_inexact(kinds[o])]
    if not names:
        return {}
    size = {o: F.abs(columns[o].cast("double")) for o in names}
    infinite = {o: F.isnan(size[o]) | (size[o] == float("inf")) for o in names}
    found = df.agg(
        *[F.min(F.when((size[o] > 0) & ~infinite[o], size[o])).alias(f"l{i}") for i, o in enumerate(names)],
        *[F.max(F.when(~infinite[o], size[o])).alias(f"m{i}") for i, o in enumerate(names)],
        *[F.coalesce(F.bool_or(infinite[o]), F.lit(False)).alias(f"s{i}") for i, o in enumerate(names)],
    ).first()
    return {o: Bins.between(found[f"l{i}"], found[f"m{i}"], found[f"s{i}"]) for i, o in enumerate(names)}


@dataclass(frozen=True)
class Split:
    """Columns to be summed, the doubles among them as parts under names of their own."""

    whole: dict[str, Column]
    bins: dict[str, Bins]

    @classmethod
    def of(cls, df: DataFrame, columns: Mapping[str, Column]) -> "Split":
        bins = find_bins(df, columns)
        whole = {o: c for o, c in columns.items() if o not in bins}
        for o, found in bins.items():
            whole |= {f"_bin_{o}_{name}": part for name, part in found.parts(columns[o]).items()}
        return cls(whole, bins)

    def names(self, out: str) -> dict[str, str]:
        found = self.bins[out]
        return {k: f"_bin_{out}_{k}" for k in [*map(str, range(len(found.places))), *(SPECIAL if found.special else ())]}

    def merged(self, df: DataFrame) -> DataFrame:
        """The sums of the parts put together under the names of their columns."""
        sums = {o: found.total({k: F.col(name) for k, name in self.names(o).items()}) for o, found in self.bins.items()}
        return df.withColumns(sums).drop(*[n for o in self.bins for n in self.names(o).values()])


def exact_sums(df: DataFrame, keys: list[str], columns: Mapping[str, Column], others: Sequence[Column] = ()) -> DataFrame:
    """``groupBy(keys)`` with the exact sum of each named column, and ``others`` (aliased aggregates) beside them."""
    split = Split.of(df, columns)
    grouped = df.groupBy(*keys).agg(*[F.sum(c).alias(o) for o, c in split.whole.items()], *others)
    return split.merged(grouped)
