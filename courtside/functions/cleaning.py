"""Lenient parsing of times, dates and numbers, and the three zero-denominator rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def minutes_of(text: ColumnLike) -> Column:
    """``MM:SS`` to minutes; only the first two fields count, anything unreadable is 0.0."""
    fields = F.split(as_column(text), ":")
    minutes = F.get(fields, F.lit(0)).try_cast("bigint")
    seconds = F.get(fields, F.lit(1)).try_cast("bigint")
    return F.coalesce(minutes + seconds / F.lit(60), F.lit(0.0))


def minutes_lenient(text: ColumnLike) -> Column:
    """``MM:SS`` with exactly two whole fields, else 0.0; without a colon a plain number.

    A missing value is 0.0; text that is no number and has no colon gives null.
    """
    text = as_column(text)
    fields = F.split(text, ":")
    pair = (
        F.get(fields, F.lit(0)).try_cast("bigint")
        + F.get(fields, F.lit(1)).try_cast("bigint") / F.lit(60)
    )
    return (
        F.when(text.isNull(), F.lit(0.0))
        .when(
            text.contains(":"),
            F.coalesce(F.when(F.size(fields) == 2, pair), F.lit(0.0)),
        )
        .otherwise(text.try_cast("double"))
    )


def clock_seconds(text: ColumnLike) -> Column:
    """``MM:SS[:cc]`` to seconds (hundredths ignored); one field is read as seconds; else 0.0."""
    text = as_column(text)
    fields = F.split(text, ":")
    pair = F.get(fields, F.lit(0)).try_cast("bigint") * 60 + F.get(fields, F.lit(1)).try_cast("double")
    return F.coalesce(
        F.when(F.size(fields) >= 2, pair).otherwise(text.try_cast("double")), F.lit(0.0)
    )


def to_date_safe(text: ColumnLike, fmt: str = "yyyy-MM-dd") -> Column:
    """Parse a date; an unreadable one is null instead of an error."""
    return F.try_to_date(as_column(text), fmt)


def to_num(value: ColumnLike, default: float = 0.0) -> Column:
    """Coerce to double; an unreadable or missing number becomes ``default``."""
    number = as_column(value).try_cast("double")
    return F.coalesce(F.nanvl(number, F.lit(None).cast("double")), F.lit(float(default)))


def whole_number(text: ColumnLike, kind: str = "bigint") -> Column:
    """Text to a whole number; ``2`` and ``2.0`` are the same, anything else is null."""
    text = as_column(text)
    number = text.try_cast("double")
    return F.coalesce(text.try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))


def ratio_zero_one(num: ColumnLike, den: ColumnLike) -> Column:
    """``num / den`` where a denominator of exactly zero counts as one."""
    den = as_column(den)
    return as_column(num) / F.when(den == 0, F.lit(1)).otherwise(den)


def ratio_floor_one(num: ColumnLike, den: ColumnLike) -> Column:
    """``num / max(den, 1)``; a missing denominator gives null."""
    den = as_column(den)
    return as_column(num) / F.when(den < 1, F.lit(1)).otherwise(den)


def ratio_or_zero(num: ColumnLike, den: ColumnLike) -> Column:
    """``num / den`` where a zero denominator gives 0.0."""
    den = as_column(den)
    return F.when(den == 0, F.lit(0.0)).otherwise(as_column(num) / F.nullif(den, F.lit(0)))
