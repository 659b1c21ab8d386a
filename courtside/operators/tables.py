"""Whole-table operators: union, defaults, de-duplication, fills, dimension joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from courtside.operators.ordered import Cuts, _names, ordered


def union_all(*frames: DataFrame) -> DataFrame:
    """Stack tables by column name; a column a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_defaults(df: DataFrame, defaults: Mapping[str, Column | float | str | None]) -> DataFrame:
    """Add the listed columns the table does not have."""
    missing = {
        name: value if isinstance(value, Column) else F.lit(value)
        for name, value in defaults.items()
        if name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def new_only(df: DataFrame, done: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key has not been ingested yet."""
    on = list(_names(on))
    return df.join(done.select(*on).distinct(), on, "left_anti")


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Distinct ids in numeric order."""
    return df.select(column).distinct().orderBy(F.col(column).try_cast("bigint"), column)


def fill_along(
    df: DataFrame,
    columns: str | Sequence[str],
    order: str | Sequence[str],
    keys: str | Sequence[str] = (),
    drop_missing: bool = True,
    cuts: Cuts | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Fill gaps with the previous value in row order, leading gaps with the first value.

    Rows of a group without any value are dropped. Without ``keys`` the whole table is one
    group, which is always worked on in parts.
    """
    columns = _names(columns)
    options = {} if max_rows is None else {"max_rows": max_rows}
    work = ordered(df, keys, order, cuts, **options).fill({c: c for c in columns}, backward=True)
    filled = work.done()
    return filled.dropna(subset=list(columns)) if drop_missing else filled


def fill_dates(df: DataFrame, date: str = "date", order: str = "seq", max_rows: int | None = None) -> DataFrame:
    """Give rows without a date that of the row before them in file order, leading rows that of the first dated one.

    A table without either column, or without undated rows, is left as it is; that costs one look at
    the date column. Rows stay undated where no row has a date.
    """
    if date not in df.columns or order not in df.columns or df.where(F.col(date).isNull()).isEmpty():
        return df
    return fill_along(df, date, order, drop_missing=False, max_rows=max_rows)


def fill_numeric(df: DataFrame, value: float = 0, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace null and NaN in numeric columns."""
    numeric = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and (columns is None or f.name in columns)
    ]
    return df.fillna(value, subset=numeric) if numeric else df


def nan_to_null(df: DataFrame) -> DataFrame:
    """Make every NaN a null, so that aggregates skip it."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floating}) if floating else df


def attach_dim(df: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join of attributes by key. Whether ``dim`` is broadcast is left to its measured size."""
    return df.join(dim, list(_names(on)), "left")
