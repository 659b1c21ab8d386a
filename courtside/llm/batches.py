"""Shared shape of the operators that work text by text in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rows a Python step holds as objects at a time.
SLICE_ROWS = 500


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of at most ``rows`` rows, without empty ones."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts(column: pa.Array) -> list[str]:
    """Texts of a column, null as empty."""
    return [t or "" for t in column.to_pylist()]


def per_text(
    docs: DataFrame, columns: list[str], make: Callable[[], Callable[..., tuple]], schema: str, rows: int = SLICE_ROWS
) -> DataFrame:
    """One output row for each input row, computed from whole texts.

    ``columns`` are read (the last is the text, null read as empty), the ones before it are passed
    on unchanged; ``make`` runs once per task and returns a function from a list of texts to the
    lists of the output columns named in ``schema``. Rows keep their number whatever repeats.
    """
    keep = [f"c{i}" for i in range(len(columns) - 1)]
    data = docs.select(*[F.col(c).alias(k) for c, k in zip(columns, keep)], F.col(columns[-1]).cast("string").alias("text"))
    head = ", ".join(f"{k} {data.schema[k].dataType.simpleString()}" for k in keep)
    out = f"{head}, {schema}" if head else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, names, types = None, None, None
        for batch in slices(batches, rows):
            work = work or make()
            found = work(texts(batch.column(len(keep))))
            if names is None:
                names = [part.split()[0] for part in schema.split(", ")]
                types = [ARROW[part.split()[1]] for part in schema.split(", ")]
            made = [pa.array(values, kind) for values, kind in zip(found, types)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], names=[*keep, *names])

    return data.mapInArrow(run, out).withColumnsRenamed(dict(zip(keep, columns[:-1])))


#: Arrow types of the column types that the steps return.
ARROW = {
    "int": pa.int32(),
    "long": pa.int64(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()),
}
