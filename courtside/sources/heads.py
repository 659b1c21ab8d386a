"""First lines of files, read in the tasks by ranged reads: some kilobytes of a file, whatever its size."""

from __future__ import annotations

from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes asked for at a time; a first line longer than that takes several reads.
HEAD_BYTES = 16_384


def first_line(stream: BinaryIO, step: int = HEAD_BYTES) -> bytes | None:
    """The first line that is not blank, without its end; null where there is none."""
    held = b""
    while True:
        more = stream.read(step)
        lines = (held + more).split(b"\n")
        for line in lines[:-1] if more else lines:
            if line.strip(b"\xef\xbb\xbf \t\r"):
                return line
        if not more:
            return None
        held = lines[-1]


def _open(path: str) -> BinaryIO:
    """The file unpacked by its extension. The schemes are those that Arrow knows, ``s3a`` among them."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_stream("/" + rest.lstrip("/"))
    files, name = fs.FileSystem.from_uri(quote(path.replace("s3a:", "s3:", 1), safe=":/@"))
    return files.open_input_stream(name)


def file_heads(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """One row per file under ``root`` whose name matches ``pattern``: ``path``, ``head``, ``opened``.

    Spark lists the files and spreads them over tasks; their content is no column of that scan. A file
    that no task could open (a scheme unknown to Arrow) has ``opened`` false and no head.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, opened = [], []
            for path in batch.column(0).to_pylist():
                try:
                    with _open(path) as stream:
                        head = first_line(stream)
                except (OSError, pa.ArrowException):
                    heads.append(None)
                    opened.append(False)
                else:
                    heads.append(None if head is None else head.decode("utf-8", "replace"))
                    opened.append(True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(heads, pa.string()), pa.array(opened, pa.bool_())],
                names=["path", "head", "opened"],
            )

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return listed.load(root).select("path").mapInArrow(run, "path string, head string, opened boolean")
