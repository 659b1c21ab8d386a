"""Delimited tables, id lists and scalar maps in; tables out."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegralType, StringType, StructType

from courtside.functions.cleaning import ColumnLike, as_column, minutes_of, to_date_safe, whole_number
from courtside.operators.event_log import order_events
from courtside.operators.tables import nan_to_null, union_all

#: Columns of the three ingested tables, in file order.
BOX_SCHEMA = (
    "match_id BIGINT, date STRING, team STRING, player STRING, jersey STRING, starter INT, minutes STRING, "
    "points BIGINT, rebounds BIGINT, assists BIGINT, fouls BIGINT, turnovers BIGINT, steals BIGINT, "
    "blocks BIGINT, plus_minus BIGINT, efficiency BIGINT"
)
PBP_SCHEMA = (
    "match_id BIGINT, period INT, clock STRING, gt STRING, team STRING, player STRING, action_type STRING, "
    "sub_type STRING, success INT, score_home BIGINT, score_away BIGINT"
)
SHOT_SCHEMA = (
    "match_id BIGINT, team STRING, player STRING, action STRING, sub_type STRING, x DOUBLE, y DOUBLE, "
    "result STRING, period INT, time STRING"
)

#: Type of ``seq``.
_SEQ = "struct<file:bigint,block:bigint,row:bigint>"


def read_delimited(
    spark: SparkSession,
    root: str,
    pattern: str,
    schema: StructType | str | None = None,
    sep: str = ";",
    file_order: bool = False,
) -> DataFrame:
    """All files under ``root`` (at any depth) whose name matches ``pattern``, by the names in their headers.

    Give a schema: without one Spark reads every file once more to infer it. With one, files may
    differ in the columns they have and in their order: files with the same header are read together,
    columns outside the schema are left out and absent ones are null. Values are read as text and
    converted, so ``2.0`` fills a whole-number column and unreadable text becomes null.
    ``file_order`` adds ``seq``, see ``with_file_order``.
    """
    reader = spark.read.option("sep", sep).option("header", True)
    matching = reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    if schema is None:
        read = matching.option("inferSchema", True).csv(root)
        return with_file_order(read) if file_order else read
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    layouts = _layouts(spark, root, pattern, wanted, sep)
    if not layouts:
        empty = spark.createDataFrame([], wanted)
        return empty.withColumn("seq", F.lit(None).cast(_SEQ)) if file_order else empty
    frames = []
    for header, paths in sorted(layouts.items()):
        names = [f"_{i}" for i in range(len(header))]
        text = ", ".join(f"{n} STRING" for n in names)
        read = reader.option("enforceSchema", True).schema(text).csv(paths)
        read = with_file_order(read) if file_order else read
        place = {column: name for name, column in reversed(list(zip(names, header)))}
        columns = [_converted(place[f.name], f) for f in wanted if f.name in place]
        frames.append(read.select(*columns, *(["seq"] if file_order else [])))
    order = [f.name for f in wanted] + (["seq"] if file_order else [])
    merged = union_all(*frames)
    absent = {f.name: F.lit(None).cast(f.dataType) for f in wanted if f.name not in merged.columns}
    return merged.withColumns(absent).select(*order) if absent else merged.select(*order)


def _converted(name: str, field) -> Column:
    value = F.col(name)
    if isinstance(field.dataType, StringType):
        return value.alias(field.name)
    if isinstance(field.dataType, IntegralType):
        return whole_number(value, field.dataType.simpleString()).alias(field.name)
    return value.try_cast(field.dataType).alias(field.name)


def _layouts(spark: SparkSession, root: str, pattern: str, schema: StructType, sep: str) -> dict[tuple[str, ...], list[str]]:
    """Files by header. A header is the first line of a file, the one that names a column of the schema.

    What comes to the driver is one line per file, as many as there are files to list anyway.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root)
    named = F.lit(False)
    for f in schema:
        named |= F.array_contains(F.split("value", sep, -1), f.name)
    first = lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.regexp_replace("value", "^\\uFEFF|\\r$|\"", "").alias("value"),
        F.monotonically_increasing_id().alias("row"),
    )
    heads = first.where((F.col("block") == 0) & named).groupBy("path").agg(F.min(F.struct("row", "value")).alias("head"))
    found = defaultdict(list)
    for r in heads.select("path", "head.value").collect():
        found[tuple(c.strip() for c in r.value.split(sep))].append(unquote(r.path))
    return {header: sorted(paths) for header, paths in found.items()}


def _tidy(df: DataFrame) -> DataFrame:
    lowered = {c: F.btrim(F.lower(c)) for c in ("player", "team") if c in df.columns}
    return df.withColumns(lowered) if lowered else df


def box_table(raw: DataFrame) -> DataFrame:
    """Box score with names tidied, the date parsed and minutes as a number."""
    return _tidy(raw).withColumns({"MIN_FL": minutes_of("minutes"), "date": to_date_safe("date")})


def pbp_table(raw: DataFrame) -> DataFrame:
    """Play-by-play with names tidied and its order columns; ``seq`` is the place in the feed."""
    return order_events(_tidy(raw))


def with_file_order(read: DataFrame) -> DataFrame:
    """Add ``seq``, which orders the rows of each file as they stand in it.

    Rows of one file stand together, in any order of the files. A large file is read in blocks by
    several tasks: the block's offset comes first, then the row's place within its task.
    """
    place = F.struct(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return read.withColumn("seq", place)


def shot_table(raw: DataFrame) -> DataFrame:
    return nan_to_null(_tidy(raw))


def read_season(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The box, play-by-play and shot tables found under ``root``, ready for feature building.

    Box and play-by-play carry ``seq``, their file order, by which undated rows are dated later.
    """
    return (
        box_table(read_delimited(spark, root, "*box_score*.csv", BOX_SCHEMA, file_order=True)),
        pbp_table(read_delimited(spark, root, "*pbp*.csv", PBP_SCHEMA, file_order=True)),
        shot_table(read_delimited(spark, root, "*shots*.csv", SHOT_SCHEMA)),
    )


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    rows_per_file: int = 5_000_000,
) -> None:
    """Write (or append to) a table; ``fmt='csv'`` writes ``;``-separated files with headers."""
    writer = df.write.mode(mode).option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("sep", ";").option("header", True)
    writer.format(fmt).save(path)


def id_list(text: ColumnLike) -> Column:
    """Ids in the text of one id file: line 1 is a folder, line 2 blank, the rest comma separated.

    Pieces that are not all digits are dropped.
    """
    lines = F.transform(F.split(as_column(text), "\n"), lambda line: F.trim(F.replace(line, F.lit("\r"))))
    pieces = F.split(F.array_join(F.slice(lines, F.lit(3), F.size(lines)), ""), ",")
    return F.filter(F.transform(pieces, lambda piece: F.trim(piece)), lambda piece: piece.rlike("^[0-9]+$"))


def parse_id_list(df: DataFrame, text: str = "value", out: str = "match_id") -> DataFrame:
    """One row per id of every id file in ``df`` (one file text per row); ids too long to hold are dropped."""
    return df.select(F.explode(id_list(text)).alias(out)).select(F.col(out).try_cast("bigint")).dropna()


def scalar_map(df: DataFrame, text: str, key: str, value: str) -> DataFrame:
    """One row per entry of JSON objects ``{name: number}``; NaN becomes null."""
    entries = F.from_json(text, "map<string,double>")
    kept = [c for c in df.columns if c != text]
    return nan_to_null(df.select(*kept, F.explode(entries).alias(key, value)))


def load_scalar_map(spark: SparkSession, path: str, key: str = "player", value: str = "value") -> DataFrame:
    """The entries of a JSON file holding one object of names to numbers."""
    return scalar_map(spark.read.text(path, wholetext=True), "value", key, value)
