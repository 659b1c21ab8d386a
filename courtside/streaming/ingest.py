"""Landed match documents into the three tables, each match once.

A batch writes folders named by its number and overwrites them when Spark replays it, so a lost
driver or executor leaves neither gaps nor doubles. Matches already in an earlier batch are
skipped; within a batch the first readable copy of a match counts.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from courtside.functions.markup import html_text, labelled_date
from courtside.operators.tables import new_only
from courtside.session import store
from courtside.sources.documents import box_rows, document, pbp_rows, shot_rows

#: A landed record: match id, document text, page text.
LANDING_SCHEMA = "match_id BIGINT, json STRING, html STRING"
TABLES = ("pbp", "shots", "box")


def _batch_path(out: str, table: str, batch: int) -> str:
    return f"{out}/{table}/batch_id={batch}"


def ingested(spark: SparkSession, out: str, before: int | None = None) -> DataFrame | None:
    """Ids of the matches ingested so far (by batches numbered below ``before``)."""
    try:
        done = spark.read.schema("match_id BIGINT, batch_id BIGINT").parquet(f"{out}/done")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return done if before is None else done.where(F.col("batch_id") < before)


def ingest_batch(batch: DataFrame, batch_id: int, out: str) -> None:
    """Flatten the new matches of one batch and write them under the batch's own folders.

    Each document is parsed once, beside the date of its page. Only a match with a readable document
    counts as done, so a copy that lands later can still make up for a broken one; records without an
    id or teams go to ``rejects``. Of several readable copies the one that landed first counts.
    """
    landed_at = F.col("_landed") if "_landed" in batch.columns else F.lit(None).cast("timestamp")
    parsed = store(
        batch.select(
            "match_id",
            "_file",
            landed_at.alias("_landed"),
            document("json").alias("doc"),
            labelled_date(html_text(F.coalesce("html", F.lit(""))), "Tip off").alias("date"),
        )
    )
    readable = F.col("match_id").isNotNull() & F.col("doc.tm").isNotNull()
    copies = parsed.where(readable).groupBy("match_id").agg(F.count(F.lit(1)).alias("_n"))
    done = ingested(batch.sparkSession, out, before=batch_id)
    copies = store(copies if done is None else new_only(copies, done, "match_id"))
    ok = parsed.where(readable)
    # Which matches are new is settled on ids alone; only those landed more than once are compared.
    single = ok.join(copies.where("_n = 1").select("match_id"), "match_id", "left_semi")
    landed_twice = ok.join(copies.where("_n > 1").select("match_id"), "match_id", "left_semi")
    first = F.min_by(F.struct("doc", "date"), F.struct(F.coalesce("_landed", F.lit(0).cast("timestamp")), "_file"))
    chosen = landed_twice.groupBy("match_id").agg(first.alias("d")).select("match_id", "d.doc", "d.date")
    raw = single.select("match_id", "doc", "date").unionByName(chosen)

    tables = {"pbp": pbp_rows(raw), "shots": shot_rows(raw), "box": box_rows(raw)}
    for name in TABLES:
        tables[name].write.mode("overwrite").parquet(_batch_path(out, name, batch_id))
    rejects = parsed.where(~readable).select("match_id", "_file")
    rejects.write.mode("overwrite").parquet(_batch_path(out, "rejects", batch_id))
    copies.select("match_id").write.mode("overwrite").parquet(_batch_path(out, "done", batch_id))


def ingest_stream(
    spark: SparkSession, landing: str, out: str, checkpoint: str, batch_bytes: int = 64 << 30
) -> StreamingQuery:
    """Ingest everything that landed since the last run, then stop.

    ``checkpoint`` is a shared folder that holds the stream's progress between runs. A backlog is
    worked off in batches of about ``batch_bytes``.
    """
    landed = spark.readStream.schema(LANDING_SCHEMA).option("maxBytesPerTrigger", batch_bytes).json(landing)
    landed = landed.withColumns({"_file": F.col("_metadata.file_path"), "_landed": F.col("_metadata.file_modification_time")})
    return (
        landed.writeStream.foreachBatch(lambda df, number: ingest_batch(df, number, out))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
