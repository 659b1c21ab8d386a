"""Ingest of landed documents, sinks that are written twice, and published models, read back as queries.

What these queries write goes to a new folder under the checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from courtside.catalog.base import HISTORY_SQL, Tables, day_text, history, query, r6
from courtside.catalog.flattening import raw_documents
from courtside.plans import registry
from courtside.plans.training import Boosting, recent_features, train_two_stage
from courtside.session import ensure_checkpoint_dir, store
from courtside.sources.files import read_delimited, write_table
from courtside.sources.sinks import append_batch, overwrite_partitions
from courtside.streaming.ingest import LANDING_SCHEMA, ingest_batch, ingest_stream, ingested


def _new_folder(t: Tables, name: str) -> str:
    return f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- documents that land in two runs, some broken, some twice ------------------------------

_PAGE = """concat('<h2>Tip off</h2><p>', match_id % 28 + 1, '/', match_id % 12 + 1, '/2003</p>')"""


def _landings(t: Tables) -> tuple[DataFrame, DataFrame]:
    """First all but every tenth match, those ending in 3 and 9 broken and those in 5 twice; then the
    missing ones, those in 3 whole, and those in 4 once more with another date."""
    docs = store(raw_documents(t)).withColumns({"html": F.expr(_PAGE), "digit": F.expr("match_id % 10")})
    first = docs.where("digit <> 7").withColumn("json", F.expr("IF(digit IN (3, 9), left(json, 60), json)"))
    again = F.expr("IF(digit = 4, '<h2>Tip off</h2>1/1/1999', html)")
    second = docs.where("digit IN (3, 4, 7)").withColumn("html", again)
    return first.unionByName(docs.where("digit = 5")).drop("digit"), second.drop("digit")


@query(
    "ingest_new_matches",
    """WITH m AS (SELECT o_orderkey AS k, concat('2003-', lpad(CAST(o_orderkey % 12 + 1 AS VARCHAR), 2, '0'), '-',
          lpad(CAST(o_orderkey % 28 + 1 AS VARCHAR), 2, '0')) AS day FROM orders)
        SELECT k AS match_id, 'ingested' AS status, day AS date, 6::BIGINT AS n_players, 7::BIGINT AS n_events, 6::BIGINT AS n_shots,
          CAST((SELECT sum((k * p + t) % 30) FROM range(1, 3) AS a(t), range(1, 4) AS b(p)) AS BIGINT) AS points
        FROM m WHERE k % 10 <> 9
        UNION ALL SELECT k, 'rejected', NULL, 0, 0, 0, 0 FROM m WHERE k % 10 IN (3, 9)""",
)
def ingest_new_matches(t: Tables) -> DataFrame:
    """What two runs of the ingest stream and a replay of the last batch leave: each match once."""
    folder = _new_folder(t, "ingest")
    landing, out, checkpoint = (f"{folder}/{name}" for name in ("landing", "out", "checkpoint"))
    parts = _landings(t)
    for part in parts:
        part.write.mode("append").json(landing)
        ingest_stream(t.spark, landing, out, checkpoint).awaitTermination()
    # A driver lost before the commit would have Spark hand the last batch over again.
    last = ingested(t.spark, out).agg(F.max("batch_id").alias("n")).first().n
    replayed = t.spark.read.schema(LANDING_SCHEMA).json(landing)
    replayed = replayed.withColumns({"_file": F.col("_metadata.file_path"), "_landed": F.col("_metadata.file_modification_time")})
    kept = t.spark.read.parquet(f"{out}/rejects").where(F.col("batch_id") == last).select("_file").distinct()
    ingest_batch(_of_batch(replayed, parts[1], kept), last, out)

    table = lambda name: t.spark.read.parquet(f"{out}/{name}")
    box = table("box").groupBy("match_id").agg(
        F.min("date").alias("date"), F.count(F.lit(1)).alias("n_players"), F.sum("points").cast("bigint").alias("points")
    )
    counted = lambda name: table(name).groupBy("match_id").agg(F.count(F.lit(1)).alias(f"n_{name}"))
    whole = box.join(counted("pbp"), "match_id").join(counted("shots"), "match_id")
    done = whole.select(
        "match_id", F.lit("ingested").alias("status"), "date", "n_players", F.col("n_pbp").alias("n_events"), "n_shots", "points"
    )
    none = F.lit(0).cast("bigint")
    rejected = table("rejects").select(
        "match_id", F.lit("rejected").alias("status"), F.lit(None).cast("string").alias("date"),
        *[none.alias(c) for c in ("n_players", "n_events", "n_shots", "points")],
    )
    return done.unionByName(rejected)


# --- sinks ----------------------------------------------------------------------------------

_SINK_ROWS = ["match_id", "player", "day", "points"]
_SINK_SQL = "match_id, player, day, points"


@query(
    "sink_round_trip",
    f"""WITH {HISTORY_SQL}, h AS (SELECT *, strftime(date, '%Y-%m-%d') AS day, year(date) AS y FROM hist)
        SELECT 'partitions' AS sink, match_id, player, day, points + CASE WHEN y % 2 = 1 THEN 1 ELSE 0 END AS points FROM h
        UNION ALL SELECT 'batches', {_SINK_SQL} FROM h UNION ALL SELECT 'text', {_SINK_SQL} FROM h""",
)
def sink_round_trip(t: Tables) -> DataFrame:
    """Rows read back from partitions overwritten in part, from batches of which one was written twice, and from text files."""
    folder = _new_folder(t, "sinks")
    rows = store(history(t).select("match_id", "player", day_text("date").alias("day"), "points", F.year("date").alias("year")))
    overwrite_partitions(rows, f"{folder}/partitions", ["year"])
    changed = rows.where("year % 2 = 1").withColumn("points", F.col("points") + 1)
    for _ in range(2):
        overwrite_partitions(changed, f"{folder}/partitions", ["year"])
    for batch in (0, 1, 1):
        append_batch(rows.where(F.col("match_id") % 2 == batch), f"{folder}/batches", batch)
    write_table(rows.select(*_SINK_ROWS), f"{folder}/text", fmt="csv")
    schema = "match_id BIGINT, player BIGINT, day STRING, points BIGINT"
    read = {
        "partitions": t.spark.read.parquet(f"{folder}/partitions"),
        "batches": t.spark.read.parquet(f"{folder}/batches"),
        "text": read_delimited(t.spark, f"{folder}/text", "*.csv", schema),
    }
    parts = [df.select(F.lit(name).alias("sink"), *_SINK_ROWS) for name, df in read.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- models ---------------------------------------------------------------------------------


@query(
    "model_registry",
    f"""WITH {HISTORY_SQL}, days AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i, count(*) OVER () AS n
          FROM (SELECT DISTINCT CAST(date AS DATE) AS d FROM hist)),
        cut AS (SELECT d FROM days WHERE i = CAST(floor(n * 0.8) AS BIGINT)),
        tested AS (SELECT count(*) AS n FROM hist, cut WHERE CAST(date AS DATE) >= d)
        SELECT CAST(v AS INTEGER) AS version, n AS rows_reported, n AS rows_scored_alike, TRUE AS all_finite,
          1.0::DOUBLE AS minutes_importance, 1.0::DOUBLE AS rate_importance, CAST(10 AS INTEGER) AS rounds
        FROM tested, range(1, 3) AS r(v)""",
)
def model_registry(t: Tables) -> DataFrame:
    """Two versions of the two-stage model, published (the first twice), loaded and scored again.

    Ten rounds: what is looked at is the registry, all rounds are those of ``gbt_minutes`` and ``gbt_rate``.
    """
    path = _new_folder(t, "registry")
    rows = history(t).withColumnRenamed("minutes", "MIN_FL").withColumn("date", F.col("date").cast("date"))
    ready = store(recent_features(rows))
    few = Boosting("absolute", 4, 0.02, 10)
    models, scored = train_two_stage(ready, minutes_boosting=few, rate_boosting=few)
    for version in (1, 1, None):
        registry.publish(t.spark, models, path, version)
    kept = [c for c in scored.columns if not c.endswith("_hat")]
    alike = []
    for version in (1, 2):
        again = registry.load(t.spark, path, version).predict(scored.select(*kept, F.col("points_hat").alias("before")))
        finite = F.col("points_hat").isNotNull() & (F.abs("points_hat") < float("inf"))
        alike.append(
            again.agg(
                F.lit(version).alias("version"),
                F.count_if(F.col("points_hat") == F.col("before")).alias("rows_scored_alike"),
                F.bool_and(finite).alias("all_finite"),
            )
        )
    reported = registry.published_stats(t.spark, path).where("name = 'rows'")
    reported = reported.select("version", F.col("value").cast("bigint").alias("rows_reported"))
    weights = registry.published_importances(t.spark, path).groupBy("version").pivot("model", ["minutes", "rate"])
    weights = weights.agg(F.sum("importance")).select(
        "version", r6("minutes").alias("minutes_importance"), r6("rate").alias("rate_importance")
    )
    rounds = registry.manifest(t.spark, path).where("minutes_rounds = rate_rounds")
    rounds = rounds.select("version", F.col("minutes_rounds").alias("rounds"))
    joined = reported.join(alike[0].unionByName(alike[1]), "version").join(weights, "version").join(rounds, "version")
    return joined.select(
        "version", "rows_reported", "rows_scored_alike", "all_finite", "minutes_importance", "rate_importance", "rounds"
    )
