"""Trained models by version: a folder of models and, written last, a row of the manifest.

A version without its manifest row does not exist for readers, so a training run that is lost half way
leaves the version before it in use. A version that is published again replaces itself.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from courtside.plans.training import TwoStage
from courtside.sources.sinks import append_batch

MANIFEST = (
    "minutes_features array<string>, rate_features array<string>, stats map<string,double>, "
    "minutes_importances map<string,double>, rate_importances map<string,double>, minutes_rounds int, rate_rounds int"
)


def _weights(model: PipelineModel, features: list[str]) -> dict[str, float]:
    return dict(zip(features, model.stages[-1].featureImportances.toArray().tolist()))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per published version with features, statistics, importances and rounds."""
    schema = f"{MANIFEST}, version int"
    try:
        return spark.read.schema(schema).parquet(f"{path}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def latest(spark: SparkSession, path: str) -> int | None:
    return manifest(spark, path).agg(F.max("version").alias("version")).first().version


def publish(spark: SparkSession, models: TwoStage, path: str, version: int | None = None) -> int:
    """Write the models as ``version`` (by default the one after the latest) and return its number."""
    if version is None:
        version = (latest(spark, path) or 0) + 1
    for name in ("minutes", "rate"):
        getattr(models, name).write().overwrite().save(f"{path}/models/{version}/{name}")
    row = (
        models.minutes_features,
        models.rate_features,
        {k: float(v) for k, v in models.stats.items() if v is not None},
        _weights(models.minutes, models.minutes_features),
        _weights(models.rate, models.rate_features),
        models.minutes.stages[-1].getNumTrees,
        models.rate.stages[-1].getNumTrees,
    )
    append_batch(spark.createDataFrame([row], MANIFEST), f"{path}/manifest", version, "version")
    return version


def load(spark: SparkSession, path: str, version: int | None = None) -> TwoStage:
    """The models of a version, by default of the latest; a version that was not published is an error."""
    version = latest(spark, path) if version is None else version
    row = None if version is None else manifest(spark, path).where(F.col("version") == version).first()
    if row is None:
        raise ValueError(f"no published version {version} under {path}")
    folder = f"{path}/models/{version}"
    return TwoStage(
        PipelineModel.load(f"{folder}/minutes"),
        PipelineModel.load(f"{folder}/rate"),
        row.minutes_features,
        row.rate_features,
        row.stats,
    )


def published_stats(spark: SparkSession, path: str) -> DataFrame:
    """The statistics of all versions as (version, name, value) rows."""
    return manifest(spark, path).select("version", F.explode("stats").alias("name", "value"))


def published_importances(spark: SparkSession, path: str) -> DataFrame:
    """The importances of all versions as (version, model, feature, importance) rows."""
    by_model = [
        manifest(spark, path).select("version", F.lit(m).alias("model"), F.explode(f"{m}_importances").alias("feature", "importance"))
        for m in ("minutes", "rate")
    ]
    return by_model[0].unionByName(by_model[1])
