"""History features, the two boosted-tree models, their evaluation and storage."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from courtside.functions import (
    abs_over,
    code_map,
    combine,
    minutes_lenient,
    month_of,
    rate_target,
    ratio_zero_one,
    sample_weight,
    to_num,
)
from courtside.functions.labels import POSITION_DEFAULT
from courtside.operators.boosting import boost, to_model
from courtside.operators.evaluation import (
    days_cutoff,
    period_breakdown,
    rank_cutoff,
    regression_metrics,
    sigma,
    split_at,
)
from courtside.operators.ordered import MAX_GROUP_ROWS, find_cuts
from courtside.operators.rolling import blend, difference, expanding, history_features, shrunk_rate
from courtside.operators.tables import fill_dates, fill_along, fill_numeric, with_defaults
from courtside.session import store

PLAYER, ORDER = "player", ("date", "match_id")

#: Metrics with a history, and the feature lists of both model generations.
ROLLED_METRICS = (
    "MIN_FL", "points", "efficiency", "Synergy_Score", "Dependency_Index", "Gravity", "Shot_Quality_Avg",
    "GT_Activity_Index", "Q1_Activity", "Q2_Activity", "Q3_Activity", "Q4_Activity", "Clutch_Events",
)
RECENT_MINUTES_FEATURES = (
    "L1_MIN_FL", "L5_MIN_FL", "L10_MIN_FL", "Trend_MIN_FL", "Smart_MIN_Baseline", "L5_Fouls_Per_Min",
    "Fouls_Drawn", "L5_GT_Activity_Index", "Days_Rest", "Is_Home", "Opp_Avg_Pace", "Opp_Avg_Fouls", "Pos_Code",
)
RECENT_RATE_FEATURES = (
    "Def_Suppressor", "Mismatch_Adv", "Opp_Avg_Pts_Allowed", "L5_Synergy_Score", "L5_Dependency_Index",
    "L5_Gravity", "L5_Shot_Quality_Avg", "L5_Adj_PPM", "L5_Tm_PTS", "Is_Home", "Pos_Code",
)
SMOOTHED_MINUTES_FEATURES = (
    "L1_MIN_FL", "L3_MIN_FL", "L5_MIN_FL", "Trend_MIN_FL", "L1_Fouls", "Blowout_Risk", "Smart_MIN_Baseline",
    "Season_MIN_Avg", "L5_Fouls_Per_Min", "Fouls_Drawn", "L5_GT_Activity_Index", "Days_Rest", "Is_Home",
    "Opp_Avg_Pace", "Opp_Avg_Fouls", "Pos_Code", "Month", "L5_Starter_Rate", "L1_Starter", "Spread_Est",
    "Abs_Spread", "Game_Importance", "Opp_Max_Foul_Drawer", "Pace_Clash",
)
SMOOTHED_RATE_FEATURES = (
    "Smoothed_PPM", "Opp_Allowed_Pos_Avg", "Def_Suppressor", "Mismatch_Adv", "Opp_Avg_Pts_Allowed",
    "L5_Synergy_Score", "L5_Dependency_Index", "L5_Gravity", "Shot_Quality_Avg", "Pace_Est", "Size_Index",
    "Opp_Avg_Pace", "Opp_Best_Def_Synergy", "Opp_Avg_Size", "Pos_Code", "Month",
)
#: Features measured in the very match that is forecast; left out unless asked for.
SAME_MATCH_FEATURES = frozenset({"Fouls_Drawn", "Blowout_Risk", "Shot_Quality_Avg", "Pace_Est"})


@dataclass(frozen=True)
class Boosting:
    """Settings of one boosted-tree model.

    With the absolute loss each round moves a forecast by at most ``step`` units of the target,
    so ``step`` has to be small against the target's spread.
    """

    loss: str = "absolute"
    depth: int = 4
    step: float = 0.02
    rounds: int = 1000
    subsample: float = 1.0
    colsample: float = 1.0


#: The settings of the minutes and rate models of both generations.
RECENT_MINUTES = Boosting("absolute", 4, 0.02, 1000)
RECENT_RATE = Boosting("absolute", 5, 0.015, 1500)
SMOOTHED_MINUTES = Boosting("absolute", 4, 0.02, 400, 0.8, 0.8)
SMOOTHED_RATE = Boosting("squared", 3, 0.015, 300, 0.7, 0.7)
#: Fixed value: minutes below which a row does not train the smoothed rate model.
MIN_RATE_MINUTES = 3.0


def _with_position_code(df: DataFrame) -> DataFrame:
    if "Pos_Est" in df.columns:
        return df.withColumn("Pos_Code", code_map("Pos_Est"))
    return with_defaults(df, {"Pos_Code": POSITION_DEFAULT})


def recent_features(
    df: DataFrame, row_order: str | Sequence[str] | None = None, max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Recent-form features: last, last 5 and last 10 matches of every metric.

    Rows without a date get one from their neighbours first, by ``row_order`` or else by the file order
    ``seq`` that a season read from files carries; rows that are still without one are dropped.
    """
    df = fill_along(df, "date", row_order) if row_order is not None else fill_dates(df)
    df = df.where("date is not null")
    df = _with_position_code(df).withColumn("Raw_PPM", ratio_zero_one("points", "MIN_FL"))
    df = with_defaults(df, {"Season_Weight": 1.0, "fouls": 0} | {m: 0 for m in ROLLED_METRICS})
    means = {f"L{n}_{m}": (m, n, 1) for m in ROLLED_METRICS for n in (5, 10)}
    means |= {"L5_Adj_PPM": ("Raw_PPM", 5, 5), "_fouls": ("fouls", 5, 5)}
    if "Tm_PTS" in df.columns:
        means["L5_Tm_PTS"] = ("Tm_PTS", 5, 1)
    cuts = find_cuts(df, PLAYER, ORDER, max_rows)
    df = history_features(df, PLAYER, ORDER, ROLLED_METRICS, means, cuts)
    df = df.withColumns(
        {
            "Trend_MIN_FL": difference("L5_MIN_FL", "L10_MIN_FL"),
            "Smart_MIN_Baseline": blend({"L5_MIN_FL": 0.7, "L10_MIN_FL": 0.3}),
            "L5_Fouls_Per_Min": ratio_zero_one("_fouls", "L5_MIN_FL"),
        }
    )
    return fill_numeric(df.drop("_fouls"))


def smoothed_features(
    df: DataFrame,
    prior: Column | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Smoothed-rate features: minutes history, season mean and the shrunk scoring rate.

    ``prior`` is the rate players are pulled towards; without it that of the whole table.
    """
    if "minutes" in df.columns:
        df = df.withColumn("MIN_FL", minutes_lenient("minutes"))
    df = df.withColumns({"fouls": to_num("fouls"), "plus_minus": to_num("plus_minus")})
    cuts = find_cuts(df, PLAYER, ORDER, max_rows)
    means = {f"L{n}_MIN_FL": ("MIN_FL", n, 1) for n in (3, 5, 10)} | {"_fouls": ("fouls", 5, 1)}
    df = history_features(df, PLAYER, ORDER, ("MIN_FL", "fouls"), means, cuts)
    df = df.withColumnRenamed("L1_fouls", "L1_Fouls")
    df = df.fillna(0.0, ["L1_MIN_FL", "L1_Fouls", *[f"L{n}_MIN_FL" for n in (3, 5, 10)]])
    df = expanding(df, PLAYER, ORDER, "MIN_FL", ("avg",), cuts).withColumnRenamed("Hist_avg_MIN_FL", "Season_MIN_Avg")
    df = shrunk_rate(df, PLAYER, ORDER, "points", "MIN_FL", prior=prior, out="Smoothed_PPM", cuts=cuts)
    df = _with_position_code(df).withColumns(
        {
            "Trend_MIN_FL": difference("L5_MIN_FL", "L10_MIN_FL"),
            "Smart_MIN_Baseline": blend({"L3_MIN_FL": 0.5, "L5_MIN_FL": 0.3, "L10_MIN_FL": 0.2}),
            "L5_Fouls_Per_Min": ratio_zero_one("_fouls", "L5_MIN_FL"),
            "Blowout_Risk": abs_over("plus_minus"),
            "Month": month_of("date"),
        }
    )
    wanted = [*dict.fromkeys(SMOOTHED_MINUTES_FEATURES + SMOOTHED_RATE_FEATURES)]
    df = with_defaults(df.drop("_fouls"), {c: 0.0 for c in wanted})
    return df.withColumns({c: to_num(c) for c in wanted})


def present_features(df: DataFrame, wanted: Sequence[str], same_match: bool = False) -> list[str]:
    """The wanted features the table has, without those of the forecast match itself."""
    return [c for c in wanted if c in df.columns and (same_match or c not in SAME_MATCH_FEATURES)]


def fit_gbt(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    weight: str | None = None,
    boosting: Boosting = Boosting(),
    out: str = "prediction",
    seed: int = 7,
) -> PipelineModel:
    """Fit one boosted-tree model; each level of each tree is one pass over packed rows (``boosting``)."""
    assembler = VectorAssembler(inputCols=list(features), outputCol=f"_{out}_features", handleInvalid="keep")
    settings = (boosting.loss, boosting.depth, boosting.step, boosting.rounds, boosting.subsample, boosting.colsample, seed)
    trees, cuts = boost(train, features, label, weight, *settings)
    params = {
        "featuresCol": f"_{out}_features", "labelCol": label, "predictionCol": out, "lossType": boosting.loss,
        "maxDepth": boosting.depth, "stepSize": boosting.step, "maxIter": boosting.rounds, "seed": seed,
        "subsamplingRate": boosting.subsample,
        "featureSubsetStrategy": "all" if boosting.colsample >= 1 else str(boosting.colsample),
    }
    if weight is not None:
        params["weightCol"] = weight
    return PipelineModel([assembler, to_model(train.sparkSession, trees, cuts, params)])


@dataclass
class TwoStage:
    """Both models with the features they use and their errors on the test rows."""

    minutes: PipelineModel
    rate: PipelineModel
    minutes_features: list[str]
    rate_features: list[str]
    stats: dict[str, float] = field(default_factory=dict)

    def predict(self, df: DataFrame, out: str = "points_hat") -> DataFrame:
        scored = self.rate.transform(self.minutes.transform(df)).drop("_minutes_hat_features", "_rate_hat_features")
        return scored.withColumn(out, combine("minutes_hat", "rate_hat"))


def train_two_stage(
    df: DataFrame,
    generation: str = "recent",
    minutes_boosting: Boosting | None = None,
    rate_boosting: Boosting | None = None,
    same_match: bool = False,
) -> tuple[TwoStage, DataFrame]:
    """Split by time, fit minutes and rate, evaluate; returns the models and the scored test rows.

    ``recent`` splits at 80 % of the dates and trains on the output of ``recent_features``;
    ``smoothed`` tests on the last 60 days and trains on that of ``smoothed_features``.
    """
    recent = generation == "recent"
    wanted = (
        (RECENT_MINUTES_FEATURES, RECENT_RATE_FEATURES) if recent else (SMOOTHED_MINUTES_FEATURES, SMOOTHED_RATE_FEATURES)
    )
    minutes_boosting = minutes_boosting or (RECENT_MINUTES if recent else SMOOTHED_MINUTES)
    rate_boosting = rate_boosting or (RECENT_RATE if recent else SMOOTHED_RATE)
    minutes_features, rate_features = (present_features(df, names, same_match) for names in wanted)

    keep = {*minutes_features, *rate_features, "Raw_PPM", "Season_Weight"} & set(df.columns)
    periods = [c for c in (f"L5_Q{q}_Activity" for q in (1, 2, 3, 4)) if c in df.columns]
    ids = [c for c in ("match_id", "team", "opponent") if c in df.columns]
    slim = df.select(PLAYER, *ids, "date", "points", "MIN_FL", *sorted(keep | set(periods)))
    # Both fits and the evaluation read this; boosting passes over it many times.
    slim = store(with_defaults(slim, {"Season_Weight": 1.0}))
    cutoff = rank_cutoff(slim, "date") if recent else days_cutoff(slim, "date")
    train, test = split_at(slim, "date", cutoff)

    if recent:
        minutes_weight, rate_weight = "Season_Weight", "_w"
        train = train.withColumns({"_w": sample_weight("MIN_FL", "Season_Weight"), "_rate": ratio_zero_one("points", "MIN_FL")})
        rate_train = train
    else:
        minutes_weight = rate_weight = None
        train = train.withColumn("_rate", rate_target("points", "MIN_FL"))
        rate_train = train.where(F.col("MIN_FL") >= MIN_RATE_MINUTES)
    models = TwoStage(
        fit_gbt(train, minutes_features, "MIN_FL", minutes_weight, minutes_boosting, "minutes_hat"),
        fit_gbt(rate_train, rate_features, "_rate", rate_weight, rate_boosting, "rate_hat"),
        minutes_features,
        rate_features,
    )
    scored = store(models.predict(test))
    models.stats = evaluate(scored, "residual" if recent else "mean_plus_std", periods)
    return models, scored


def evaluate(scored: DataFrame, sigma_kind: str, periods: Sequence[str] = ()) -> dict[str, float]:
    """Errors of scored rows; every figure is an aggregate over them."""
    points = regression_metrics(scored, "points", "points_hat").first()
    rotation = regression_metrics(scored, "points", "points_hat", F.col("MIN_FL") > 15).first()
    stats = {
        "rows": points.n,
        "mae_points": points.mae,
        "r2_points": points.r2,
        "mae_rotation": rotation.mae,
        "mae_minutes": regression_metrics(scored, "MIN_FL", "minutes_hat").first().mae,
        "sigma": sigma(scored, "points", "points_hat", sigma_kind).first().sigma,
    }
    if len(periods) == 4:
        stats |= period_breakdown(scored, "points_hat", periods).first().asDict()
    return stats


def save_model(models: TwoStage, path: str) -> None:
    """Write both models and a one-row table with features and statistics."""
    spark = SparkSession.getActiveSession()
    models.minutes.write().overwrite().save(f"{path}/minutes")
    models.rate.write().overwrite().save(f"{path}/rate")
    row = (models.minutes_features, models.rate_features, {k: float(v) for k, v in models.stats.items() if v is not None})
    schema = "minutes_features array<string>, rate_features array<string>, stats map<string,double>"
    spark.createDataFrame([row], schema).write.mode("overwrite").parquet(f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> TwoStage:
    meta = spark.read.parquet(f"{path}/meta").first()
    return TwoStage(
        PipelineModel.load(f"{path}/minutes"),
        PipelineModel.load(f"{path}/rate"),
        meta.minutes_features,
        meta.rate_features,
        meta.stats,
    )


def model_stats(spark: SparkSession, path: str) -> DataFrame:
    """The stored statistics as (name, value) rows."""
    return spark.read.parquet(f"{path}/meta").select(F.explode("stats").alias("name", "value"))


def importances(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Features ranked by importance; one row per feature of the model."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    ranked = spark.createDataFrame(list(zip(features, weights)), "feature string, importance double")
    return ranked.orderBy(F.desc("importance"), "feature")
