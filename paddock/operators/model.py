"""Season-points regression (M9-M11) with Spark ML.

Training rows are driver x season feature vectors built by Spark
aggregations; the regressor is ``GBTRegressor`` inside a ``Pipeline``
(tree learning is distributed by Spark ML). Scoring adds a rank per
season (a window bounded by the drivers of one season) and the actual
season points for a predicted-vs-actual comparison.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, spread

# The regulation-change seasons trained on by default.
DEFAULT_TRAIN_SEASONS = (2014, 2017, 2022)
FEATURES = ("prev_avg_points", "dnf_rate", "pace_delta", "position_variance", "prev_races")
#: the others of the full table
FORM_FEATURES = ("team_momentum", "weather")


def season_features(results: DataFrame, qualifying: DataFrame, seasons: int = 3) -> DataFrame:
    """driver x season rows: label (season points) and features of the
    ``seasons`` seasons before, so a coming season can be scored. Drivers
    without any have zeros."""
    per = results.groupBy("driver_id", "year").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("points").alias("points"),
        F.sum(F.col("dnf_flag").cast("int")).alias("dnfs"),
        F.count("position_order").alias("k"),
        F.sum("position_order").alias("s1"),
        F.sum(F.col("position_order").cast("double") * F.col("position_order")).alias("s2"),
    )
    q = qualifying.groupBy("race_id", "driver_id", "year").agg(F.avg("qualifying_position").alias("q_pos"))
    r = results.groupBy("race_id", "driver_id").agg(F.avg("position_order").alias("r_pos"))
    pace = q.join(r, ["race_id", "driver_id"]).groupBy("driver_id", "year").agg(
        F.sum(F.col("q_pos") - F.col("r_pos")).alias("pace"), F.count(F.col("q_pos") - F.col("r_pos")).alias("paced")
    )
    rows = per.join(pace, ["driver_id", "year"], "left")
    w = Window.partitionBy("driver_id").orderBy("year").rangeBetween(-seasons, -1)  # a driver's seasons
    before = lambda c: F.sum(c).over(w)
    ratio = lambda a, b: F.coalesce(before(a) / F.nullif(before(b), F.lit(0)), F.lit(0.0))
    mean = ratio("s1", "k")
    return rows.select(
        "driver_id",
        "year",
        F.col("points").alias("label"),
        F.round(ratio("points", "n"), 6).alias("prev_avg_points"),
        F.round(ratio("dnfs", "n"), 6).alias("dnf_rate"),
        F.round(ratio("pace", "paced"), 6).alias("pace_delta"),
        F.round(ratio("s2", "k") - mean * mean, 4).alias("position_variance"),
        F.coalesce(before("n"), F.lit(0)).alias("prev_races"),
    )


def actual_ranks(features: DataFrame) -> DataFrame:
    """driver_id, season, actual_points, actual_rank (ties share one)."""
    w = Window.partitionBy("season").orderBy(F.desc("actual_points"))  # the drivers of a season
    rows = features.select("driver_id", F.col("year").alias("season"), F.round("label", 4).alias("actual_points"))
    return rows.withColumn("actual_rank", F.rank().over(w))


def form_features(features: DataFrame, results: DataFrame, momentum: DataFrame, weather: DataFrame, seasons: int = 3, width: int = 0) -> DataFrame:
    """``features`` with the driver's form of the ``seasons`` seasons before:
    ``team_momentum``, the mean of the teams' momentum (team_id, race_id,
    momentum) at the driver's races, and ``weather``, the mean reading (race_id,
    avg_weather) at them. Zero without any. Results of a ``width`` are spread
    by race in it already, and momentum joins them there."""
    per = results.select("race_id", "driver_id", "team_id", "year")
    momentum = momentum.select("team_id", "race_id", "momentum")
    per = per.join(spread(momentum, width, "race_id") if width else momentum, ["team_id", "race_id"], "left").join(weather.select("race_id", "avg_weather"), "race_id", "left")
    per = per.groupBy("driver_id", "year").agg(
        F.sum("momentum").alias("m"), F.count("momentum").alias("mk"), F.sum("avg_weather").alias("w"), F.count("avg_weather").alias("wk")
    )
    w = Window.partitionBy("driver_id").orderBy("year").rangeBetween(-seasons, -1)  # a driver's seasons
    mean = lambda a, b: F.round(F.coalesce(F.sum(a).over(w) / F.nullif(F.sum(b).over(w), F.lit(0)), F.lit(0.0)), 4)
    form = per.select("driver_id", "year", mean("m", "mk").alias("team_momentum"), mean("w", "wk").alias("weather"))
    return features.join(form, ["driver_id", "year"], "left").fillna(0.0, list(FORM_FEATURES))


def plain_errors(features: DataFrame, first: int) -> DataFrame:
    """Errors by season (from ``first`` on) of the plainest prediction, the
    mean points of all driver seasons before: season, drivers, plain_mean,
    plain_mae, plain_rmse. One row a season meets the window."""
    by = features.groupBy("year").agg(F.count("label").alias("n"), F.sum("label").alias("s"))
    w = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, -1)  # a row a season
    means = by.select(F.col("year").alias("season"), (F.sum("s").over(w) / F.sum("n").over(w)).alias("plain_mean")).where(F.col("season") >= first)
    off = F.col("label") - F.col("plain_mean")
    return features.join(F.broadcast(means), F.col("year") == F.col("season")).groupBy("season").agg(
        F.count("label").alias("drivers"), F.round(F.first("plain_mean"), 4).alias("plain_mean"),
        F.round(F.avg(F.abs(off)), 4).alias("plain_mae"), F.round(F.sqrt(F.avg(off * off)), 4).alias("plain_rmse"),
    )


def rolling_errors(features: DataFrame, seasons: list[int], columns: tuple[str, ...] = FEATURES + FORM_FEATURES) -> DataFrame:
    """Rolling origin: for each of the seasons a model of all seasons before
    it scores it; season, mae and rmse of the model beside those of the plain
    mean. Features of a season come from earlier ones, so nothing is foreseen."""
    data = cut_lineage(features)
    scored = [train(data.where(F.col("year") < s), None, columns=columns).transform(data.where(F.col("year") == s)) for s in seasons]
    off = F.col("prediction") - F.col("label")
    errors = reduce(DataFrame.unionByName, (d.select("year", "label", "prediction") for d in scored)).groupBy(F.col("year").alias("season")).agg(
        F.round(F.avg(F.abs(off)), 4).alias("mae"), F.round(F.sqrt(F.avg(off * off)), 4).alias("rmse")
    )
    return plain_errors(data, min(seasons)).join(errors, "season")


def train(features: DataFrame, train_seasons=DEFAULT_TRAIN_SEASONS, seed: int = 42, columns: tuple[str, ...] = FEATURES) -> PipelineModel:
    """A model of the given seasons, of all rows for None."""
    data = features if train_seasons is None else features.where(F.col("year").isin(*train_seasons))
    pipe = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="keep"),
            GBTRegressor(featuresCol="features", labelCol="label", maxIter=20, maxDepth=4, seed=seed),
        ]
    )
    return pipe.fit(data)


def predicted_vs_actual(model: PipelineModel, features: DataFrame, season: int) -> DataFrame:
    """Predicted and actual standings of one season; equal points share a
    rank. The windows hold the drivers of that season."""
    scored = model.transform(features.where(F.col("year") == season)).select(
        "driver_id",
        F.col("year").alias("season"),
        F.col("prediction").alias("predicted_points"),
        F.col("label").alias("actual_points"),
    )
    rank = lambda c: F.rank().over(Window.partitionBy("season").orderBy(F.desc(c)))
    return scored.select(
        "*",
        rank("predicted_points").alias("predicted_rank"),
        rank("actual_points").alias("actual_rank"),
        (F.col("predicted_points") - F.col("actual_points")).alias("difference"),
    )


def feature_importances(spark: SparkSession, model: PipelineModel) -> DataFrame:
    gbt = model.stages[-1]
    imp = gbt.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(FEATURES, imp)), "feature string, importance double")
