"""Depth from reflectance: features, split by track, baseline and boosted trees, prediction over a grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.functions.values import hash_share, log_floor, stumpf

FEATURES = ("ln_b1", "ln_b2", "ln_b3", "ln_b4", "b8", "ratio_b2_b3", "ratio_b2_b4")


def features(pixels: DataFrame) -> DataFrame:
    """Spectral features; a null band makes its features null. Place is no feature, so a model cannot learn where tracks run."""
    logs = {f"ln_b{i}": log_floor(F.col(f"b{i}")) for i in (1, 2, 3, 4)}
    return pixels.withColumns(logs).withColumns({"ratio_b2_b3": F.col("ln_b2") / (F.col("ln_b3") + 1e-6), "ratio_b2_b4": F.col("ln_b2") / (F.col("ln_b4") + 1e-6), "stumpf": stumpf(F.col("b2"), F.col("b3"))})


def split(points: DataFrame, share: float = 0.3, seed: int = 42, track: str = "track") -> DataFrame:
    """``points`` with ``holdout``: whole tracks, by their hash."""
    return points.withColumn("holdout", hash_share(F.col(track), seed) < share)


def leaked(train: DataFrame, holdout: DataFrame, track: str = "track") -> DataFrame:
    """Tracks that are on both sides; none if the split is sound."""
    return train.select(track).distinct().join(holdout.select(track).distinct(), track, "left_semi")


def track_id(rgt: Column, cycle: Column, spot: Column, beam: Column) -> Column:
    """``rgt-cycle-spot``, the beam where there is no spot, ``?`` for what is missing."""
    known = lambda c: F.coalesce(c.cast("string"), F.lit("?"))
    return F.concat_ws("-", known(rgt), known(cycle), known(F.coalesce(spot.cast("string"), beam.cast("string"))))


def baseline(train: DataFrame, x: str, y: str) -> DataFrame:
    """One row: slope and intercept of least squares, and the number of pairs."""
    return train.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_count(y, x).alias("n"))


def with_baseline(pixels: DataFrame, line: DataFrame, x: str) -> DataFrame:
    return pixels.crossJoin(F.broadcast(line.select("slope", "intercept"))).withColumn("linear", F.col("slope") * F.col(x) + F.col("intercept")).drop("slope", "intercept")


def fit_trees(train: DataFrame, label: str, inputs: Sequence[str] = FEATURES, rounds: int = 600, depth: int = 6, step: float = 0.03, sample: float = 0.8, columns: float = 0.8, seed: int = 42) -> PipelineModel:
    """Gradient-boosted trees on shares of the rows and, at each split, of the inputs; rows with a null input or label are left out."""
    known = train.na.drop(subset=[*inputs, label])
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="_features", handleInvalid="skip")
    trees = GBTRegressor(featuresCol="_features", labelCol=label, predictionCol="predicted", maxIter=rounds, maxDepth=depth, stepSize=step, subsamplingRate=sample, featureSubsetStrategy=str(columns), seed=seed)
    return Pipeline(stages=[assembler, trees]).fit(known)


def predict(model: PipelineModel, pixels: DataFrame, keys: Sequence[str], inputs: Sequence[str] = FEATURES, floor: float = -26.0) -> DataFrame:
    """All pixels with ``predicted``: null where an input is null, above water, or below the optical floor."""
    known = model.transform(pixels.na.drop(subset=list(inputs))).select(*keys, F.when(F.col("predicted").between(floor, 0.0), F.col("predicted")).alias("predicted"))
    return pixels.join(known, list(keys), "left")


def summary(model: PipelineModel, train: DataFrame, line: DataFrame, track: str = "track", inputs: Sequence[str] = FEATURES) -> DataFrame:
    """One row on a fit: trees, inputs, rows, tracks and the baseline's slope."""
    rows = train.na.drop(subset=list(inputs)).agg(F.count(F.lit(1)).alias("n_train"), F.count_distinct(track).alias("n_tracks"))
    return rows.crossJoin(F.broadcast(line.select(F.col("slope").alias("stumpf_coef")))).withColumn("model", F.lit(f"GBTRegressor({model.stages[-1].getNumTrees})")).withColumn("features", F.array(*[F.lit(f) for f in inputs]))
