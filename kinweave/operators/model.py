"""Learned pair scores with pyspark.ml: pre-ranker, grouped folds, calibration."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.operators.sampling import fold_of


def fit_trees(rows: DataFrame, features: list[str], rounds: int = 20, depth: int = 5, held_out: str | None = None) -> PipelineModel:
    """Boosted trees on ``features`` and the label y; rows where ``held_out`` is true only say when to stop."""
    prepared = rows.select(*(F.col(c).cast("double").alias(c) for c in features), F.col("y").cast("double").alias("y"), *([held_out] if held_out else []))
    assembler = VectorAssembler(inputCols=features, outputCol="x", handleInvalid="keep")
    trees = GBTClassifier(featuresCol="x", labelCol="y", maxIter=rounds, maxDepth=depth, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=7)
    if held_out:
        trees = trees.setValidationIndicatorCol(held_out)
    return PipelineModel([assembler, trees.fit(assembler.transform(prepared))])


def predict(model: PipelineModel, rows: DataFrame, name: str) -> DataFrame:
    features = model.stages[0].getInputCols()
    out = model.transform(rows.withColumns({c: F.col(c).cast("double") for c in features}))
    return out.withColumn(name, vector_to_array("probability")[1]).drop("x", "rawPrediction", "probability", "prediction")


def cross_fit(rows: DataFrame, features: list[str], name: str, folds: int = 5, rounds: int = 20) -> tuple[DataFrame, list[PipelineModel]]:
    """Out-of-fold predictions, all pairs of an S1 record in one fold, and the folds' models."""
    folded = rows.withColumn("_fold", fold_of("s1_id", folds)).persist()
    parts, models = [], []
    for k in range(folds):
        model = fit_trees(folded.where(F.col("_fold") != k), features, rounds)
        models.append(model)
        parts.append(predict(model, folded.where(F.col("_fold") == k), name))
    return reduce(DataFrame.unionByName, parts).drop("_fold"), models


def mean_prediction(models: list[PipelineModel], rows: DataFrame, name: str) -> DataFrame:
    out = rows
    for i, m in enumerate(models):
        out = predict(m, out, f"_p{i}")
    cols = [f"_p{i}" for i in range(len(models))]
    return out.withColumn(name, reduce(lambda a, b: a + b, map(F.col, cols)) / len(cols)).drop(*cols)


def importances(model: PipelineModel) -> list[tuple[str, float]]:
    return sorted(zip(model.stages[0].getInputCols(), model.stages[1].featureImportances.toArray().tolist(), strict=True), key=lambda x: (-x[1], x[0]))


def calibrate(scored: DataFrame, p: str = "p", y: str = "y"):
    """An isotonic fit of y on p; it interpolates between its points and is flat beyond them."""
    return IsotonicRegression(featuresCol="f", labelCol="label").fit(scored.select(F.col(p).cast("double").alias("f"), F.col(y).cast("double").alias("label")))


def apply_calibration(model, scored: DataFrame, name: str, p: str = "p") -> DataFrame:
    return model.transform(scored.withColumn("f", F.col(p).cast("double"))).withColumnRenamed("prediction", name).drop("f")


def auc(scored: DataFrame, p: str = "p", y: str = "y") -> float:
    rows = scored.select(F.col(p).cast("double").alias("r"), F.col(y).cast("double").alias("l"))
    return BinaryClassificationEvaluator(rawPredictionCol="r", labelCol="l", metricName="areaUnderROC").evaluate(rows)
