"""Boosted-tree pay model on Spark ML."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..session import written_once
from . import cells
from .features import align_features, numeric_matrix
from .scoring import rank_importance, regression_metrics
from .splits import row_hash

LABEL = "label"


@dataclass
class PayModel:
    """A fitted pipeline with the metadata that scoring needs."""

    pipeline: PipelineModel
    features: list[str]
    importance: dict[str, float]
    params: dict
    metrics: dict = field(default_factory=dict)

    @cached_property
    def scorer(self):
        return cells.scorer(self.pipeline.stages[-1], SparkSession.active())

    @property
    def rmse(self) -> float:
        return self.metrics.get("train", {}).get("rmse", rules.DEFAULT_RMSE)


def _estimator(params: dict) -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol=LABEL, **params)


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features")


def _fit(df: DataFrame, features: list[str], target: str, params: dict | None) -> PayModel:
    params = {**rules.MODEL_PARAMS, **(params or {})}
    assembler = _assembler(features)
    ready = numeric_matrix(df, features, [F.col(target).cast("double").alias(LABEL)])
    estimator = _estimator(params)
    fitted = cells.fit(estimator, ready, features, LABEL) or estimator.fit(assembler.transform(ready).select(LABEL, "features"))
    weights = dict(zip(features, (float(x) for x in fitted.featureImportances.toArray())))
    return PayModel(PipelineModel([assembler, fitted]), features, weights, params)


def train(
    df: DataFrame, features: list[str], target: str, validation: DataFrame | None = None, params: dict | None = None
) -> PayModel:
    """Fit boosted regression trees (squared error); train and validation metrics are kept.

    No early stopping: all ``maxIter`` trees are built, as in the described training run.
    """
    model = _fit(df, list(dict.fromkeys(features)), target, params)
    model.metrics["train"] = evaluate(model, df, target)
    if validation is not None:
        model.metrics["validation"] = evaluate(model, validation, target)
    return model


def predict(model: PayModel, df: DataFrame, keep: Iterable[str] | None = None) -> DataFrame:
    """Batch scores: aligned features through the model's trees, the kept columns plus ``prediction``."""
    keep = list(df.columns if keep is None else keep)
    # the feature columns may be among the kept ones, so the kept row travels as one struct
    aligned = align_features(df, model.features, [F.struct(*keep).alias("__row")] if keep else [])
    scored = aligned.withColumn("prediction", model.scorer(F.array(*[F.col(f"`{f}`") for f in model.features])))
    return scored.select(*([F.col("__row.*")] if keep else []), "prediction")


def evaluate(model: PayModel, df: DataFrame, target: str) -> dict:
    """Metrics of a model on ``df``; each row is scored once, however often the metrics read the scores."""
    scored = written_once(predict(model, df.withColumn(LABEL, F.col(target).cast("double")), [LABEL]), "scored")
    return regression_metrics(scored, LABEL, "prediction").first().asDict()


def fold_column(ids: list[str], folds: int, seed: int = 42):
    """Fold number of a row, from the hash of its identifying columns."""
    return F.pmod(row_hash(ids, seed), F.lit(folds)).cast("int")


def cross_validate(
    df: DataFrame, features: list[str], target: str, ids: list[str], folds: int = 5, params: dict | None = None
) -> dict:
    """Mean, population std and per-fold scores of MAE, RMSE and R2."""
    folded = df.withColumn("__fold", fold_column(ids, folds))
    scores: dict[str, list[float]] = {"mae": [], "rmse": [], "r2": []}
    for k in range(folds):
        held = folded.where(F.col("__fold") == k)
        model = _fit(folded.where(F.col("__fold") != k), features, target, params)
        got = evaluate(model, held, target)
        for name in scores:
            scores[name].append(got[name])
    out = {}
    for name, xs in scores.items():
        mean = sum(xs) / len(xs)
        out[name] = {"mean": mean, "std": (sum((x - mean) ** 2 for x in xs) / len(xs)) ** 0.5, "scores": xs}
    return out


def tune(
    df: DataFrame,
    features: list[str],
    target: str,
    ids: list[str],
    grid: dict | None = None,
    folds: int = 3,
    parallelism: int = 4,
) -> dict:
    """Grid search by mean absolute error over hashed folds."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    grid = grid or rules.TUNE_GRID
    base = _estimator({"seed": rules.MODEL_PARAMS["seed"]})
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(base.getParam(name), list(values))
    ready = numeric_matrix(
        df.withColumn("__fold", fold_column(ids, folds)),
        features,
        [F.col(target).cast("double").alias(LABEL), F.col("__fold")],
    )
    cv = CrossValidator(
        estimator=base,
        estimatorParamMaps=builder.build(),
        evaluator=RegressionEvaluator(labelCol=LABEL, metricName="mae"),
        numFolds=folds,
        foldCol="__fold",
        parallelism=parallelism,
    )
    fitted = cv.fit(_assembler(features).transform(ready).select(LABEL, "features", "__fold"))
    named = [{p.name: v for p, v in m.items()} for m in cv.getEstimatorParamMaps()]
    best = min(range(len(named)), key=lambda i: fitted.avgMetrics[i])
    return {
        "best_params": named[best],
        "best_score": fitted.avgMetrics[best],
        "cv_results": [{**p, "mae": m} for p, m in zip(named, fitted.avgMetrics)],
    }


def importance_table(spark: SparkSession, model: PayModel) -> DataFrame:
    """(feature, importance), one row per model feature."""
    return spark.createDataFrame(list(model.importance.items()), "feature string, importance double")


def feature_importance(spark: SparkSession, model: PayModel, top: int = 20) -> DataFrame:
    return rank_importance(importance_table(spark, model), top)


def row_impacts(df: DataFrame, importance: DataFrame, features: list[str], ids: list[str]) -> DataFrame:
    """Active features per row joined to their importance: |value * importance| in long form.

    ``importance`` has one row per model feature, so its size is fixed by the model.
    """
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    long = df.select(*ids, F.explode(cells).alias("c")).select(*ids, "c.feature", "c.value")
    joined = long.where(F.col("value") != 0).join(F.broadcast(importance), "feature")
    return joined.select(*ids, "feature", "value", "importance", F.abs(F.col("value") * F.col("importance")).alias("impact"))


def save_model(spark: SparkSession, model: PayModel, root: str, stamp: str, name: str = "salary_model") -> str:
    """Stamped and latest copies of the pipeline, each with its metadata."""
    meta = {
        "features": model.features,
        "importance": model.importance,
        "params": model.params,
        "metrics": model.metrics,
        "timestamp": stamp,
    }
    text = spark.createDataFrame([(json.dumps(meta, default=str),)], "value string").coalesce(1)
    for version in (stamp, "latest"):
        model.pipeline.write().overwrite().save(f"{root}/{name}_{version}/pipeline")
        text.write.mode("overwrite").text(f"{root}/{name}_{version}/metadata")
    return f"{root}/{name}_{stamp}"


def load_model(spark: SparkSession, root: str, version: str = "latest", name: str = "salary_model") -> PayModel:
    at = f"{root}/{name}_{version}"
    meta = json.loads(spark.read.text(f"{at}/metadata").first()[0])
    pipeline = PipelineModel.load(f"{at}/pipeline")
    return PayModel(pipeline, list(dict.fromkeys(meta["features"])), meta["importance"], meta["params"], meta["metrics"])
