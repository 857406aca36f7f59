"""Trees grown on cells of equal rows against Spark's own fit of the rows."""

import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from payspark.operators import cells
from payspark.operators import model as m

FEATURES = ["a", "b", "c", "d", "e"]


def rows(spark, n=1200):
    rng = random.Random(3)
    out = []
    for _ in range(n):
        a, b, c, d, e = rng.randint(0, 1), rng.randint(0, 1), rng.randint(0, 5), rng.randint(0, 45), rng.choice([-0.0, 0.0, 1.5])
        out.append((float(a), float(b), float(c), float(d), e, a * 3000 + b * c * 700 + d * 90 + rng.gauss(0, 900) + 90000))
    return spark.createDataFrame(out, "a double, b double, c double, d double, e double, label double").repartition(3)


def splits(model):
    return [line.split("Predict")[0] for line in model.toDebugString.split("\n")[1:]]


@pytest.mark.parametrize("params", [
    {"maxIter": 23, "maxDepth": 4, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "minInstancesPerNode": 3, "seed": 42},
    {"maxIter": 3, "maxDepth": 6, "maxBins": 8, "seed": -7},
])
def test_trees_on_cells_are_those_of_the_rows(spark, monkeypatch, params):
    monkeypatch.setattr(cells, "ROWS_A_CELL", 1)
    df = rows(spark)
    estimator = GBTRegressor(featuresCol="features", labelCol="label", **params)
    table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)
    ours, theirs = cells.fit(estimator, df, FEATURES, "label"), estimator.fit(table.select("label", "features"))
    assert splits(ours) == splits(theirs) and ours.treeWeights == theirs.treeWeights
    for c in ("uid", "numFeatures"):
        assert getattr(ours, c) == getattr(theirs, c)
    assert max(abs(x - y) for x, y in zip(ours.featureImportances, theirs.featureImportances)) < 1e-9
    scored = theirs.transform(ours.transform(table).drop("features").withColumnRenamed("prediction", "p").join(table.drop("label").distinct(), FEATURES))
    assert scored.where(F.abs(F.col("p") - F.col("prediction")) > 1e-6).isEmpty()


def test_fits_that_are_left_to_the_rows(spark, monkeypatch):
    df, fit = rows(spark, 60), lambda **p: GBTRegressor(featuresCol="features", labelCol="label", maxIter=2, maxDepth=2, **p)
    assert cells.fit(fit(lossType="absolute"), df, FEATURES, "label") is None
    assert cells.fit(fit(), df.withColumn("label", F.lit(None).cast("double")), FEATURES, "label") is None
    assert cells.fit(fit(), df.withColumn("a", F.lit(float("nan"))), FEATURES, "label") is None
    assert cells.fit(fit(), df.where("false"), FEATURES, "label") is None
    assert cells.fit(fit(), df, FEATURES, "label") is None  # fewer than ten rows a cell
    monkeypatch.setattr(cells, "ROWS_A_CELL", 1)
    grown = m.train(df, FEATURES, "label", params={"maxIter": 2, "maxDepth": 2})
    monkeypatch.setattr(cells, "CELLS_MOST", 5)
    assert cells.fit(fit(), df, FEATURES, "label") is None
    own = m.train(df, FEATURES, "label", params={"maxIter": 2, "maxDepth": 2})
    assert splits(grown.pipeline.stages[-1]) == splits(own.pipeline.stages[-1])
    assert grown.metrics["train"] == pytest.approx(own.metrics["train"])


def test_scores_are_those_of_the_model(spark):
    df = rows(spark, 300).withColumn("id", F.monotonically_increasing_id()).cache()
    model = m.train(df, FEATURES, "label", params={"maxIter": 7, "maxDepth": 4})
    ours = {r.id: r.prediction for r in m.predict(model, df, ["id"]).collect()}
    theirs = {r.id: r.prediction for r in model.pipeline.transform(df).collect()}
    assert ours.keys() == theirs.keys() and max(abs(ours[i] - theirs[i]) for i in ours) < 1e-6
    assert len(m.predict(model, df, []).columns) == 1 and m.predict(model, df.where("false"), ["id"]).count() == 0
    assert "ArrowEvalPython" in m.predict(model, df, ["id"])._jdf.queryExecution().executedPlan().toString()
    # an absent feature counts as 0, a NaN is refused as the pipeline refuses it
    assert m.predict(model, df.drop("d"), []).count() == 300
    with pytest.raises(Exception, match="NaN"):
        m.predict(model, df.withColumn("a", F.lit(float("nan"))), []).collect()
