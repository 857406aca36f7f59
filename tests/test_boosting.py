"""Boosted trees against a plain second-order fit, and odd inputs."""

import random

import pytest
from pyspark.sql import functions as F

from payspark.operators import boosting as b

FEATURES = ["x0", "x1", "x2"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for i in range(300):
        x = [rng.randint(0, 4), rng.choice([0, 1]), rng.random()]
        out.append((i, *map(float, x), 3.0 * x[0] + 10 * x[1] * (x[2] > 0.5) + rng.gauss(0, 0.1)))
    return out


def worth(g, h, p):
    return max(abs(g) - p.l1, 0) ** 2 / (h + p.l2)


def plain_tree(rows, margins, cuts, p):
    """Leaf value of every row, by trying all cuts at every node."""
    values = [0.0] * len(rows)

    def grow(members, level):
        g = sum(margins[i] - rows[i][4] for i in members)
        best = None
        if level < p.depth:
            for f, own in enumerate(cuts):
                for c in own:
                    left = [i for i in members if rows[i][1 + f] < c]
                    if min(len(left), len(members) - len(left)) >= p.min_weight:
                        gl = sum(margins[i] - rows[i][4] for i in left)
                        gain = (worth(gl, len(left), p) + worth(g - gl, len(members) - len(left), p) - worth(g, len(members), p)) / 2
                        if gain > p.min_gain and (best is None or gain > best[0] * (1 + 1e-9)):
                            best = gain, f, c
        if best is None:
            drawn = max(abs(g) - p.l1, 0) * (1 if g > 0 else -1)
            for i in members:
                values[i] = -drawn / (len(members) + p.l2)
            return
        for side in (True, False):
            grow([i for i in members if (rows[i][1 + best[1]] < best[2]) is side], level + 1)

    grow(range(len(rows)), 0)
    return values


def test_fit_equals_a_plain_fit(spark, rows):
    df = spark.createDataFrame(rows, "id int, x0 double, x1 double, x2 double, y double").repartition(3)
    p = b.Boosting(trees=5, depth=3, rate=0.4, rows=1.0, columns=1.0, bins=8, l1=2.0, l2=5.0)
    matrix = b.binned(df, FEATURES, "y", ["id"], p.bins)
    margins = [sum(r[4] for r in rows) / len(rows)] * len(rows)
    for _ in range(p.trees):
        margins = [m + p.rate * v for m, v in zip(margins, plain_tree(rows, margins, matrix.cuts, p))]
    model = b.fit(matrix, p)
    got = {r.id: r.prediction for r in b.predict(model, df, ["id"]).collect()}
    assert [got[i] for i in range(len(rows))] == pytest.approx(margins)
    assert sum(model.importance.values()) == pytest.approx(1.0) and model.importance["x0"] > 0
    with_more = df.select("*", F.lit(1).alias("prediction_"), F.lit("s").alias("__x1"))
    assert b.predict(model, with_more).columns == [*with_more.columns, "prediction"]


def test_sampled_fit_saves_and_loads(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, "id int, x0 double, x1 double, x2 double, y double")
    p = b.Boosting(trees=6, depth=4, rate=0.5, bins=16)
    model = b.fit(b.binned(df, FEATURES, "y"), p)
    again = b.fit(b.binned(df.repartition(5), FEATURES, "y"), p)
    assert [(n["node"], n["feature"], n["cut"]) for n in model.nodes] == [(n["node"], n["feature"], n["cut"]) for n in again.nodes]
    b.save(spark, model, str(tmp_path), "s1")
    direct = {r.id: r.prediction for r in b.predict(model, df, ["id"]).collect()}
    for version in ("s1", "latest"):
        loaded = {r.id: r.prediction for r in b.saved_scores(df, str(tmp_path), version, keep=["id"]).collect()}
        assert loaded == direct
    error = sum(abs(direct[r[0]] - r[4]) for r in rows) / len(rows)
    mean = sum(r[4] for r in rows) / len(rows)
    assert error < 0.5 * sum(abs(mean - r[4]) for r in rows) / len(rows)


def test_odd_tables(spark, rows):
    df = spark.createDataFrame(rows[:40], "id int, x0 double, x1 double, x2 double, y double")
    p = b.Boosting(trees=2, depth=2)
    empty = b.fit(b.binned(df.where("false"), FEATURES, "y"), p)
    assert empty.nodes == [] and {r.prediction for r in b.predict(empty, df, ["id"]).collect()} == {0.0}
    constant = b.fit(b.binned(df.withColumn("y", F.lit(7.0)), FEATURES, "y"), p)
    assert {round(r.prediction, 9) for r in b.predict(constant, df, ["id"]).collect()} == {7.0}
    gaps = df.withColumns({"y": F.when(F.col("id") % 2 == 0, F.col("y")), "x0": F.when(F.col("id") % 3 > 0, F.col("x0"))})
    model = b.fit(b.binned(gaps, FEATURES, "y"), p)
    assert b.predict(model, gaps.drop("x1"), ["id"]).where("prediction IS NULL").count() == 0
    scores = b.cross_validate(df, FEATURES, "y", ["id"], 4, p)
    assert sorted(r.n for r in scores.collect()) == [10] * 4
    assert {r.metric for r in b.score_summary(scores).collect()} == {"mae", "rmse", "r2"}
