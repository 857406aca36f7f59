"""Second-order boosted regression trees with L1 and L2 terms, and the fitted model as a table (L1, L2, L5-L8).

The features are cut once: a row becomes its bin numbers, its target and a margin, written and read by every fit.  A level of a tree is one
aggregation: gradient and hessian sums per (node, feature, bin), summed map side; running sums over bins give every cut's gain and the
best cut of each node, so the driver sees one row per node.  With squared error the gradient is prediction - target and the hessian 1.

A split's gain is (s(left) + s(right) - s(node)) / 2 with s(G, H) = soft(G)^2 / (H + l2), soft(G) the gradient sum drawn ``l1`` towards 0; a leaf is worth
-soft(G) / (H + l2).  Gains are compared as shares of the target's squares around the mean, rounded, so that cuts that part the rows alike tie
whatever the order of summation; ties go to the first feature and the least cut.

A fitted model is rows (tree, node, feature, cut, left, right, value, gain, cover), node 0 the root and 2 n + 1, 2 n + 2 below node n; that
table, saved and read back, is what scores: one row of node arrays, walked inside each row of features.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import written_once
from .features import align_features
from .ordering import contiguous_parts, with_positions

WRITE_EVERY = 4
GAIN_DIGITS = 10
NODES = "tree int, node int, feature string, cut double, left int, right int, value double, gain double, cover double"


@dataclass(frozen=True)
class Boosting:
    """Parameters of a fit; the defaults are the described training run's."""

    trees: int = 200
    depth: int = 6
    rate: float = 0.1
    rows: float = 0.8
    columns: float = 0.8
    min_weight: float = 3.0
    l1: float = 0.1
    l2: float = 1.0
    min_gain: float = 1e-6
    bins: int = 64
    seed: int = 42


@dataclass
class Trees:
    """A fitted model: its nodes, where its margin starts and how its trees are weighted."""

    nodes: list[dict]
    features: list[str]
    base: float
    rate: float
    params: dict = field(default_factory=dict)

    def table(self, spark: SparkSession) -> DataFrame:
        names = [c.split()[0] for c in NODES.split(", ")]
        return spark.createDataFrame([tuple(n[c] for c in names) for n in self.nodes], NODES)

    @property
    def importance(self) -> dict[str, float]:
        """Mean gain of a feature's splits, as shares of one."""
        gains = {f: [n["gain"] for n in self.nodes if n["feature"] == f] for f in self.features}
        mean = {f: sum(g) / len(g) if g else 0.0 for f, g in gains.items()}
        total = sum(mean.values())
        return {f: m / total if total else 0.0 for f, m in mean.items()}


@dataclass
class Matrix:
    """Binned rows (__bins, __y, __h and the kept columns), written; ``cuts`` by feature: bin b holds cuts[b - 1] <= x < cuts[b]."""

    rows: DataFrame
    features: list[str]
    cuts: list[list[float]]


def binned(df: DataFrame, features: list[str], target: str, keep: Iterable[str] = (), bins: int = 64) -> Matrix:
    """Cuts are the features' values at equal steps of rank, so at most ``bins`` - 1 of each; rows without a target are left out."""
    features, keep = list(dict.fromkeys(features)), list(keep)
    y = F.col(target).cast("double")
    ready = align_features(df.where(y.isNotNull()), features, [F.struct(*keep, y.alias("__y")).alias("__row")])
    steps = [k / bins for k in range(1, bins)]
    ready = written_once(ready, "features")
    values = ready.agg(*[F.percentile_approx(f"`{f}`", steps, 10_000).alias(f"c{i}") for i, f in enumerate(features)],
                       *[F.min(f"`{f}`").alias(f"m{i}") for i, f in enumerate(features)]).first()
    cuts = [sorted({c for c in values[f"c{i}"] or [] if c > values[f"m{i}"]}) for i in range(len(features))]

    def bin_of(feature: str, own: list[float]) -> Column:
        return F.size(F.filter(F.lit(own), lambda v: v <= F.col(f"`{feature}`"))) if own else F.lit(0)

    rows = ready.select("__row.*", F.array(*map(bin_of, features, cuts)).cast("array<int>").alias("__bins"), F.xxhash64(*features, "__row").alias("__h"))
    return Matrix(written_once(rows, "binned"), features, cuts)


def _soft(g: Column, l1: float) -> Column:
    return F.signum(g) * F.greatest(F.abs(g) - l1, F.lit(0.0))


def _node_of(tree: dict[int, dict], at: int = 0) -> Column:
    """The node where a binned row ends in the tree as grown so far."""
    node = tree[at]
    if node["feature"] is None:
        return F.lit(at)
    goes_left = F.col("__bins")[node["__f"]] < node["__b"]
    return F.when(goes_left, _node_of(tree, node["left"])).otherwise(_node_of(tree, node["right"]))


def _value_of(tree: dict[int, dict]) -> Column:
    def walk(at: int) -> Column:
        node = tree[at]
        if node["feature"] is None:
            return F.lit(node["value"])
        return F.when(F.col("__bins")[node["__f"]] < node["__b"], walk(node["left"])).otherwise(walk(node["right"]))

    return walk(0)


def _best_cuts(rows: DataFrame, node: Column, tried: list[int], p: Boosting, scale: float) -> list:
    """The best cut of each node: node, feature number, bin, gain, and the sums of the node and of its left part."""
    cells = F.transform(F.lit(tried), lambda f: F.struct(f.alias("f"), F.element_at("__bins", f + 1).alias("b")))
    long = rows.select(node.alias("node"), (F.col("__m") - F.col("__y")).alias("g"), F.explode(cells).alias("c"))
    sums = long.groupBy("node", "c.f", "c.b").agg(F.sum("g").alias("g"), F.count(F.lit(1)).cast("double").alias("h"))
    feature = Window.partitionBy("node", "f")
    before = feature.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    g, h, gl, hl = (F.col(c) for c in ("G", "H", "gl", "hl"))
    at = sums.select(
        "node", "f", "b", F.sum("g").over(before).alias("gl"), F.sum("h").over(before).alias("hl"), F.sum("g").over(feature).alias("G"),
        F.sum("h").over(feature).alias("H"),
    )

    def worth(g: Column, h: Column) -> Column:
        return F.pow(_soft(g, p.l1), 2) / (h + p.l2)

    gain = F.when((hl >= p.min_weight) & (h - hl >= p.min_weight), (worth(gl, hl) + worth(g - gl, h - hl) - worth(g, h)) / 2)
    share = F.when(gain > p.min_gain, F.round(gain / scale, GAIN_DIGITS))
    order = F.struct(share.alias("share"), (-F.col("f")).alias("f"), (-F.col("b")).alias("b"), gain.alias("gain"), gl, hl, g, h)
    best = at.groupBy("node").agg(F.max(F.when(share.isNotNull(), order)).alias("best"), F.max(F.struct(g, h)).alias("all"))
    return best.collect()


def fit(matrix: Matrix, params: Boosting = Boosting(), where: Column | None = None) -> Trees:
    """Boosted trees on the rows of ``matrix`` that ``where`` keeps."""
    p, n_features = params, len(matrix.features)
    rows = matrix.rows if where is None else matrix.rows.where(where)
    start = rows.agg(F.avg("__y").alias("mean"), F.regr_syy("__y", "__y").alias("squares")).first()
    base, scale = start["mean"] or 0.0, start["squares"] or 1.0
    rows, nodes = rows.withColumn("__m", F.lit(base)), []
    for t in range(p.trees if start["mean"] is not None else 0):
        tried = _drawn_features(matrix, t, p)
        part = F.pmod(F.xxhash64("__h", F.lit(p.seed), F.lit(t)), F.lit(1 << 20)) < round(p.rows * (1 << 20))
        sample = rows.where(part) if p.rows < 1 else rows
        tree: dict[int, dict] = {0: {"feature": None, "value": 0.0, "cover": 0.0}}
        opened = [0]
        for level in range(max(1, p.depth)):
            here = _node_of(tree)
            scope = sample if level == 0 else sample.where(here.isin(opened))
            found = {r.node: r for r in _best_cuts(scope, here, tried, p, scale)}
            grown = []
            for n in opened:
                r = found.get(n)
                if r is None:
                    continue
                _close(tree[n], r["all"]["G"], r["all"]["H"], p)
                if r.best is None or p.depth == 0:
                    continue
                f, b = -r.best.f, -r.best.b
                tree[n] |= {
                    "feature": matrix.features[f], "cut": float(matrix.cuts[f][b - 1]), "left": 2 * n + 1, "right": 2 * n + 2, "gain": r.best.gain,
                    "__f": f, "__b": b,
                }
                for child, (g, h) in ((2 * n + 1, (r.best.gl, r.best.hl)), (2 * n + 2, (r.best.G - r.best.gl, r.best.H - r.best.hl))):
                    tree[child] = {"feature": None}
                    _close(tree[child], g, h, p)
                    grown.append(child)
            opened = grown
            if not opened:
                break
        rows = rows.withColumn("__m", F.col("__m") + p.rate * _value_of(tree))
        nodes += [
            {"cut": None, "left": None, "right": None, "gain": 0.0} | {k: v for k, v in node.items() if not k.startswith("__")}
            | {"tree": t, "node": n} for n, node in sorted(tree.items())
        ]
        if t % WRITE_EVERY == WRITE_EVERY - 1 and t + 1 < p.trees:
            rows = written_once(rows, "margins")
    return Trees(nodes, matrix.features, base, p.rate, asdict(p))


def _drawn_features(matrix: Matrix, tree: int, p: Boosting) -> list[int]:
    """Numbers of the features that a tree may cut: a seeded share of them, at least one."""
    import random

    n = len(matrix.features)
    wanted = max(1, int(p.columns * n))
    return sorted(random.Random(p.seed * 1_000_003 + tree).sample(range(n), wanted)) if wanted < n else list(range(n))


def _close(node: dict, g: float, h: float, p: Boosting) -> None:
    drawn = (abs(g) - p.l1) * (1 if g > 0 else -1) if abs(g) > p.l1 else 0.0
    node |= {"value": -drawn / (h + p.l2), "cover": h}


def _walkable(nodes: DataFrame, features: list[str]) -> Column:
    """All trees as one value: per tree an array by node number of (feature number or -1, cut, value)."""
    number = F.coalesce(F.array_position(F.lit(features), F.col("feature")) - 1, F.lit(-1)).cast("int")
    by_node = F.map_from_entries(F.collect_list(F.struct("node", F.struct(number.alias("f"), F.coalesce("cut", F.lit(0.0)).alias("cut"), "value"))))
    trees = nodes.groupBy("tree").agg(by_node.alias("m"), F.max("node").alias("last"))
    filled = trees.select("tree", F.transform(F.sequence(F.lit(0), "last"), lambda i: F.try_element_at("m", i)).alias("t"))
    return filled.agg(F.transform(F.sort_array(F.collect_list(F.struct("tree", "t"))), lambda x: x["t"]).alias("t")).scalar()


def score(df: DataFrame, nodes: DataFrame, features: list[str], base: float, rate: float, keep: Iterable[str] | None = None) -> DataFrame:
    """The kept columns of ``df`` and ``prediction``, by walking the node rows; absent features count as 0."""
    keep = list(df.columns if keep is None else keep)
    row = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("__row")] if keep else []
    ready = align_features(df, features, row).select(*(["__row"] if keep else []), F.array(*[F.col(f"`{f}`") for f in features]).alias("__x"))
    ready = ready.withColumn("__trees", _walkable(nodes, features))

    def leaf(tree: Column) -> Column:
        depth = F.ceil(F.log2(F.size(tree) + 1)).cast("int")  # levels that the last node number can lie on

        def step(n: Column, _: Column) -> Column:
            f = tree[n]["f"]
            return F.when(f < 0, n).when(F.get("__x", F.greatest(f, F.lit(0))) < tree[n]["cut"], 2 * n + 1).otherwise(2 * n + 2)

        return F.aggregate(F.sequence(F.lit(1), depth), F.lit(0), step, lambda n: tree[n]["value"])

    total = F.aggregate(F.coalesce("__trees", F.array()), F.lit(float(base)), lambda m, tree: m + F.lit(float(rate)) * leaf(tree))
    return ready.select(*(["__row.*"] if keep else []), total.alias("prediction"))


def predict(model: Trees, df: DataFrame, keep: Iterable[str] | None = None) -> DataFrame:
    return score(df, model.table(df.sparkSession), model.features, model.base, model.rate, keep)


def save(spark: SparkSession, model: Trees, root: str, stamp: str, name: str = "salary_trees") -> str:
    """The node rows and one row of metadata, under the stamp and as the latest."""
    meta = spark.createDataFrame([(model.features, model.base, model.rate, {k: str(v) for k, v in model.params.items()}, stamp)],
                                 "features array<string>, base double, rate double, params map<string,string>, stamp string")
    for version in (stamp, "latest"):
        model.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{root}/{name}_{version}/nodes")
        meta.coalesce(1).write.mode("overwrite").parquet(f"{root}/{name}_{version}/metadata")
    return f"{root}/{name}_{stamp}"


def saved_scores(df: DataFrame, root: str, version: str = "latest", name: str = "salary_trees", keep: Iterable[str] | None = None) -> DataFrame:
    """``df`` scored by a saved model's own rows."""
    spark = df.sparkSession
    meta = spark.read.parquet(f"{root}/{name}_{version}/metadata").first()
    return score(df, spark.read.parquet(f"{root}/{name}_{version}/nodes"), list(meta.features), meta.base, meta.rate, keep)


def fold_scores(df: DataFrame, fold: str, actual: str, predicted: str) -> DataFrame:
    """Per fold: its rows and MAE, RMSE and R2 of the predictions."""
    y, e = F.col(actual).cast("double"), F.col(actual).cast("double") - F.col(predicted)
    r2 = 1 - F.try_divide(F.sum(e * e), F.regr_syy(y, y))
    return df.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), r2.alias("r2"))


def score_summary(scores: DataFrame) -> DataFrame:
    """Mean and population deviation of the folds' scores, one row per metric."""
    each = scores.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in ("mae", "rmse", "r2")])).alias("s"))
    return each.groupBy("s.metric").agg(F.avg("s.v").alias("mean"), F.stddev_pop("s.v").alias("std"))


def in_folds(df: DataFrame, order: list[Column | str], folds: int) -> DataFrame:
    """``df`` with ``fold``: contiguous blocks of nearly equal size in the order of ``order``."""
    placed = with_positions(df, order, "__position")
    return contiguous_parts(placed, folds, placed.count(), "__position", "fold").drop("__position")


def _held_out(matrix: Matrix, fold: int, params: Boosting) -> DataFrame:
    model = fit(matrix, params, F.col("fold") != fold)
    held = matrix.rows.where(F.col("fold") == fold)
    margin = F.lit(model.base)
    for t in range(max((n["tree"] for n in model.nodes), default=-1) + 1):
        tree = {n["node"]: dict(n) for n in model.nodes if n["tree"] == t}
        for node in tree.values():
            if node["feature"] is not None:
                f = matrix.features.index(node["feature"])
                node |= {"__f": f, "__b": matrix.cuts[f].index(node["cut"]) + 1}
        margin = margin + params.rate * _value_of(tree)
    return held.select("fold", "__y", margin.alias("__p"))


def cross_validate(
    df: DataFrame, features: list[str], target: str, order: list[Column | str], folds: int = 5, params: Boosting = Boosting()
) -> DataFrame:
    """Scores of each contiguous fold by a model of the others: fold, n, mae, rmse, r2.  All fits read one binned matrix."""
    matrix = binned(in_folds(df, order, folds), features, target, ["fold"], params.bins)
    held = [fold_scores(_held_out(matrix, k, params), "fold", "__y", "__p") for k in range(folds)]
    out = held[0]
    for more in held[1:]:
        out = out.unionByName(more)
    return out


def tune(
    df: DataFrame, features: list[str], target: str, order: list[Column | str], grid: list[dict], folds: int = 3, params: Boosting = Boosting()
) -> DataFrame:
    """One row per combination of ``grid``, by mean absolute error over contiguous folds: choice, params, mae, best.

    The matrix is binned and folded once and read by all fits; the least error is best, of equals the first combination.
    """
    matrix = binned(in_folds(df, order, folds), features, target, ["fold"], params.bins)
    out = None
    for i, choice in enumerate(grid):
        for k in range(folds):
            held = fold_scores(_held_out(matrix, k, replace(params, **choice)), "fold", "__y", "__p")
            row = held.select(F.lit(i).alias("choice"), F.lit(", ".join(f"{a}={b}" for a, b in choice.items())).alias("params"), "mae")
            out = row if out is None else out.unionByName(row)
    means = written_once(out.groupBy("choice", "params").agg(F.avg("mae").alias("mae")), "tuned")
    first = means.agg(F.min(F.struct("mae", "choice")).alias("m")).select("m.choice").scalar()
    return means.withColumn("best", F.col("choice") == first)
