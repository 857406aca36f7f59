"""The boosted trees of Spark ML, grown on cells: rows with equal features (L1, L2).

All rows of a cell have one prediction, so with squared error a tree needs of them only how many it samples, the sum of their labels and that of
their squares.  One pass over the rows gives these numbers per cell and tree, and the trees grow on cells; a level of a tree is then a few
array operations instead of a job over all rows.  It is the fit of ``GBTRegressor``: a row is sampled by the draws of its place in its partition, a
node tries the features drawn for it.  Cuts are looked for in all rows instead of a sample, and of cuts that part a node's rows alike the first tried
is taken, where Spark's choice hangs on rounding.  The engineered features are flags, codes and small numbers, so cells stay few as rows grow; where they
do not, or where a fit asks for something else, ``fit`` gives None.
"""

from __future__ import annotations

import json
import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.ml.util import DefaultParamsWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_path, written_once

# the Arrow functions travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELLS_MOST = 50_000
#: Fewer rows a cell do not repay the way by cells.
ROWS_A_CELL = 10
#: Decimals of a gain's share of its node's impurity: cuts that part the rows alike tie whatever the order of summation, and the first tried has it.
GAIN_DIGITS = 10
#: Trees whose sums come to the driver together.
TREES_AT_ONCE = 20
LANES, LANE_ROWS = 64, 64
EPSILON = 2.0**-52
NODES = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
    "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)
MASK = (1 << 64) - 1


# --- the random numbers of the JVM ----------------------------------------------------------------------------


def _mixed(data: bytes, seed: int) -> int:
    """MurmurHash3 of eight bytes."""
    h = seed
    for i in (0, 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) * 0x1B873593 & 0xFFFFFFFF
        h ^= k & 0xFFFFFFFF
        h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= 8
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def _started(seed: int) -> int:
    """The first state of Spark's shift generator."""
    data = (seed & MASK).to_bytes(8, "big")
    low = _mixed(data, 0x3C074A61)
    return _mixed(data, low) << 32 | low


def _step(x):
    """The next state; for a number or an array of them."""
    x = x ^ (x << 21 & MASK if isinstance(x, int) else x << np.uint64(21))
    x = x ^ (x >> 35 if isinstance(x, int) else x >> np.uint64(35))
    return x ^ (x << 4 & MASK if isinstance(x, int) else x << np.uint64(4))


class _JavaRandom:
    """``java.util.Random``, as far as it is used."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def _next(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & (1 << 48) - 1
        out = self.state >> 16
        return out - (1 << 32) if out >> 31 else out

    def long(self) -> int:
        return ((self._next() << 32) + self._next()) & MASK


def _drawn(n: int, k: int, seed: int) -> list[int]:
    """``k`` of the numbers below ``n`` in the order in which a reservoir holds them."""
    kept, state = [*range(k)], _started(seed)
    for item in range(k, n):
        high = state = _step(state)
        state = _step(state)
        at = int((((high & (1 << 26) - 1) << 27) + (state & (1 << 27) - 1)) * 2.0**-53 * (item + 1))
        if at < k:
            kept[at] = item
    return kept


class _Draws:
    """Which trees sample a partition's rows, in blocks of rows.

    A tree's generator takes two steps a row.  Steps are linear in the state's bits, so lanes of rows start from states that are found by one jump
    each, and run side by side.
    """

    def __init__(self, seeds: list[int], rate: float):
        self.state = np.array([_started(s) for s in seeds], np.uint64)
        self.below = np.uint64(math.ceil(rate * 2.0**53))
        columns = [1 << i for i in range(64)]
        for _ in range(2 * LANE_ROWS):
            columns = [_step(c) for c in columns]
        jump = np.zeros((8, 256), np.uint64)
        for byte in range(8):
            for value in range(256):
                x = 0
                for bit in range(8):
                    if value >> bit & 1:
                        x ^= columns[8 * byte + bit]
                jump[byte, value] = x
        self.jump = jump
        self.left = np.zeros((0, len(seeds)), bool)

    def _block(self) -> np.ndarray:
        lanes = np.empty((LANES, len(self.state)), np.uint64)
        for lane in range(LANES):
            lanes[lane], x = self.state, self.state
            parts = x.astype("<u8").view(np.uint8).reshape(-1, 8)
            self.state = np.bitwise_xor.reduce([self.jump[b, parts[:, b]] for b in range(8)])
        out = np.empty((LANES, LANE_ROWS, lanes.shape[1]), bool)
        for row in range(LANE_ROWS):
            high = _step(lanes)
            lanes = _step(high)
            out[:, row] = ((high & np.uint64((1 << 26) - 1)) << np.uint64(27)) + (lanes & np.uint64((1 << 27) - 1)) < self.below
        return out.reshape(-1, lanes.shape[1])

    def take(self, rows: int) -> np.ndarray:
        while len(self.left) < rows:
            self.left = np.concatenate([self.left, self._block()])
        out, self.left = self.left[:rows], self.left[rows:]
        return out


# --- from rows to cells ---------------------------------------------------------------------------------------


def _sampled(cells: dict[bytes, int], trees: int, rate: float, seed: int):
    """Rows (features, label) to (cell, label, one bit per tree)."""

    def run(batches):
        first = seed + TaskContext.get().partitionId() + 1
        draws = _Draws([first + t for t in range(trees)], rate) if rate < 1 else None
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns - 1)])
            data, wide = (x + 0.0).tobytes(), 8 * x.shape[1]
            at = [cells[data[i : i + wide]] for i in range(0, len(data), wide)]
            taken = draws.take(len(at)) if draws else np.ones((len(at), trees), bool)
            bits = np.packbits(taken, axis=1)
            packed = pa.Array.from_buffers(pa.binary(bits.shape[1]), len(at), [None, pa.py_buffer(bits.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), batch.column(batch.num_columns - 1), packed], ["cell", "y", "bits"])

    return run


def _summed(trees: int, center: float):
    """All rows of some cells to (cell, chunk, and per tree of the chunk: sampled rows, sum and squares of their labels around the center)."""

    def run(batches):
        place: dict[int, int] = {}
        sums = [np.zeros((64, trees)) for _ in range(3)]
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column(0).to_numpy()
            order = np.argsort(cell, kind="stable")
            cell = cell[order]
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            at = np.array([place.setdefault(c, len(place)) for c in cell[starts].tolist()])
            if len(place) > len(sums[0]):
                sums = [np.concatenate([s, np.zeros((max(len(s), len(place) - len(s)), trees))]) for s in sums]
            bits = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(len(order), -1)[order]
            taken = np.unpackbits(bits, axis=1, count=trees).astype(float)
            y = (batch.column(1).to_numpy()[order] - center)[:, None]
            for s in sums:
                s[at] += np.add.reduceat(taken, starts, axis=0)
                taken *= y
        cells = [*place]
        for i in range(0, trees, TREES_AT_ONCE):
            values = [s[: len(cells), i : i + TREES_AT_ONCE] for s in sums]
            wide = values[0].shape[1]
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, wide), pa.int32()), pa.array(v.ravel())) for v in values]
            if cells:
                yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array([i] * len(cells), pa.int32()), *lists], ["cell", "chunk", "n", "s", "q"])

    return run


def _cuts(values: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """Thresholds between a feature's values: all of them, or about ``most`` at equal steps of rank."""
    value, at = np.unique(values, return_inverse=True)
    n = np.bincount(at, counts)
    between = (value[:-1] + value[1:]) / 2.0
    if len(between) <= most:
        return between
    step = n.sum() / (most + 1)
    so_far, target, out = n[0], step, []
    for i in range(1, len(value)):
        before, so_far = so_far, so_far + n[i]
        if abs(before - target) < abs(so_far - target):
            out.append(between[i - 1])
            target += step
    return np.array(out)


# --- the trees ------------------------------------------------------------------------------------------------


def _impurity(count, total, squares):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(count == 0, 0.0, (squares - total * total / count) / count)


def _grown(bins: np.ndarray, cuts: list[np.ndarray], sums: np.ndarray, p: dict, seed: int) -> tuple[dict[int, dict], np.ndarray]:
    """One tree on the cells' sums (count, label sum, label squares): its nodes by number, the root being 1, and each cell's node."""
    n_features, wide = bins.shape[1], max(len(c) for c in cuts) + 1
    splits = np.array([len(c) for c in cuts])
    base = bins.astype(np.int64) + np.arange(n_features) * wide
    rng, node_of = _JavaRandom(seed), np.ones(len(bins), np.int64)
    total = sums.sum(axis=1)
    tree = {1: {"stats": total, "impurity": float(_impurity(*total)), "leaf": True, "gain": -1.0}}
    opened = [1]
    for level in range(p["maxDepth"] + 1):
        if not opened:
            break
        tried = [_drawn(n_features, p["per_node"], rng.long()) if p["per_node"] < n_features else [*range(n_features)] for _ in opened]
        if level == p["maxDepth"]:
            break
        place = np.full(2 << level, -1)
        place[opened] = np.arange(len(opened))
        own = place[node_of] if level else np.zeros(len(bins), np.int64)
        here = np.flatnonzero(own >= 0)
        at = (base[here] + own[here, None] * (n_features * wide)).ravel()
        cells = [np.bincount(at, np.repeat(s[here], n_features), len(opened) * n_features * wide).reshape(-1, n_features, wide).cumsum(axis=2) for s in sums]
        left, whole = np.stack([c[:, :, :-1] for c in cells]), np.stack([c[:, :, -1:] for c in cells])
        right = whole - left
        impurity = np.array([tree[n]["impurity"] for n in opened])[:, None, None]
        li, ri = _impurity(*left), _impurity(*right)
        all_rows = left[0] + right[0]
        few = (left[0] < p["minInstancesPerNode"]) | (right[0] < p["minInstancesPerNode"]) | (np.arange(wide - 1) >= splits[:, None])
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = impurity - left[0] / all_rows * li - right[0] / all_rows * ri
            share = np.where(few | ~(gain >= p["minInfoGain"]) | ~(gain > 0), -np.inf, np.round(gain / impurity, GAIN_DIGITS))
        best = share.argmax(axis=2) if wide > 1 else np.zeros(share.shape[:2], int)
        most = share.max(axis=2, initial=-np.inf)
        grown = []
        for i, n in enumerate(opened):
            f = tried[i][int(most[i, tried[i]].argmax())]
            if most[i, f] == -np.inf:
                continue
            b = int(best[i, f])
            tree[n] |= {"leaf": False, "gain": float(gain[i, f, b]), "feature": f, "bin": b, "cut": float(cuts[f][b])}
            for child, side, own_impurity in ((2 * n, left, li), (2 * n + 1, right, ri)):
                tree[child] = {"stats": side[:, i, f, b], "impurity": float(own_impurity[i, f, b]), "leaf": True, "gain": -1.0}
                if level + 1 < p["maxDepth"] and abs(tree[child]["impurity"]) >= EPSILON:
                    grown.append(child)
            rows = here[own[here] == i]
            node_of[rows] = 2 * n + (bins[rows, f] > b)
        opened = grown[::-1]
    for n in sorted(tree, reverse=True):
        node = tree[n]
        node["prediction"] = float(node["stats"][1] / node["stats"][0]) if node["stats"][0] else 0.0
        if not node["leaf"] and tree[2 * n]["leaf"] and tree[2 * n + 1]["leaf"] and tree[2 * n]["prediction"] == tree[2 * n + 1]["prediction"]:
            node |= {"leaf": True, "gain": -1.0, "merged": tree[2 * n]["prediction"]}
    value = np.array([tree.get(n, {}).get("prediction", 0.0) for n in range(max(tree) + 1)])
    return tree, value[node_of]


def _node_rows(number: int, tree: dict[int, dict], center: float) -> list[tuple]:
    """The tree's nodes as Spark saves them: numbered in the order root, left, right."""
    rows: list = []

    def add(n: int) -> int:
        node, at = tree[n], len(rows)
        rows.append(None)
        ends = node["leaf"]
        children = (-1, -1) if ends else (add(2 * n), add(2 * n + 1))
        split = (-1, [], -1) if ends else (node["feature"], [node["cut"]], -1)
        count, total, squares = (float(v) for v in node["stats"])
        stats = [count, total + center * count, squares + 2 * center * total + center * center * count]
        value = node.get("merged", node["prediction"]) + center
        rows[at] = (number, (at, value, node["impurity"], stats, int(count), node["gain"], *children, split))
        return at

    add(1)
    return rows


# --- the fit --------------------------------------------------------------------------------------------------


def _asked(estimator: GBTRegressor) -> dict | None:
    """The parameters of a fit that can be grown on cells."""
    value = {p.name: v for p, v in estimator.extractParamMap().items()}
    if value["lossType"] != "squared" or value["minWeightFractionPerNode"] > 0 or value.get("validationIndicatorCol") or value.get("weightCol"):
        return None
    share = str(value["featureSubsetStrategy"])
    try:
        value["features"] = 1.0 if share in ("all", "auto") else int(share) if share.isdigit() and int(share) else float(share)
    except ValueError:
        return None
    return value if isinstance(value["features"], int) or 0 < value["features"] <= 1 else None


def fit(estimator: GBTRegressor, ready: DataFrame, features: list[str], label: str) -> GBTRegressionModel | None:
    """The model that ``estimator`` fits to ``ready`` (label and features as doubles), or None where it is to fit the rows itself."""
    p, spark = _asked(estimator), ready.sparkSession
    if p is None or not features:
        return None
    names = [f"`{f}`" for f in features]
    x, y = [(F.col(n) + 0.0).alias(f"x{i}") for i, n in enumerate(names)], F.col(label)
    rows = ready.select(*x, y.alias("y"))
    keys = [f"x{i}" for i in range(len(features))]
    # no label or feature that Spark's fit refuses
    odd = (F.col("y").isNull() | ~(F.abs("y") < float("inf"))).cast("int")
    found = written_once(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.max(odd).alias("odd")), "cells")
    size = found.agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.max("odd").alias("odd")).first()
    if not size.cells or size.cells > CELLS_MOST or size.n < ROWS_A_CELL * size.cells or size.odd:
        return None
    known = found.select(*keys, "n").toArrow()
    values = np.column_stack([known.column(k).to_numpy() for k in keys]) + 0.0
    if not np.isfinite(values).all():
        return None
    counts, center, trees = known.column("n").to_numpy().astype(float), size.s / size.n, p["maxIter"]
    p["per_node"] = min(p["features"], len(features)) if isinstance(p["features"], int) else math.ceil(p["features"] * len(features))
    cuts = [_cuts(values[:, i], counts, min(p["maxBins"], size.n) - 1) for i in range(len(features))]
    bins = np.column_stack([np.searchsorted(c, values[:, i], "left") for i, c in enumerate(cuts)])

    cells = {v.tobytes(): i for i, v in enumerate(values)}
    dealt = rows.mapInArrow(_sampled(cells, trees, p["subsamplingRate"], p["seed"]), "cell int, y double, bits binary")
    summed = dealt.repartition("cell").mapInArrow(_summed(trees, center), "cell int, chunk int, n array<double>, s array<double>, q array<double>")
    sums = written_once(summed, "sums")

    prediction, nodes = np.zeros(len(cells)), []  # of labels around the center; the first tree's own
    for t in range(trees):
        at = t % TREES_AT_ONCE
        if at == 0:
            chunk = sums.where(F.col("chunk") == t).toArrow()
            held = np.zeros((3, len(cells), min(TREES_AT_ONCE, trees - t)))
            held[:, chunk.column("cell").to_numpy()] = [np.stack(chunk.column(c).combine_chunks().flatten().to_numpy().reshape(-1, held.shape[2])) for c in "nsq"]
        n, s, q = held[:, :, at]
        if t:  # twice the label's distance from the prediction
            n, s, q = n, 2 * (s - n * prediction), 4 * (q - 2 * prediction * s + n * prediction**2)
        tree, value = _grown(bins, cuts, np.stack([n, s, q]), p, p["seed"] + t)
        prediction = prediction + (p["stepSize"] if t else 1.0) * value
        nodes += _node_rows(t, tree, 0.0 if t else center)
    return _model(estimator, spark, nodes, trees, len(features), p["stepSize"])


def _model(estimator: GBTRegressor, spark, nodes: list[tuple], trees: int, n_features: int, step: float) -> GBTRegressionModel:
    """Spark's own model of these nodes, by the files in which it is kept."""
    at = work_path(spark, "trees")

    def metadata(of, name: str, more: dict | None = None) -> str:
        plain = json.loads(DefaultParamsWriter._get_metadata_to_save(of, spark.sparkContext, more))
        return json.dumps(plain | {"class": f"org.apache.spark.ml.regression.{name}"})

    whole = metadata(estimator, "GBTRegressionModel", {"numFeatures": n_features, "numTrees": trees})
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{at}/metadata")
    own = json.loads(metadata(estimator, "DecisionTreeRegressionModel"))
    of_tree = {"cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB", "minInfoGain",
               "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed"}
    for params in ("paramMap", "defaultParamMap"):
        own[params] = {k: v for k, v in own[params].items() if k in of_tree}
    described = [(t, json.dumps(own | {"uid": f"{own['uid']}_{t}"}), step if t else 1.0) for t in range(trees)]
    spark.createDataFrame(described, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{at}/treesMetadata")
    spark.createDataFrame(nodes, NODES).coalesce(1).write.parquet(f"{at}/data")
    return GBTRegressionModel.load(at)


# --- scores ---------------------------------------------------------------------------------------------------


def scorer(model: GBTRegressionModel, spark):
    """A function of an array of the model's features that gives its prediction; each different array of a task's rows is walked once."""
    model.write().save(at := work_path(spark, "trees"))
    d, split = F.col("nodeData"), F.col("nodeData.split")
    saved = spark.read.parquet(f"{at}/data").select(
        "treeID", d["id"].alias("id"), d["prediction"].alias("value"), d["leftChild"].alias("left"), d["rightChild"].alias("right"),
        split["featureIndex"].alias("f"), F.get(split["leftCategoriesOrThreshold"], 0).alias("cut"), split["numCategories"].alias("kinds"),
    ).orderBy("treeID", "id").toArrow()
    if max(saved.column("kinds").to_pylist()) >= 0:
        raise ValueError("the model has categorical features")
    tree, left, right, feature, value = (saved.column(c).to_numpy() for c in ("treeID", "left", "right", "f", "value"))
    roots = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])
    own, ends = np.arange(len(tree)), left < 0
    # a leaf leads to itself
    left, right = (np.where(ends, own, roots[tree] + side) for side in (left, right))
    feature, cut = np.where(ends, 0, feature), np.where(ends, 0.0, np.array([c or 0.0 for c in saved.column("cut").to_pylist()]))
    weights, depth = np.array(model.treeWeights), model.getMaxDepth()

    def walk(x: np.ndarray) -> np.ndarray:
        node, row = np.repeat(roots[None], len(x), axis=0), np.arange(len(x))[:, None]
        for _ in range(depth):
            node = np.where(x[row, feature[node]] <= cut[node], left[node], right[node])
        return value[node] @ weights

    @F.arrow_udf("double")
    def score(features: pa.Array) -> pa.Array:
        if not len(features):
            return pa.array([], pa.float64())
        x = features.flatten().to_numpy(zero_copy_only=False).reshape(len(features), -1) + 0.0
        if np.isnan(x).any():
            raise ValueError("a feature is NaN")
        data, wide = x.tobytes(), 8 * x.shape[1]
        keys = [data[i : i + wide] for i in range(0, len(data), wide)]
        place = {k: i for i, k in enumerate(keys)}
        found = np.concatenate([walk(x[at]) for at in np.array_split(np.array([*place.values()]), len(place) // 1000 + 1)])
        known = dict(zip(place, found.tolist()))
        return pa.array([known[k] for k in keys], pa.float64())

    return score
