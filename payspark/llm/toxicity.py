"""Toxicity by cumulative-link ordinal regression on sparse text features.

One weight vector is shared by all grades; ordered thresholds cut its score into severity grades:
P(grade <= k) = sigmoid(threshold_k - w.x) with threshold_0 < threshold_1 < ...  The features of a text are the words it
holds and the letter sequences in them (lower case, present or not), so a few words count as much in a long text as in a short one.  ``fit`` learns from a bounded sample of labelled
rows (``max_rows`` per class, drawn by a hash of the id; class sizes are counted over all labels and undo the drawing
in the loss); every document is scored whole.

``labels`` with a ``grade`` column (0 = harmless, at most MAX_GRADE) are used as they are.  Labels that only say toxic or not are graded
by how many different words with a feature typical of toxic rows a toxic row holds: the thirds of the toxic rows by that number are
grades 1, 2 and 3 (equal numbers share a grade, so fewer grades may come out).

Defined cases: null and empty texts hold no word and get the severity of the bare thresholds; rows with a null label or id teach nothing;
labels of one kind only give a model without words that finds nothing toxic; repeated rows are scored each; an
empty table gives an empty result; other columns of ``df`` are ignored by ``score`` and kept by ``drop_toxic``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage, text_of
from .exact_dedup import arrow_schema
from .near_dedup import shingles

MAX_ROWS = 4000
MAX_FEATURES = 4096
LETTERS = re.compile(r"[^\W\d_]+")
GRAMS = (4, 5)
GRADES = 3
MAX_GRADE = 20
CACHED_WORDS = 300_000


def features_of(word: str) -> set[str]:
    """A word as ``<word>`` and its letter sequences of GRAMS lengths: invented forms of a stem share those."""
    return {f"<{word}>", *(word[i : i + n] for n in GRAMS for i in range(len(word) - n + 1))}


class WordFeatures(dict):
    """Word -> numbers of the known features it holds, found when first asked for."""

    def __init__(self, number: dict[str, int]):
        super().__init__()
        self.number = number

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > CACHED_WORDS:
            self.clear()
        found = self[word] = tuple(self.number[f] for f in features_of(word) & self.number.keys())
        return found

    def of_text(self, text: str) -> tuple[set[int], int]:
        """The features of a text and how many of its different words hold one."""
        held = [f for f in map(self.__getitem__, set(LETTERS.findall(text.lower()))) if f]
        return set().union(*held), len(held)


@dataclass
class OrdinalModel:
    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = (10.0, 11.0, 12.0)

    def scorer(self):
        """text -> w.x, with a cache of words."""
        words, w = WordFeatures({f: i for i, f in enumerate(self.weights)}), list(self.weights.values())
        return lambda text: sum(w[i] for i in words.of_text(text)[0])

    def at_least(self, score: float) -> list[float]:
        """P(grade >= 1), P(grade >= 2), ..."""
        return [1 / (1 + math.exp(min(700.0, t - score))) for t in self.thresholds]


def draw_labelled(df: DataFrame, labels: DataFrame, label: str, text: str, id_col: str, max_rows: int, seed: int) -> tuple[DataFrame, dict]:
    """At most ``max_rows`` labelled rows of each class with their texts, and the class sizes over all labels.

    The drawn ids are bounded by ``max_rows`` per class and so may be broadcast.
    """
    known = labels.select(F.col(id_col).alias("__id"), F.col(label).alias("__label")).where("__id IS NOT NULL AND __label IS NOT NULL")
    sizes = {r["__label"]: r["n"] for r in known.groupBy("__label").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.pmod(F.xxhash64(F.lit(seed), "__id"), F.lit(1_000_000))
    drawn = None
    for value, n in sizes.items():
        share = min(1.0, 0.95 * max_rows / n)
        part = known.where((F.col("__label") == value) & (place < int(share * 1_000_000))).limit(max_rows)
        drawn = part if drawn is None else drawn.unionByName(part)
    if drawn is None:
        drawn = known
    texts = df.select(F.col(id_col).alias("__id"), text_of(text).alias("__text"))
    return texts.join(F.broadcast(drawn), "__id").select("__id", "__label", "__text"), sizes


def _with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Label, text and the least shingle hash, which near copies mostly share."""
    for b in batches:
        keys = [int(s[0][0]) - (1 << 63) if len((s := shingles(t))[0]) else 0 for t in b.column(1).to_pylist()]
        yield pa.record_batch([b.column(0), b.column(1), pa.array(keys, pa.int64())], names=["label", "text", "key"])


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = {True: Counter(), False: Counter()}
    for b in batches:
        for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            counts[label > 0].update(set().union(*map(features_of, set(LETTERS.findall(text.lower())))))
    for toxic, found in counts.items():
        names, n = list(found), list(found.values())
        for i in range(0, len(names), 50_000):
            part = n[i : i + 50_000]
            yield pa.record_batch([pa.array(names[i : i + 50_000]), pa.array(part if toxic else [0] * len(part), pa.int64()),
                                   pa.array([0] * len(part) if toxic else part, pa.int64())], names=["feature", "a", "b"])


def typical_features(sample: DataFrame, max_features: int) -> dict[str, float]:
    """z-score of each feature's log odds between toxic and harmless rows, for the features that tell them apart best."""
    n = {r["toxic"]: r["n"] for r in sample.groupBy((F.col("label") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return {}
    found = sample.select("label", "text").mapInArrow(_count_features, "feature string, a bigint, b bigint")
    found = found.groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where("a + b >= 4")
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    c, d = n[True] + 1 - a, n[False] + 1 - b
    z = (F.log(a / c) - F.log(b / d)) / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    rows = found.select("feature", z.alias("z")).where(F.abs("z") >= 3.0).orderBy(F.desc(F.abs("z")), "feature").limit(max_features).collect()
    return {r["feature"]: r["z"] for r in rows}


def _as_features(names: list[str], positive: set[int]):
    """Per sample row its label, its features and how many of its words hold one typical of toxic rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordFeatures({f: i for i, f in enumerate(names)})
        for b in batches:
            texts = b.column(1).to_pylist()
            held = [sorted(words.of_text(t)[0]) for t in texts]
            marked = [sum(not positive.isdisjoint(words[w]) for w in set(LETTERS.findall(t.lower()))) for t in texts]
            yield pa.record_batch([b.column(0), pa.array(held, pa.list_(pa.int32())), pa.array(marked, pa.int64())], names=["label", "held", "marked"])

    return run


def graded_by_count(toxic: np.ndarray, marked: np.ndarray, grades: int = GRADES) -> np.ndarray:
    """0 for harmless rows; toxic rows by equal parts of their numbers of marked words, from 1 on without gaps."""
    out = np.zeros(len(toxic), np.int64)
    if toxic.any():
        cuts = np.unique(np.quantile(marked[toxic], np.arange(1, grades) / grades, method="inverted_cdf"))
        out[toxic] = 1 + np.unique(np.searchsorted(cuts, marked[toxic], side="left"), return_inverse=True)[1]
    return out


def fit_thresholds(
    rows: np.ndarray, cols: np.ndarray, grades: np.ndarray, sample_weight: np.ndarray, n_words: int, n_grades: int,
    l2: float = 1e-4, steps: int = 300, rate: float = 0.1,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by Adam on the cumulative-link likelihood; (rows, cols) list the words present."""
    n, cuts = len(grades), n_grades - 1
    total = sample_weight.sum()
    p = np.zeros(n_words + cuts)
    for k in range(cuts):  # thresholds: the first, then logs of the steps between
        share = min(max(sample_weight[grades <= k].sum() / total, 1e-4), 1 - 1e-4)
        p[n_words + k] = math.log(share / (1 - share)) if k == 0 else 0.0
    m, v = np.zeros_like(p), np.zeros_like(p)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -35, 35)))
    for step in range(1, steps + 1):
        w, first, gaps = p[:n_words], p[n_words], np.exp(p[n_words + 1 :])
        theta = first + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(rows, w[cols], n)
        upper = sigmoid(theta[np.minimum(grades, cuts - 1)] - score)
        upper[grades == cuts] = 1.0
        lower = sigmoid(theta[np.maximum(grades - 1, 0)] - score)
        lower[grades == 0] = 0.0
        mass = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / mass, lower * (1 - lower) / mass
        g_score = sample_weight * (du - dl) / total
        g_theta = np.bincount(np.minimum(grades, cuts - 1), -sample_weight * du / total, cuts)
        g_theta += np.bincount(np.maximum(grades - 1, 0), sample_weight * dl / total, cuts)
        g = np.empty_like(p)
        g[:n_words] = np.bincount(cols, g_score[rows], n_words) + l2 * w
        g[n_words] = g_theta.sum()
        g[n_words + 1 :] = np.cumsum(g_theta[::-1])[::-1][1:] * gaps
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return p[:n_words], p[n_words] + np.concatenate([[0.0], np.cumsum(np.exp(p[n_words + 1 :]))])


def fit(
    df: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "toxic",
    max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES, seed: int = 5,
) -> OrdinalModel:
    """The model; the feature numbers of at most ``max_rows`` rows per class come to the driver, near copies once."""
    graded = "grade" in labels.columns
    if graded:  # so many classes at most, as their sizes come to the driver
        labels = labels.withColumn("grade", F.greatest(F.lit(0), F.least(F.lit(MAX_GRADE), F.col("grade").cast("int"))))
    drawn, sizes = draw_labelled(df, labels, "grade" if graded else label, text, id_col, max_rows, seed)
    keyed = drawn.select(F.col("__label").cast("bigint"), "__text").mapInArrow(_with_key, "label bigint, text string, key bigint")
    sample = stage(keyed.dropDuplicates(["label", "key"]), "labelled")
    z = typical_features(sample, max_features)
    if not z:
        return OrdinalModel()
    positive = {i for i, score in enumerate(z.values()) if score > 0}
    made = sample.select("label", "text").mapInArrow(_as_features(list(z), positive), "label bigint, held array<int>, marked bigint").toArrow()
    label_of, marked = made.column("label").to_numpy(), made.column("marked").to_numpy()
    held = made.column("held").combine_chunks()
    rows = np.repeat(np.arange(len(label_of)), np.diff(held.offsets.to_numpy()))
    cols = held.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    grades = label_of if graded else graded_by_count(label_of > 0, marked)
    weight = np.ones(len(grades))
    for g, n in sizes.items():
        weight[label_of == g] = n / max(1, (label_of == g).sum())
    w, theta = fit_thresholds(rows, cols, grades, weight, len(z), max(2, int(grades.max()) + 1))
    return OrdinalModel(dict(zip(z, w.tolist())), tuple(theta.tolist()))


def _score(model: OrdinalModel, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_of = model.scorer()
        for b in batches:
            severity, grade, toxic = [], [], []
            for text in b.column(b.num_columns - 1).to_pylist():
                p = model.at_least(score_of(text))
                severity.append(sum(p))
                grade.append(sum(x >= 0.5 for x in p))
                toxic.append(p[0])
            made = [pa.array(severity, pa.float64()), pa.array(grade, pa.int32()), pa.array(toxic, pa.float64())]
            yield pa.record_batch([*b.columns[:-1], *made], schema=schema)

    return run


def score(df: DataFrame, model: OrdinalModel, text: str = "text", columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` with expected_severity (sum of P(grade >= k)), grade (the median grade) and p_toxic = P(grade >= 1)."""
    picked = df.select(*[F.col(f"`{c}`") for c in columns], text_of(text).alias("__text"))
    schema = T.StructType(picked.schema[:-1].fields).add("expected_severity", "double").add("grade", "integer").add("p_toxic", "double")
    return picked.mapInArrow(_score(model, arrow_schema(df.sparkSession, schema)), schema)


def _harmless(model: OrdinalModel, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_of = model.scorer()
        for b in batches:
            keep = [model.at_least(score_of(t or ""))[0] < 0.5 for t in b.column(text_at).to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    return run


def drop_toxic(df: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """The rows of ``df`` of grade 0, with their own columns; no shuffle."""
    return df.mapInArrow(_harmless(model, df.columns.index(text)), df.schema)
