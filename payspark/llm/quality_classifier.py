"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are all it learns from.  With class prior pi, positive risk R_p+ and the
risks R_p- and R_u- of calling a row negative, it minimises the non-negative risk
``pi * R_p+ + max(0, R_u- - pi * R_p-)``: when the bracket falls below zero the step goes back up that part, which keeps
a flexible model from calling every unlabelled row negative.  The prior is estimated first: a plain positive-against-
unlabelled classifier is fitted on either half of the rows, and on the other half the ratio of unlabelled to positive tails, at
the cut with the least upper confidence bound, is the share of positives among the unlabelled.

Features are shapes of the text (lengths, repetition, symbols, capitals, variety), cut at their quantiles over the
unlabelled sample, so the model is additive with free steps per feature.  They are measured once per document over the whole text and
written to the shared folder; fitting reads at most ``max_positive`` and ``max_unlabelled`` rows of them, drawn by a hash of the id,
and scoring reads them all.

Defined cases: null and empty texts have all features zero and are scored like any other; without any positive every
score is the prior 0.5; rows with a null id are scored and never drawn; repeated rows are scored each; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage, text_of
from .exact_dedup import arrow_schema
from .quality_rules import SYMBOLS, WHITE, Document

MAX_POSITIVE = 8000
MAX_UNLABELLED = 20000
BINS = 24
DIGITS = b"0123456789"
FEATURES = (
    "log_words", "word_length", "symbols", "pipes", "exclamations", "digits", "capitals", "stops", "commas", "duplicate_lines",
    "repeated_windows", "stutter", "wordless", "distinct", "top_word", "line_words", "distinct_pairs", "spread",
)


def shape(text: bytes) -> list[float]:
    """The features of one text, all zero when it has no word."""
    d = Document(text)
    n, words = d.n_words, d.words
    if not n:
        return [0.0] * len(FEATURES)
    size = len(text)
    counts = Counter(words)
    letters = d.n_capitals + d.n_small
    return [
        math.log1p(n),
        d.word_chars / n,
        d.n_symbols / n,
        text.count(b"|") / n,
        text.count(b"!") / n,
        (size - len(text.translate(None, DIGITS))) / size,
        d.n_capitals / letters if letters else 0.0,
        text.count(b".") / n,
        text.count(b",") / n,
        d.n_dup_lines / len(d.lines),
        d.n_repeat_words / n,
        d.n_stutter / n,
        d.n_wordless / n,
        len(counts) / n,
        max(counts.values()) / n,
        math.log1p(n / len(d.lines)),
        len(set(zip(words, words[1:]))) / n,
        (size - len(text.translate(None, WHITE + SYMBOLS))) / size,
    ]


def _measure(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shapes = [shape(t) for t in b.column(b.num_columns - 1).cast(pa.binary()).to_pylist()]
            yield pa.record_batch([*b.columns[:-1], pa.array(shapes, pa.list_(pa.float32()))], schema=schema)

    return run


def measured(df: DataFrame, text: str = "text", columns: tuple[str, ...] = ("doc_id",), extra: dict[str, Column] | None = None) -> DataFrame:
    """``columns``, ``extra`` and the features of every row, written once."""
    made = [c.alias(n) for n, c in (extra or {}).items()]
    picked = df.select(*[F.col(f"`{c}`") for c in columns], *made, text_of(text).alias("__text"))
    schema = T.StructType(picked.schema[:-1].fields).add("features", T.ArrayType(T.FloatType()))
    return stage(picked.mapInArrow(_measure(arrow_schema(df.sparkSession, schema)), schema), "shapes")


@dataclass
class PuModel:
    edges: list[np.ndarray]
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        columns, _ = binned(x, self.edges)
        return 1 / (1 + np.exp(-np.clip(self.weights[columns].sum(axis=1) + self.bias, -30, 30)))


def quantile_edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Inner quantiles of each feature, with a cut just above zero where a feature is mostly zero."""
    edges = []
    for column in x.T:
        above = column[column > 0]
        cuts = np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]) if len(column) else np.zeros(0)
        more = np.quantile(above, np.linspace(0, 1, bins // 2 + 1)[1:-1]) if len(above) else np.zeros(0)
        edges.append(np.unique(np.concatenate([cuts, more])))
    return edges


def binned(x: np.ndarray, edges: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """Per row and feature the number of its step, over all features, and how many steps there are."""
    columns, first = np.empty(x.shape, dtype=np.int64), 0
    for j, e in enumerate(edges):
        columns[:, j] = first + np.searchsorted(e, x[:, j], side="right")
        first += len(e) + 1
    return columns, first


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(gradient, size: int, steps: int, rate: float) -> np.ndarray:
    p, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, steps + 1):
        g = gradient(p)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return p


def _pull(columns: np.ndarray, slope: np.ndarray, n: int) -> np.ndarray:
    """Gradient over weights and bias of the mean of a loss whose slope at each row's score is ``slope``."""
    g = np.bincount(columns.ravel(), np.repeat(slope, columns.shape[1]), n)
    return np.append(g, slope.sum()) / max(1, len(slope))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, n: int, sure: float = 1.0) -> float:
    """Share of positives among the unlabelled, from tails of a classifier that tells the two samples apart.

    Each half of the rows is scored by the classifier of the other half.
    """
    tails: tuple[list, list] = ([], [])
    for k in (0, 1):
        half_p, half_u = positive[k::2], unlabelled[k::2]

        def gradient(p, half_p=half_p, half_u=half_u):
            up = _pull(half_p, _sigmoid(p[half_p].sum(axis=1) + p[-1]) - 1, n)
            down = _pull(half_u, _sigmoid(p[half_u].sum(axis=1) + p[-1]), n)
            return up + down + 1e-2 * np.append(p[:-1], 0)

        p = _descend(gradient, n + 1, 150, 0.05)
        for tail, rows in zip(tails, (positive[1 - k :: 2], unlabelled[1 - k :: 2])):
            tail.append(p[rows].sum(axis=1) + p[-1])
    tail_p, tail_u = (np.sort(np.concatenate(t)) for t in tails)
    cuts = np.unique(tail_p)
    q_p = 1 - np.searchsorted(tail_p, cuts, side="left") / len(tail_p)
    q_u = 1 - np.searchsorted(tail_u, cuts, side="left") / len(tail_u)
    keep = (q_p >= 0.3) & (q_u > 0)
    if not keep.any():
        return 0.5
    q_p, q_u = q_p[keep], q_u[keep]
    doubt = q_u / q_p * np.sqrt((1 - q_u) / (q_u * len(tail_u)) + (1 - q_p) / (q_p * len(tail_p)))
    best = np.argmin(q_u / q_p + sure * doubt)
    return float(min(0.98, max(0.02, q_u[best] / q_p[best])))


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, l2: float = 3e-4, steps: int = 400, rate: float = 0.05) -> PuModel:
    """Non-negative PU learning with the logistic loss on rows of features."""
    if not len(positive) or not len(unlabelled):
        return PuModel([], np.zeros(1), 0.0, 0.5)
    edges = quantile_edges(unlabelled, max(6, min(BINS, len(unlabelled) // 80)))
    p_bins, n = binned(positive, edges)
    u_bins, _ = binned(unlabelled, edges)
    pi = estimate_prior(p_bins, u_bins, n) if prior is None else prior

    def gradient(w):
        z_p, z_u = w[p_bins].sum(axis=1) + w[-1], w[u_bins].sum(axis=1) + w[-1]
        risk = np.logaddexp(0, z_u).mean() - pi * np.logaddexp(0, z_p).mean()
        negative = _pull(u_bins, _sigmoid(z_u), n) - pi * _pull(p_bins, _sigmoid(z_p), n)
        positive_part = pi * _pull(p_bins, _sigmoid(z_p) - 1, n)
        return (positive_part + negative if risk >= 0 else -negative) + l2 * np.append(w[:-1], 0)

    w = _descend(gradient, n + 1, steps, rate)
    return PuModel(edges, w[:-1], float(w[-1]), pi)


def fit(
    shapes: DataFrame, positives: DataFrame, id_col: str = "doc_id",
    max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, seed: int = 3,
) -> PuModel:
    """``shapes``: rows to learn from (see ``measured``); ``positives``: ids of trusted positives.

    Both samples are drawn by a hash of the id and bounded by ``max_positive`` and ``max_unlabelled``.
    """
    def drawn(df: DataFrame, bound: int) -> DataFrame:
        share = min(1.0, 0.95 * bound / max(1, df.count()))
        place = F.pmod(F.xxhash64(F.lit(seed), id_col), F.lit(1_000_000))
        return df.where(F.col(id_col).isNotNull() & (place < int(share * 1_000_000))).limit(bound)

    ids = drawn(positives.select(id_col).distinct(), max_positive)
    p = shapes.join(F.broadcast(ids), id_col, "left_semi").limit(max_positive)
    return fit_pu(_matrix(p), _matrix(drawn(shapes, max_unlabelled)))


def _matrix(df: DataFrame) -> np.ndarray:
    rows = df.select("features").toArrow().column("features").combine_chunks()
    return rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), len(FEATURES))


def _apply(model: PuModel, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            x = b.column(b.num_columns - 1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, len(FEATURES))
            s = model.score(x) if model.edges else np.full(n, model.prior)
            yield pa.record_batch([*b.columns[:-1], pa.array(s, pa.float64())], schema=schema)

    return run


def score(shapes: DataFrame, model: PuModel) -> DataFrame:
    """``shapes`` with ``score`` (the estimated chance of good quality) in place of its features."""
    columns = [c for c in shapes.columns if c != "features"]
    schema = T.StructType(shapes.select(*columns).schema.fields).add("score", "double")
    return shapes.select(*columns, "features").mapInArrow(_apply(model, arrow_schema(shapes.sparkSession, schema)), schema)
