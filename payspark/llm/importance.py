"""Target-distribution importance resampling with a head-tail vocabulary.

Features are the runs of 1 to ``max_run`` consecutive words of a text; a feature's bucket is its crc32 modulo the number of buckets.  What
a bucket gains is the logarithm of its share in the target texts over its share in all documents; a document's weight is
the mean gain of its features, and seeded Gumbel noise on the weights makes the highest scores a weighted draw without replacement.

The head is found first: every task counts its words and pairs and names those with at least ``head_share`` of its own, of which there
are at most 1 / ``head_share``; any word with that share of the corpus has it in some task.  Words whose named counts reach half that
share of all are the head, at most 2 / ``head_share`` of them, and so are pairs.  Their crc32 states (of words, from which a longer feature's
checksum is carried on) and buckets (of pairs) are broadcast.  Every other feature's checksum is taken when it is met.  The head decides
speed alone: bucket totals are exact over all documents, whichever words are in it.  A task sends one row per bucket.

Defined cases: null and empty texts have no words, no features and the weight 0; repeated rows and ids are drawn each for
itself, equal scores in the order of their ids, null ids last and hashed as empty; a text of any length is read whole, in slices cut between words;
without documents of enough words, or with an empty target, the draw goes by the same formula (an empty target gives every bucket
the share of an unseen one); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import with_positions
from .common import UID, numbered, stage

BUCKETS = 10_000
MAX_RUN = 2
HEAD_SHARE = 1 / 20_000
COUNTED = 400_000
SLICE_BYTES = 1 << 20
SEED = 2024
DRAWN_PERCENT = 10
LEAST_WORDS = 20

#: A-Z in lower case; digits, letters and all bytes above ASCII as they are; anything else parts words.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def word_slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in order, in slices of about SLICE_BYTES that end between words."""
    plain, at = text.translate(LETTERS), 0
    while at < len(plain):
        end = len(plain) if len(plain) - at <= SLICE_BYTES else plain.find(b" ", at + SLICE_BYTES)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def runs(text: bytes | None, max_run: int) -> Iterator[tuple[int, Iterable]]:
    """(n, the n-word runs) of a text, slice by slice: words themselves for n = 1, tuples of words otherwise."""
    tail: list[bytes] = []
    for words in word_slices(text or b""):
        yield 1, words
        if max_run > 1:
            joined = tail + words
            for n in range(2, max_run + 1):
                first = max(0, len(tail) - n + 1)  # runs that lie in earlier slices alone have been given
                yield n, zip(*(joined[first + k :] for k in range(n)))
            tail = joined[-(max_run - 1) :]


class WordStates(dict):
    """crc32 of head words; that of another word is taken when it is met."""

    def __missing__(self, word: bytes) -> int:
        return crc32(word)


class Buckets(dict):
    """What a feature's bucket is worth: from the head's table, or from the checksum carried on from its first word's state."""

    def __init__(self, states: WordStates, values: list[int], head: Iterable = ()):
        super().__init__()
        self.states, self.values, self.size = states, values, len(values)
        self.update((feature, self.__missing__(feature)) for feature in head)

    def __missing__(self, feature) -> int:
        if isinstance(feature, bytes):
            return self.values[self.states[feature] % self.size]
        state = self.states[feature[0]]
        for word in feature[1:]:
            state = crc32(word, crc32(b" ", state))
        return self.values[state % self.size]


def _worth(head: tuple[list, list], values: list[int]) -> Buckets:
    words, pairs = head
    return Buckets(WordStates((w, crc32(w)) for w in words), values, [*words, *map(tuple, pairs)])


def _texts(df: DataFrame, text: str) -> DataFrame:
    return df.select(F.col(text).cast("string").cast("binary").alias("text"))


def _named(max_run: int, share: float):
    """Per task: its words and pairs with at least ``share`` of its own, and a row with the number of them all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = {n: Counter() for n in range(1, min(max_run, 2) + 1)}, Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for n, features in runs(text, min(max_run, 2)):
                    features = list(features)
                    counts[n].update(features)
                    totals[n] += len(features)
                    if len(counts[n]) > COUNTED:  # counts of rare ones may be lost: they are not the head
                        least = share * totals[n] / 2
                        counts[n] = Counter({f: c for f, c in counts[n].items() if c >= least})
        for n, found in counts.items():
            named = [(f, c) for f, c in found.items() if c >= share * totals[n]]
            features = [f if n == 1 else b" ".join(f) for f, _ in named]
            rows = [[n] * (len(named) + 1), [*features, None], [*(c for _, c in named), totals[n]]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.int32(), pa.binary(), pa.int64()))], ["n", "feature", "count"])

    return run


def head_vocabulary(df: DataFrame, max_run: int = MAX_RUN, head_share: float = HEAD_SHARE, text: str = "text") -> tuple[list, list]:
    """The frequent words and pairs of ``df``, at most 2 / ``head_share`` of each."""
    named = stage(_texts(df, text).mapInArrow(_named(max_run, head_share), "n int, feature binary, count bigint"), "named")
    totals = {r.n: r.total for r in named.where("feature IS NULL").groupBy("n").agg(F.sum("count").alias("total")).collect()}
    head: tuple[list, list] = ([], [])
    for n, total in totals.items():
        frequent = named.where((F.col("n") == n) & F.col("feature").isNotNull()).groupBy("feature").agg(F.sum("count").alias("c"))
        rows = frequent.where(F.col("c") >= head_share * (total or 0) / 2).select("feature").collect()
        head[n - 1].extend(bytes(r.feature) if n == 1 else tuple(bytes(r.feature).split(b" ")) for r in rows)
    return head


def _totalled(max_run: int, buckets: int, head):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of = _worth(head.value, list(range(buckets)))
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for _, features in runs(text, max_run):
                    totals += np.bincount(np.fromiter(map(bucket_of.__getitem__, features), np.int64), minlength=buckets)
        met = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(totals[met])], ["bucket", "count"])

    return run


def bucket_totals(df: DataFrame, head, max_run: int = MAX_RUN, buckets: int = BUCKETS, text: str = "text") -> DataFrame:
    """(bucket, count) of all features of all rows; ``head`` is a broadcast head vocabulary."""
    met = _texts(df, text).mapInArrow(_totalled(max_run, buckets, head), "bucket int, count bigint")
    return met.groupBy("bucket").agg(F.sum("count").alias("count"))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """A bucket's gain in thousandths: the logarithm of its smoothed share in ``target`` over that in ``raw``."""
    spark = raw.sparkSession
    both = (
        spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
        .join(raw.select("bucket", F.col("count").alias("s")), "bucket", "left")
        .join(target.select("bucket", F.col("count").alias("t")), "bucket", "left")
        .select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("s", "t")])
    )
    held = both.agg(F.sort_array(F.collect_list(F.struct("bucket", "s", "t"))).alias("b"), F.sum("s").alias("S"), F.sum("t").alias("T"))
    gain = lambda b: F.floor(1000 * F.log((b["t"] + 1) * (F.col("S") + buckets) / ((b["s"] + 1) * (F.col("T") + buckets))))
    return held.select(F.transform("b", gain).alias("gains")).first().gains


def _weighed(max_run: int, head, gains: list[int], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain_of = _worth(head.value, gains)
        for batch in batches:
            words, features, weights = [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                n_words = n_features = total = 0
                for n, found in runs(text, max_run):
                    own = list(map(gain_of.__getitem__, found))
                    n_features += len(own)
                    n_words += len(own) if n == 1 else 0
                    total += sum(own)
                words.append(n_words)
                features.append(n_features)
                weights.append(total // n_features if n_features else 0)
            made = [pa.array(c, pa.int64()) for c in (words, features, weights)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], schema=schema)

    return run


def noise(id_col: str, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of the seeded id's sha256."""
    seeded = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(seeded, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def score(
    df: DataFrame, target: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS, seed: int = SEED, head_share: float = HEAD_SHARE,
    text: str = "text", id_col: str = "doc_id", target_text: str = "text",
) -> DataFrame:
    """One row per document, written: its id (and ``__uid`` where ``df`` has one), n_words, n_features, weight and score."""
    spark: SparkSession = df.sparkSession
    head = spark.sparkContext.broadcast(head_vocabulary(df, max_run, head_share, text))
    raw = bucket_totals(df, head, max_run, buckets, text)
    gains = bucket_gains(raw, bucket_totals(target, head, max_run, buckets, target_text), buckets)
    keys = [c for c in (UID,) if c in df.columns] + [id_col]
    read = df.select(*keys, F.col(text).cast("string").cast("binary").alias("__text"))
    schema = read.drop("__text").schema.add("n_words", "long").add("n_features", "long").add("weight", "long")
    from .exact_dedup import arrow_schema

    weighed = read.mapInArrow(_weighed(max_run, head, gains, arrow_schema(spark, schema)), schema)
    return stage(weighed.withColumn("score", F.col("weight") + noise(id_col, seed)), "weighed")


def draw(scored: DataFrame, percent: int = DRAWN_PERCENT, least_words: int = LEAST_WORDS, id_col: str = "doc_id") -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... for the highest scores among documents of enough words, null for the others."""
    enough = F.col("n_words") >= least_words
    places = scored.where(enough).count() * percent // 100
    ranked = with_positions(scored.where(enough), [F.desc("score"), F.asc_nulls_last(id_col), "n_features", "weight"], "rank")
    drawn = ranked.withColumn("rank", F.when(F.col("rank") <= places, F.col("rank")))
    return drawn.unionByName(scored.where(~enough).withColumn("rank", F.lit(None).cast("bigint")))


def resample(df: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT, least_words: int = LEAST_WORDS, **options) -> DataFrame:
    """The rows of ``df`` that are drawn, with their own columns."""
    rows = numbered(df, "resample-rows")
    drawn = draw(score(rows, target, **options), percent, least_words, options.get("id_col", "doc_id"))
    return rows.join(drawn.where("rank IS NOT NULL").select(UID), UID, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
