"""Token counts by an exact histogram of encoded lengths.

Documents are encoded once, whole, and only the histogram (length, number of documents) is shuffled, summed map side.
Suffix sums over it answer, for every context limit, how many documents and tokens lie at or beyond it, what
truncating to it keeps, and which length is a given quantile, all without another look at the texts.

Defined cases: null and empty texts have length 0 (plus ``extra``); documents of equal length share a row; an empty
table gives an empty histogram, and its quantiles are null; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, text_of
from .tokens import shared_encoder, vocabulary_path


def _count_lengths(path: str, extra: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, found = shared_encoder(path, len), Counter()
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                texts = batch.column(0).slice(i, 500).to_pylist()
                encoder.learn(texts)
                found.update(sum(encoder.values(t)) + extra for t in texts)
        yield pa.record_batch([pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.int64())], names=["length", "n_docs"])

    return run


def length_histogram(df: DataFrame, text: str = "text", vocabulary: str | None = None, extra: int = 0) -> DataFrame:
    """``length``, ``n_docs``: one row per encoded length that occurs; ``extra`` tokens are added to every document."""
    counted = df.select(text_of(text).alias("t")).mapInArrow(
        _count_lengths(vocabulary or vocabulary_path(), extra), "length bigint, n_docs bigint"
    )
    return counted.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def with_suffix_sums(histogram: DataFrame, width: int = 1024) -> DataFrame:
    """Per length L: documents and tokens at L or more, and the corpus' tokens when texts are cut to L tokens.

    Two levels: sums per block of ``width`` lengths, then within the block, so no window sees more than ``width``
    lengths or one row per block.
    """
    h = histogram.withColumns({"__b": F.floor(F.col("length") / width), "__t": F.col("length") * F.col("n_docs")})
    after = Window.orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = h.groupBy("__b").agg(F.sum("n_docs").alias("__dn"), F.sum("__t").alias("__tn"))
    blocks = blocks.select(
        "__b", F.coalesce(F.sum("__dn").over(after), F.lit(0)).alias("__d0"), F.coalesce(F.sum("__tn").over(after), F.lit(0)).alias("__t0")
    )
    inside = Window.partitionBy("__b").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    total = h.agg(F.sum("n_docs").alias("d"), F.sum("__t").alias("t")).select(F.struct("d", "t")).scalar()
    joined = h.join(blocks, "__b").withColumns(
        {"docs_from": F.col("__d0") + F.sum("n_docs").over(inside), "tokens_from": F.col("__t0") + F.sum("__t").over(inside)}
    )
    return joined.select(
        "length", "n_docs", "docs_from", "tokens_from",
        (total["t"] - F.col("tokens_from") + F.col("length") * F.col("docs_from")).alias("truncated_total"),
        (total["d"] - F.col("docs_from")).alias("docs_below"),
        total["d"].alias("n_total"), total["t"].alias("tokens_total"),
    )


def saved_histogram(df: DataFrame, text: str = "text", vocabulary: str | None = None, extra: int = 0) -> DataFrame:
    """The histogram with its suffix sums, written once to the shared folder: the answers below only read it."""
    return with_suffix_sums(stage(length_histogram(df, text, vocabulary, extra), "lengths"))


def truncated_total(sums: DataFrame, limit: int) -> Column:
    """Tokens left when every text is cut to ``limit`` tokens, as a scalar: tokens below, plus the limit for the rest."""
    short = F.col("length") < limit
    return sums.agg(
        F.coalesce(F.sum(F.when(short, F.col("length") * F.col("n_docs")).otherwise(limit * F.col("n_docs"))), F.lit(0)).alias("v")
    ).scalar()


def length_quantile(sums: DataFrame, q: float) -> Column:
    """The smallest length that at least a share ``q`` of the documents does not exceed."""
    reached = F.col("docs_below") + F.col("n_docs") >= F.lit(q) * F.col("n_total")
    return sums.agg(F.min(F.when(reached, F.col("length"))).alias("v")).scalar()
