"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Every source is a stream: its documents in a seeded order, cut into blocks of ``block_words`` words (the last block holds the
rest).  Targets are the sources' weights' shares of all words, stopped at ``max_repeats`` times a source's words, the excess going to the
others by weight.  The mix has as many block places as the targets make blocks.  They go to the sources by the highest quotients
target / (2 k + 1), k being the places a source holds already.  The order in which places are won deals them to shards of
equal size, so every shard has integer quotas that are themselves a highest-quotient allocation with those before it.  A source's
places are filled by its blocks in a seeded order of their own, all blocks once before any comes again.

A source's k-th place is computed, not searched: an allocation at a divisor is a rounding, so the places before and after the wanted
number are counted for all but twice as many quotients as there are sources, and only those are sorted.  Positions in a stream
come from sums per seeded bucket of a source and a window inside a bucket, so a source with any share of the rows is spread over
all its buckets, and the only sort is inside one.  What is whole in one task is one row per source.  All is DataFrame functions.

Defined cases: a null text has no words, and a document without words takes none; null sources are one source, after all
others; repeated ids and rows are documents of their own, in an order that ids, texts and sizes decide, so that reruns agree; a source
without words has the target 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import UID, running_start, stage

WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 64
SHARDS = 8
BUCKETS = 4096
MAX_REPEATS = 3
SEED = 2024
WHITE = r"\x20\x09-\x0D"


def word_count(text: Column) -> Column:
    """Runs of characters that are not white space: each, with the white space before it, becomes one mark; marks are counted."""
    marks = F.regexp_replace(text, rf"[{WHITE}]*+[^{WHITE}]++", "x")
    return F.coalesce(F.length(F.rtrim(marks, F.lit(" \t\n\x0b\x0c\r"))), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source of ``sizes`` (source, source_size): its rank by code point, null last, its weight and its target.

    The level (target / weight) that all targets below their limits share is found among the sources in the order of limit / weight: it is that of
    the first source that the words left over, by weight, do not lift above its limit.  From there on levels fall, so it is the highest.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    limit = F.col("source_size") * max_repeats
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    weighted = ranked.withColumn("weight", F.array(*map(F.lit, weights))[(F.col("rank") % len(weights)).cast("int")])
    by_limit = Window.orderBy(limit / F.col("weight"), "rank")
    before, everything = by_limit.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (
        (F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    leveled = weighted.withColumn("__level", level)
    below = F.max(F.when(F.col("__level") * F.col("weight") <= limit, F.col("__level"))).over(everything)
    target = F.least(limit.cast("double"), F.col("weight") * F.coalesce(below, F.lit(float("inf"))))
    return leveled.withColumn("target", F.when(F.col("source_size") == 0, 0.0).otherwise(target)).drop("__level")


def apportion(targets: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``targets`` with n_blocks and ``quotas``: the places that each source has won by the end of each shard.

    A divisor d gives a source round(target / d) places.  At d = all / (places - sources / 2) these are too few, at
    all / (places + sources / 2) enough, so only the quotients between the two are sorted, about two for each source.
    """
    everything = Window.partitionBy()
    n_blocks = F.ceil(F.col("source_size") / block_words).cast("bigint")
    most = F.col("n_blocks") * max_repeats
    wanted = F.col("__places") * F.col("__until") / shards
    whole = targets.withColumns({"n_blocks": n_blocks, "__all": F.sum("target").over(everything), "__sources": F.count(F.lit(1)).over(everything)})
    whole = whole.withColumn("__places", F.floor(F.col("__all") / block_words + F.lit(0.5)))
    each = whole.select("*", F.explode(F.sequence(F.lit(1), F.lit(shards))).alias("__until")).withColumn("__wanted", F.floor(wanted))

    def at(places: Column) -> Column:
        won = F.floor(F.col("target") * F.greatest(places, F.lit(0.0)) / F.greatest("__all", F.lit(1.0)) + F.lit(0.5))
        return F.least(won, most).cast("bigint")

    low = at(F.col("__wanted") - F.col("__sources") / 2 - 1)
    high = F.least(at(F.col("__wanted") + F.col("__sources") / 2 + 1) + 1, most)
    bounded = each.withColumn("__low", low).withColumn("__high", F.greatest(high, F.col("__low")))
    open_places = F.when(F.col("__high") > F.col("__low"), F.sequence("__low", F.col("__high") - 1))
    tried = bounded.select("__until", "rank", "target", "__wanted", "__low", F.explode_outer(open_places).alias("__k"))
    sure = tried.groupBy("__until", "rank").agg(F.first("__low").alias("__low"), F.first("__wanted").alias("__wanted"))
    left = sure.groupBy("__until").agg((F.first("__wanted") - F.sum("__low")).alias("__left"))
    quotient = F.col("target") / (2 * F.col("__k") + 1)
    by_quotient = Window.partitionBy("__until").orderBy(quotient.desc_nulls_last(), "rank", "__k")
    won = (
        tried.where(F.col("__k").isNotNull() & (F.col("target") > 0)).withColumn("__nth", F.row_number().over(by_quotient))
        .join(left, "__until").where(F.col("__nth") <= F.col("__left")).groupBy("__until", "rank").agg(F.count(F.lit(1)).alias("__more"))
    )
    quotas = (
        sure.join(won, ["__until", "rank"], "left").groupBy("rank")
        .agg(F.sort_array(F.collect_list(F.struct("__until", (F.col("__low") + F.coalesce("__more", F.lit(0))).alias("places")))).alias("__q"))
        .select("rank", F.col("__q.places").alias("quotas"))
    )
    return whole.drop("__all", "__sources", "__places").join(quotas, "rank")


def _coprime(n: Column, seed: Column) -> Column:
    """The first of 16 seeded odd numbers that has no factor in common with ``n``, modulo ``n``; 1 if there is none."""

    def gcd(a: Column) -> Column:
        start = F.struct(a.alias("x"), n.alias("y"))
        step = lambda p, _: F.when(p["y"] == 0, p).otherwise(F.struct(p["y"].alias("x"), F.pmod(p["x"], p["y"]).alias("y")))
        return F.aggregate(F.sequence(F.lit(1), F.lit(64)), start, step, lambda p: p["x"])

    tries = F.transform(F.sequence(F.lit(1), F.lit(16)), lambda i: F.pmod(F.xxhash64(seed, i), F.lit(1 << 40)) * 2 + 1)
    return F.pmod(F.coalesce(F.get(F.filter(tries, lambda t: gcd(t) == 1), F.lit(0)), F.lit(1).cast("bigint")), n)


def mix(
    df: DataFrame, weights: tuple[int, ...] = WEIGHTS, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED,
    buckets: int = BUCKETS, max_repeats: int = MAX_REPEATS, text: str = "text", source: str = "source", id_col: str = "doc_id",
) -> DataFrame:
    """One row per document: __uid, id, source, size, source_size, target and ``pieces``.

    A piece is a run of the document's words in one block: from_word, words, block and ``shards``, the shard of each place that the block
    fills; a block that fills none has an empty list.  ``__uid`` is the row's number, kept where ``df`` has one.
    """
    body = F.col(text).cast("string")
    read = df.select(
        F.col(UID) if UID in df.columns else F.monotonically_increasing_id().alias(UID), F.col(id_col), F.col(source).alias("source"),
        word_count(body).alias("size"), F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(body)).alias("__h"),
    )
    rows = stage(read.withColumn("__bucket", F.pmod("__h", F.lit(buckets)).cast("bigint")), "mix-sizes")
    spread = stage(rows.groupBy("source", "__bucket").agg(F.sum("size").alias("__words")), "mix-buckets")
    targets = source_targets(spread.groupBy("source").agg(F.sum("__words").alias("source_size")), weights, max_repeats)
    seeded, n = F.xxhash64(F.lit(seed), "rank"), F.greatest("n_blocks", F.lit(1))
    order = {"__a": _coprime(n, seeded), "__c": F.pmod(F.xxhash64(seeded, F.lit(0)), n)}
    quotas = stage(apportion(targets, block_words, shards, max_repeats).withColumns(order), "mix-quotas")

    key = F.col("rank").cast("bigint") * buckets + F.col("__bucket")
    known = spread.join(quotas, spread["source"].eqNullSafe(quotas["source"])).drop(quotas["source"]).withColumn("__key", key)
    starts = running_start(known, "__key", "__words", "__start")
    first = F.min("__start").over(Window.partitionBy("rank"))
    starts = starts.withColumn("__start", F.col("__start") - first).drop("source", "__bucket", "__words")
    ranks = quotas.select(F.col("source").alias("__name"), F.col("rank").alias("__rank"))
    keyed = rows.join(ranks, rows["source"].eqNullSafe(F.col("__name"))).withColumn("__key", F.col("__rank").cast("bigint") * buckets + F.col("__bucket"))
    inside = Window.partitionBy("__key").orderBy("__h", F.col(id_col), "size", UID).rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("__in", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, "__key")
    return placed.select(UID, id_col, "source", "size", "source_size", "target", _pieces(block_words).alias("pieces"))


def _pieces(block_words: int) -> Column:
    """A block's place in its source's seeded order is (a * block + c) mod n_blocks; products are decimals, so they cannot overflow."""
    at = F.col("__start") + F.col("__in")
    end, n, places = at + F.col("size"), F.greatest("n_blocks", F.lit(1)), F.element_at("quotas", -1)

    def piece(block: Column) -> Column:
        low, high = F.greatest(at, block * block_words), F.least(end, (block + 1) * block_words)
        turn = F.pmod(F.col("__a").cast("decimal(19,0)") * block + F.col("__c"), n).cast("bigint")
        filled = F.filter(F.transform(F.sequence(F.lit(0), F.floor(places / n)), lambda p: p * n + turn), lambda k: k < places)
        own = F.transform(filled, lambda k: F.size(F.filter("quotas", lambda q: q <= k)))
        return F.struct((low - at).alias("from_word"), (high - low).alias("words"), block.alias("block"), own.alias("shards"))

    blocks = F.sequence(F.floor(at / block_words), F.floor((end - 1) / block_words))
    return F.transform(F.when(F.col("size") > 0, blocks).otherwise(F.array().cast("array<bigint>")), piece)


def taken_words(pieces: str = "pieces") -> Column:
    """Words that the mix takes of a document, repeats counted."""
    return F.aggregate(pieces, F.lit(0).cast("bigint"), lambda n, p: n + p["words"] * F.size(p["shards"]))


def mixed_pieces(mixed: DataFrame) -> DataFrame:
    """The mix itself: one row for each place that a piece fills, with its shard."""
    each = mixed.select("*", F.explode("pieces").alias("p")).select("*", F.explode("p.shards").alias("shard"))
    return each.select(*[c for c in mixed.columns if c != "pieces"], "shard", "p.block", "p.from_word", "p.words")
