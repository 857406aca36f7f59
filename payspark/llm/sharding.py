"""Two-pass external shuffle into shards.

Pass one scatters records by a seeded hash of their id and text into buckets sized for one task's memory; pass two puts a bucket
into canonical order, shuffles it by Fisher-Yates with a generator seeded by (seed, bucket), and writes it.  Buckets
follow one another, so every record has one global place; shard ``s`` of ``S`` takes places ``s*N//S`` up to
``(s+1)*N//S``.  Shard counts differ by one at most (law ``rows``), a bucket is written to one shard or two, and
the outcome depends on the ids, the texts, the seed, the number of shards and the number of buckets, never on the layout of the input.

Records alike in id and text that together fill more than a part of a bucket are counted through and spread by their number, so
that no id, null or repeated, makes a bucket larger than a task can hold.

Defined cases: null ids and repeated ids are spread by their texts; records alike in both are interchangeable (they keep
whatever order they arrive in before the shuffle); null texts are written as null; an empty table gives an empty result; all columns
are written unchanged except input columns named ``shard`` or ``slot``, which the places replace.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import UID, numbered, running_start, text_of, work_path
from .exact_dedup import arrow_schema

BUCKET_BYTES = 32 << 20
LUMPS = 8


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A permutation of range(n): from the last place down, swap with a uniformly drawn place not above it."""
    order = list(range(n))
    if n > 1:
        draws = np.random.Generator(np.random.PCG64(seed)).integers(0, np.arange(n, 1, -1)).tolist()
        for i, j in zip(range(n - 1, 0, -1), draws):
            order[i], order[j] = order[j], order[i]
    return np.array(order, dtype=np.int64)


def _shuffle_bucket(shards: int, total: int, seed: int, schema: pa.Schema):
    def run(bucket: pa.Table) -> pa.Table:
        bucket = bucket.take(pc.sort_indices(bucket, [("__hash", "ascending")]))
        n, number, start = bucket.num_rows, bucket.column("__bucket")[0].as_py(), bucket.column("__start")[0].as_py()
        bucket = bucket.take(pa.array(fisher_yates(n, [seed, number])))
        place = np.arange(start, start + n)
        shard = ((place + 1) * shards - 1) // total
        columns = [bucket.column(f"__c{i}") for i in range(len(schema) - 2)]
        return pa.table([*columns, pa.array(shard, pa.int32()), pa.array(place - shard * total // shards, pa.int64())], schema=schema)

    return run


def _spread(df: DataFrame, alike: Column, weight: Column, lump_bytes: int) -> DataFrame:
    """``df`` with ``__hash``: that of id and text, and for rows alike beyond ``lump_bytes`` also of the lump they are in.

    Rows alike are numbered within their input partition and on from the partitions before it, so no window holds them all.
    There are at most as many heavy hashes as lumps in the table.
    """
    heavy = df.groupBy(alike.alias("__hash")).agg(F.sum(weight).alias("__b"), F.count(F.lit(1)).alias("__n"))
    heavy = heavy.where((F.col("__b") > lump_bytes) & (F.col("__n") > 1))
    found = [tuple(r) for r in heavy.collect()]
    if not found:
        return df.withColumn("__hash", alike)
    small = F.broadcast(df.sparkSession.createDataFrame(found, "__hash bigint, __b bigint, __n bigint"))
    rows = numbered(df, "shard-rows").withColumn("__hash", alike)
    light = rows.join(small, "__hash", "left_anti").select(*[F.col(f"`{c}`") for c in df.columns], "__hash")
    lumped = rows.join(small, "__hash").withColumn("__part", F.shiftright(UID, 33))
    before = Window.partitionBy("__hash").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = lumped.groupBy("__hash", "__part").agg(F.count(F.lit(1)).alias("__c"))
    counts = counts.select("__hash", "__part", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__hash", "__part").orderBy(UID)).alias("__place")
    places = lumped.select(UID, "__hash", "__part", "__b", "__n", place).join(counts, ["__hash", "__part"])
    lump = F.floor((F.col("__before") + F.col("__place") - 1) / F.greatest(F.lit(1), F.floor(F.lit(lump_bytes) * F.col("__n") / F.col("__b"))))
    lumps = places.select(UID, lump.alias("__lump"))
    again = F.xxhash64("__hash", "__lump").alias("__hash")
    return light.unionByName(lumped.join(lumps, UID).select(*[F.col(f"`{c}`") for c in df.columns], again))


def shuffle_into_shards(
    df: DataFrame,
    shards: int = 8,
    text: str = "text",
    id_col: str = "doc_id",
    seed: int = 11,
    bucket_bytes: int = BUCKET_BYTES,
    path: str | None = None,
) -> DataFrame:
    """Write the shards (folders ``shard=0`` ...) and return what was written, with ``shard`` and ``slot``."""
    spark = df.sparkSession
    path = path or work_path(spark, "shards")
    weight = F.octet_length(text_of(text)) + 64
    totals = df.agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("b")).first()
    buckets = max(1, -(-(totals["b"] or 0) // bucket_bytes))
    names = [c for c in df.columns if c not in ("shard", "slot")]
    alike = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text))
    spread = _spread(df, alike, weight, max(1, bucket_bytes // LUMPS)) if buckets > 1 else df.withColumn("__hash", alike)
    bucket = F.pmod(F.shiftright("__hash", 8), F.lit(buckets)).alias("__bucket")
    starts = running_start(spread.groupBy(bucket).agg(F.count(F.lit(1)).alias("__n")), "__bucket", "__n", "__start").drop("__n")
    schema = T.StructType([T.StructField(n, df.schema[n].dataType) for n in names])
    schema = schema.add("shard", "integer").add("slot", "long")
    run = _shuffle_bucket(shards, totals["n"], seed, arrow_schema(spark, schema))
    placed = (
        spread.select(bucket, "__hash", *[F.col(f"`{n}`").alias(f"__c{i}") for i, n in enumerate(names)])
        .join(starts.hint("shuffle_hash"), "__bucket")
        .groupBy("__bucket")
        .applyInArrow(run, schema)
    )
    placed.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return spark.read.schema(schema).parquet(path)
