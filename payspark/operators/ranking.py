"""Exact order statistics without collecting a group into one task, as one lazy plan.

Values are counted first, map side.  The counts are summed per logarithmic bucket, the buckets that hold the wanted ranks
are cut into 4,096 equal parts between the least and greatest value they hold, and only the values of the wanted parts are
ranked.  So neither a wide range nor values that lie close together bring many rows into one window: a window holds the
buckets of a group, the parts of a bucket or the distinct values of a part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written_once

ONE = "__all"
BUCKETS_PER_E = 8192
PARTS = 4096
GROUP_ROWS = 100_000


def bucket(v: Column) -> Column:
    """Non-decreasing, roughly logarithmic bucket number of a value, never null.

    A nullable bucket would make the planner test the whole value expression again before the join on it.
    """
    size = F.floor(F.log1p(F.abs(v)) * BUCKETS_PER_E)
    return F.coalesce(F.when(v < 0, -size).otherwise(size), F.lit(0))


def join_groups(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` in which null keys match; the columns of ``on`` come once, from the left."""
    other = right.withColumnsRenamed({c: f"__r_{c}" for c in on})
    met = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on])
    return left.join(other, met, how).drop(*[f"__r_{c}" for c in on])


def distribution(
    df: DataFrame,
    by: list[str],
    value: Column,
    percentiles: dict[str, float],
    moments: tuple[str, ...] = (),
    null_group: bool = False,
) -> DataFrame:
    """One row per group: ``n``, exact linearly interpolated percentiles and the asked-for moments.

    ``moments`` may name mean, std (sample), min, max.  NaN counts as missing.  Rows with a null key are left out
    unless ``null_group`` makes them groups of their own.  No job runs before the result is used.
    """
    g = by or [ONE]
    v = value.cast("double")
    keys = [F.col(c) for c in by] or [F.lit(1).alias(ONE)]
    base = df.select(*keys, F.when(~F.isnan(v), v).alias("__v")).where(F.col("__v").isNotNull())
    if not by:  # a key that the planner cannot fold away, so that joins on it stay joins on a key
        base = base.withColumn(ONE, F.col("__v").isNull().cast("int"))
    if not null_group:
        for c in by:
            base = base.where(F.col(c).isNotNull())
    counted = base.groupBy(*g, "__v").agg(F.count(F.lit(1)).alias("__c")).withColumn("__b", bucket(F.col("__v")))
    groups = _locate(counted, g, percentiles)
    out = groups.select(*g, "n", "min", "max", "mean")
    if "std" in moments:  # squares around the mean, so a large offset costs no digits
        around = F.sum(F.col("__c") * F.pow(F.col("__v") - F.col("mean"), 2))
        squares = join_groups(counted, groups.select(*g, "mean"), g).groupBy(*g).agg(around.alias("__s"))
        out = join_groups(out, squares, g).withColumn("std", F.when(F.col("n") > 1, F.sqrt(F.col("__s") / (F.col("n") - 1))))
    if percentiles:
        out = join_groups(out, _percentile_values(counted, groups, g, percentiles), g)
    columns = [F.col(c) for c in by] + [F.col(c) for c in ("n", *moments)]
    return out.select(*columns, *_interpolated(percentiles))


def distribution_of_counts(counted: DataFrame, by: list[str], value: str, count: str, percentiles: dict[str, float]) -> DataFrame:
    """As ``distribution`` without moments, from the counts of each value (double, present) in each group."""
    cells = counted.select(*by, F.col(value).alias("__v"), F.col(count).alias("__c")).withColumn("__b", bucket(F.col("__v")))
    groups = _locate(cells, by, percentiles)
    out = join_groups(groups.select(*by, "n"), _percentile_values(cells, groups, by, percentiles), by)
    columns = [F.col(c) for c in (*by, "n")]
    return out.select(*columns, *_interpolated(percentiles))


def distribution_of_groups(
    df: DataFrame, by: list[str], value: str, percentiles: dict[str, float], most: int = GROUP_ROWS, tag: str = "groups"
) -> DataFrame:
    """``n``, mean and exact percentiles per group of rows that are read several times, so ``df`` should be a written table.

    Keys and values are present and no value is NaN.  Groups are sized first, map side.  Those of at most ``most`` rows are dealt once
    and ranked in a window of their own.  The others number less than the rows divided by ``most``, so what is known of them is sent to the
    rows: these are counted per bucket map side, and only the values of the buckets that hold the wanted ranks are moved.
    """
    ranks = _ranks(percentiles)
    v = F.col(value) + 0.0  # one zero
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(v).alias("mean"))
    large = written_once(sizes.where(F.col("n") > most), tag)
    listed = F.broadcast(large.select(*by))

    own = Window.partitionBy(*by)
    placed = df.join(listed, by, "left_anti").select(
        *by, v.alias("__v"), (F.row_number().over(own.orderBy(v)) - 1).alias("__r"), F.count(F.lit(1)).over(own).alias("n")
    )
    small = placed.groupBy(*by).agg(
        F.max("n").alias("n"), F.avg("__v").alias("mean"), *[F.max(F.when(F.col("__r") == r, F.col("__v"))).alias(f"__{k}") for k, r in ranks.items()]
    )

    cells = df.join(listed, by, "left_semi").select(*by, v.alias("__v"), F.lit(1).cast("bigint").alias("__c")).withColumn("__b", bucket(F.col("__v")))
    groups = written_once(_locate(cells, by, percentiles), tag)
    wanted = _wanted(groups, by, percentiles)
    held = [*by, "__b", "n", "__off", "__lo", "__hi"]
    near = cells.join(F.broadcast(wanted), [*by, "__b"]).groupBy(*held, "__v").agg(F.sum("__c").alias("__c"))
    values = _ranked_values(written_once(near, tag), by, percentiles)
    big = large.join(values, by).select(small.columns)
    return small.unionByName(big).select(*by, "n", "mean", *_interpolated(percentiles))


def _interpolated(percentiles: dict[str, float]) -> list[Column]:
    """Each percentile from the values at its two ranks."""
    columns = []
    for name, p in percentiles.items():
        pos = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = F.col(f"__{name}_lo"), F.col(f"__{name}_hi")
        columns.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return columns


def _ranks(percentiles: dict[str, float]) -> dict[str, Column]:
    """The two neighbouring 0-based ranks of each percentile, over ``n``."""
    out = {}
    for name, p in percentiles.items():
        pos = F.lit(float(p)) * (F.col("n") - 1)
        out[f"{name}_lo"], out[f"{name}_hi"] = F.floor(pos), F.ceil(pos)
    return out


def _locate(counted: DataFrame, g: list[str], percentiles: dict[str, float]) -> DataFrame:
    """Per group: size, ends and, per wanted rank, its bucket with its ends and the number of rows before it."""
    before = Window.partitionBy(*g).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    heads = counted.groupBy(*g, "__b").agg(F.sum("__c").alias("__bc"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"),
                                                  F.sum(F.col("__v") * F.col("__c")).alias("__sum"))
    heads = heads.withColumns(
        {
            "__off": F.coalesce(F.sum("__bc").over(before), F.lit(0)),
            "n": F.sum("__bc").over(Window.partitionBy(*g)),
        }
    )
    place = F.struct(*[F.col(f"__{c}").alias(c) for c in ("b", "off", "lo", "hi")])
    at = [
        F.max(F.when((F.col("__off") <= r) & (r < F.col("__off") + F.col("__bc")), place)).alias(f"__at_{k}")
        for k, r in _ranks(percentiles).items()
    ]
    ends = [F.max("n").cast("bigint").alias("n"), F.min("__lo").alias("min"), F.max("__hi").alias("max"),
            (F.sum("__sum") / F.sum("__bc")).alias("mean")]
    return heads.groupBy(*g).agg(*ends, *at)


def _percentile_values(counted: DataFrame, groups: DataFrame, g: list[str], percentiles: dict[str, float]) -> DataFrame:
    """Per group the values at the wanted ranks."""
    return _ranked_values(join_groups(counted, _wanted(groups, g, percentiles), [*g, "__b"]), g, percentiles)


def _wanted(groups: DataFrame, g: list[str], percentiles: dict[str, float]) -> DataFrame:
    """Per group the buckets that hold its wanted ranks."""
    places = F.array_distinct(F.array(*[F.col(f"__at_{k}") for k in _ranks(percentiles)]))
    return groups.select(*g, "n", F.explode(places).alias("__p")).select(
        *g, "n", *[F.col(f"__p.{c}").alias(f"__{c}") for c in ("b", "off", "lo", "hi")]
    )


def _ranked_values(near: DataFrame, g: list[str], percentiles: dict[str, float]) -> DataFrame:
    """Per group the values at the wanted ranks, from the counted values ``near`` of the buckets that hold them."""
    ranks = _ranks(percentiles)
    width = F.col("__hi") - F.col("__lo")
    part = F.when(width > 0, F.least(F.lit(PARTS - 1), F.floor((F.col("__v") - F.col("__lo")) / width * PARTS)))
    fine = near.withColumn("__part", F.coalesce(part, F.lit(0)))
    before = Window.partitionBy(*g, "__b").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = fine.groupBy(*g, "__b", "n", "__off", "__part").agg(F.sum("__c").alias("__pc"))
    parts = parts.withColumn("__from", F.col("__off") + F.coalesce(F.sum("__pc").over(before), F.lit(0)))
    holds = reduce(lambda x, y: x | y, [(F.col("__from") <= r) & (r < F.col("__from") + F.col("__pc")) for r in ranks.values()])
    chosen = parts.where(holds).select(*g, "__b", "__part", "__from")
    inside = Window.partitionBy(*g, "__b", "__part").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = join_groups(fine, chosen, [*g, "__b", "__part"]).withColumn("__end", F.col("__from") + F.sum("__c").over(inside))
    start, end, v = F.col("__end") - F.col("__c"), F.col("__end"), F.col("__v")
    return ranked.groupBy(*g).agg(*[F.max(F.when((start <= r) & (r < end), v)).alias(f"__{k}") for k, r in ranks.items()])


def rank_thresholds(
    df: DataFrame, by: list[str], key: Column, ranks: dict[str, Column], bits: int = 60, head_bits: int = 20
) -> DataFrame:
    """Per group, the key value at each asked-for 1-based rank; rank 0 gives null.

    ``key`` is a non-negative bigint below 2**bits, evenly spread (a hash); ``ranks`` are columns over the group
    size ``n``.  The first pass counts key heads map side; only keys under a head that holds a wanted rank are
    ranked in the second.
    """
    g = by or [ONE]
    keys = [F.col(c) for c in by] or [F.lit(1).alias(ONE)]
    base = df.select(*keys, key.alias("__k")).withColumn("__b", F.shiftright("__k", bits - head_bits))
    before = Window.partitionBy(*g).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    heads = (
        base.groupBy(*g, "__b")
        .agg(F.count(F.lit(1)).alias("__bc"))
        .select(
            *g, "__b", "__bc",
            F.sum("__bc").over(before).alias("__cum"),
            F.sum("__bc").over(Window.partitionBy(*g)).alias("n"),
        )
    )
    wanted = F.explode(
        F.array(*[F.struct(F.lit(k).alias("name"), r.cast("bigint").alias("rank")) for k, r in ranks.items()])
    )
    targets = (
        heads.select("*", wanted.alias("__w"))
        .where((F.col("__w.rank") <= F.col("__cum")) & (F.col("__w.rank") > F.col("__cum") - F.col("__bc")))
        .select(
            *g, "__b", F.col("__w.name").alias("__name"),
            (F.col("__w.rank") - F.col("__cum") + F.col("__bc")).alias("__r"),
        )
    )
    inside = Window.partitionBy(*g, "__b", "__name").orderBy("__k").rowsBetween(Window.unboundedPreceding, 0)
    return (
        base.join(targets, [*g, "__b"])
        .groupBy(*g, "__b", "__name", "__r", "__k")
        .agg(F.count(F.lit(1)).alias("__kc"))
        .withColumn("__kcum", F.sum("__kc").over(inside))
        .where((F.col("__kcum") >= F.col("__r")) & (F.col("__kcum") - F.col("__kc") < F.col("__r")))
        .groupBy(*g)
        .agg(*[F.max(F.when(F.col("__name") == k, F.col("__k"))).alias(k) for k in ranks])
        .select(*by, *ranks)
    )
