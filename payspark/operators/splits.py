"""Deterministic, order-independent train / validation / test splits of exact size.

Rows are ordered by a hash of their identifying columns; the split points are hash values at exact ranks, so
no stratum is ever sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .broadcasts import one_row
from .ranking import rank_thresholds

HASH_BITS = 60


def row_hash(columns: list[str], seed: int = 42) -> Column:
    """60-bit hash of the identifying columns."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def stratified_split(
    df: DataFrame,
    ids: list[str],
    strata: str | None = "year",
    test_share: float = 0.15,
    val_share: float = 0.15,
    seed: int = 42,
) -> DataFrame:
    """Append ``split``.  Per stratum, ceil(n*test) rows are test and ceil(rest*val/(1-test)) of the rest val."""
    hashed = df.withColumn("__k", row_hash(ids, seed))
    by = [strata] if strata else []
    n = F.col("n")
    n_test = F.ceil(F.round(n * test_share, 6))
    n_val = F.ceil(F.round((n - n_test) * (val_share / (1 - test_share)), 6))
    cuts = rank_thresholds(
        hashed.dropna(subset=by) if by else hashed, by, F.col("__k"), {"__test": n_test, "__val": n_test + n_val},
        HASH_BITS,
    )
    return _label(hashed, cuts, by, "test", "val", df.columns)


def temporal_split(
    df: DataFrame, ids: list[str], test_year: int = 2024, val_share: float = 0.15, seed: int = 42
) -> DataFrame:
    """Append ``split``: years from ``test_year`` are test, floor(n*val) of the older rows val, others train.

    Without a year column a fifth of all rows is test and ``val_share`` of the rest val.
    """
    if "year" not in df.columns:
        return stratified_split(df, ids, None, 0.2, val_share * 0.8, seed)
    hashed = df.withColumn("__k", row_hash(ids, seed))
    older = hashed.where(F.col("year") < test_year)
    cuts = rank_thresholds(
        older, [], F.col("__k"), {"__val": F.floor(F.round(F.col("n") * val_share, 6))}, HASH_BITS
    )
    limit = cuts.select("__val").scalar()
    return hashed.select(
        *df.columns,
        F.when(F.col("year") >= test_year, "test")
        .when(F.col("__k") <= F.coalesce(limit, F.lit(-1)), "val")
        .when(F.col("year") < test_year, "train")
        .alias("split"),
    )


def _label(hashed: DataFrame, cuts: DataFrame, by: list[str], first: str, second: str, columns: list[str]):
    low, mid = F.coalesce("__test", F.lit(-1)), F.coalesce("__val", F.lit(-1))
    if by:
        joined = hashed.join(cuts, by, "left")
    else:
        joined = hashed.withColumn("__cut", one_row(cuts)).select("*", "__cut.__test", "__cut.__val")
    k = F.col("__k")
    label = F.when(k <= low, first).when(k <= mid, second).otherwise("train")
    return joined.select(*columns, label.alias("split"))
