"""Total order of a whole table: each row's position, with no window over all rows (T1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written_once

#: ``monotonically_increasing_id`` holds the partition above these bits and the row inside it below them.
ROW_BITS = 33


def with_positions(df: DataFrame, order: list[Column | str], name: str = "position") -> DataFrame:
    """``df`` with each row's position, from 1, in the order of ``order``; the rows come from a written table.

    Rows are dealt into ranges by sampled bounds and sorted inside them; a range's first position is the number of rows in
    the ranges before it, so the only window holds one row per range.  Rows that are alike in ``order`` follow the number
    they were read under, which also lets a bound fall among them: a value that a third of the rows share is dealt over
    several ranges.  Nulls stand where ``order`` puts them.  An empty table gives an empty result.
    """
    tied = df.select("*", F.monotonically_increasing_id().alias("__tie"))
    ranged = tied.orderBy(*order, "__tie").drop("__tie").withColumn("__at", F.monotonically_increasing_id())
    rows = written_once(ranged, "ordered").withColumns(
        {"__range": F.shiftright("__at", ROW_BITS), "__row": F.col("__at").bitwiseAND((1 << ROW_BITS) - 1)}
    )
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
        .select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    )
    # one row per range: their number is bounded by the shuffle partitions
    placed = rows.join(F.broadcast(starts), "__range")
    position = (F.col("__start") + F.col("__row") + 1).cast("bigint").alias(name)
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], position)


def contiguous_parts(positioned: DataFrame, parts: int, rows: int, position: str = "position", name: str = "part") -> DataFrame:
    """``positioned`` with the number, from 0, of the contiguous part that holds its position.

    The first ``rows % parts`` parts hold one row more than the others.
    """
    small, more = divmod(rows, parts)
    at, head = F.col(position) - 1, more * (small + 1)
    late = F.lit(parts) if small == 0 else F.lit(more) + F.floor((at - head) / small)
    return positioned.withColumn(name, F.when(at < head, F.floor(at / (small + 1))).otherwise(late).cast("int"))
