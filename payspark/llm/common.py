"""Helpers of this subpackage: staged tables in the shared folder and stable row numbers."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_path

UID = "__uid"
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors once per application, so that they need no copy of it."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix="payspark-code-"), "payspark"), "zip", os.path.dirname(package), os.path.basename(package)
        )
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(app)


def stage(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage and survives lost executors.

    The code goes to the executors first, as ``df`` may run some of it.
    """
    ship(df.sparkSession)
    path = work_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, tag: str) -> DataFrame:
    """``df`` staged with a row number ``__uid`` of its own, so that repeated rows and null ids stay apart."""
    return stage(df.select("*", F.monotonically_increasing_id().alias(UID)), tag)


def text_of(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def running_start(counts: DataFrame, key: str, count: str, start: str, width: int = 4096) -> DataFrame:
    """Exclusive running sum of ``count`` over the non-negative integer ``key``, in two levels.

    Blocks of ``width`` keys are summed first, so no window holds more than ``width`` keys or one row per block.
    """
    keyed = counts.withColumn("__block", F.floor(F.col(key) / width))
    before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        keyed.groupBy("__block").agg(F.sum(count).alias("__sum"))
        .select("__block", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"))
    )
    inside = Window.partitionBy("__block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return (
        keyed.join(blocks, "__block")
        .withColumn(start, (F.col("__base") + F.coalesce(F.sum(count).over(inside), F.lit(0))).cast("bigint"))
        .drop("__block", "__base")
    )
