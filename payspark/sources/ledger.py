"""Incremental history: a ledger of files already read, so that a run reads only what has landed since (S5, S6, P3).

State lives below one folder: ``ledger/run=N`` holds path, time and size of the files that run N read, ``history/run=N`` the first
record per url up to it, with its place (stage, file, line).  History is written before its ledger, and the last run with a ledger is
the current one, so a run that fails half way is done again from the same files under the same number.  A file that changes is
read again as a new one; its earlier records stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import SCRAPE_SCHEMA, first_per_url, good_lines, read_jsonl

LEDGER = "path string, modified timestamp, bytes bigint, stage int"
PLACE = ("stage", "file_name", "line_at")
LINE_AT = "line_at struct<block:bigint,row:bigint>"


def listed(spark: SparkSession, folder: str, pattern: str, stage: int) -> DataFrame:
    """Files of a folder by path, time and size; their contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"), F.lit(stage).alias("stage"))


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """All files read so far, with the number of the run that read them; empty before the first run."""
    try:
        return spark.read.schema(f"{LEDGER}, run int").parquet(f"{root}/ledger")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], f"{LEDGER}, run int")


def unread(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    return listing.join(ledger, ["path", "modified", "bytes"], "left_anti")


def history(spark: SparkSession, root: str, run: int, schema: str = SCRAPE_SCHEMA) -> DataFrame:
    return spark.read.schema(f"{schema}, stage int, file_name string, {LINE_AT}").parquet(f"{root}/history/run={run}")


def advance_history(
    spark: SparkSession, folders: list[tuple[str, str]], root: str, schema: str = SCRAPE_SCHEMA
) -> tuple[DataFrame, int]:
    """First record per url over all files of ``folders`` ((folder, name pattern), first folder first), and the number of files read now.

    The given history and the new files are merged by (stage, file, line), so the outcome does not depend on when files landed.
    """
    ledger = read_ledger(spark, root)
    last = ledger.agg(F.max("run")).first()[0]
    listing = listed(spark, *folders[0], 0)
    for stage, (folder, pattern) in enumerate(folders[1:], 1):
        listing = listing.unionByName(listed(spark, folder, pattern, stage))
    fresh = unread(listing, ledger)
    rows = fresh.collect()  # the reader needs the paths; Spark lists them on the driver as well
    if not rows and last is not None:
        return history(spark, root, last, schema), 0
    run = 0 if last is None else last + 1
    merged = None if last is None else history(spark, root, last, schema)
    for stage in sorted({r.stage for r in rows}):
        lines = good_lines(read_jsonl(spark, [r.path for r in rows if r.stage == stage], schema)).withColumn("stage", F.lit(stage))
        merged = lines if merged is None else merged.unionByName(lines)
    if merged is None:
        merged = spark.createDataFrame([], f"{schema}, stage int, file_name string, {LINE_AT}")
    first_per_url(merged, [F.col(c) for c in PLACE]).write.mode("overwrite").parquet(f"{root}/history/run={run}")
    spark.createDataFrame([tuple(r) for r in rows], LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{root}/ledger/run={run}")
    return history(spark, root, run, schema), len(rows)
