"""Incremental first-per-url ingest of landing JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.records import clean_scrape_records, first_per_key
from ..session import shared_dir, written_once
from ..sources.files import BAD, SCRAPE_SCHEMA, good_lines


def stream_lines(spark: SparkSession, landing: str, pattern: str = "batch-*.jsonl", max_files: int = 1000) -> DataFrame:
    reader = spark.readStream.schema(f"{SCRAPE_SCHEMA}, {BAD} string").option("pathGlobFilter", pattern)
    return reader.option("columnNameOfCorruptRecord", BAD).option("maxFilesPerTrigger", max_files).json(landing)


URL_BUCKETS = 256
URLS = "job_url string, batch_id bigint, bucket int"


def known_urls(spark: SparkSession, table: str) -> DataFrame | None:
    """Stored urls with the bucket of their hash, which is a folder below each batch's; None before the first batch."""
    try:
        return spark.read.schema(URLS).parquet(f"{table}_urls")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def _append_new(table: str, buckets: int = URL_BUCKETS):
    """Write a batch's unseen urls to its own folders, so a replayed batch overwrites only itself.

    A batch meets the stored urls of its own buckets alone, and of them only the urls; which buckets these are (at most ``buckets``
    numbers) is known before the join, so the other folders are not read.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        first = first_per_key(batch, ["job_url"], [F.col("collected_at"), F.xxhash64(*batch.columns)])
        fresh = written_once(first.withColumn("__bucket", F.pmod(F.xxhash64("job_url"), F.lit(buckets)).cast("int")), "batch")
        known = known_urls(spark, table)
        if known is not None:
            own = [r[0] for r in fresh.select("__bucket").distinct().collect()]
            seen = known.where(F.col("bucket").isin(own) & (F.col("batch_id") != batch_id)).select("job_url", F.col("bucket").alias("__bucket"))
            fresh = fresh.join(seen, ["__bucket", "job_url"], "left_anti")
        at = f"{table}/batch_id={batch_id}"
        fresh.select(*batch.columns).write.mode("overwrite").parquet(at)
        stored = spark.read.schema(batch.schema).parquet(at).select("job_url", F.pmod(F.xxhash64("job_url"), F.lit(buckets)).cast("int").alias("bucket"))
        stored.write.mode("overwrite").partitionBy("bucket").parquet(f"{table}_urls/batch_id={batch_id}")

    return write


def ingest_new_postings(
    spark: SparkSession, landing: str, table: str, state: str | None = None, pattern: str = "batch-*.jsonl",
    max_files: int = 1000,
):
    """Process everything that has landed: clean records whose url was never stored are appended.

    Known urls live in a table beside ``table``, by buckets of their hash, not in operator state: exactness needs no watermark, state
    does not grow in memory, and a batch reads its own buckets alone.  Returns the finished query.
    """
    state = state or f"{shared_dir(spark)}/new_postings"
    query = (
        clean_scrape_records(good_lines(stream_lines(spark, landing, pattern, max_files)))
        .writeStream.foreachBatch(_append_new(table))
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def within_watermark(stream: DataFrame, delay: str = "7 days") -> DataFrame:
    """First record per url among records at most ``delay`` apart in event time; bounded state."""
    timed = stream.withColumn("seen_at", F.try_to_timestamp("collected_at")).where(F.col("seen_at").isNotNull())
    return timed.withWatermark("seen_at", delay).dropDuplicatesWithinWatermark(["job_url"])
