"""Incremental ingest over the derived scrape records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import work_path
from ..streaming.postings import ingest_new_postings, known_urls, stream_lines, within_watermark
from .bridge import PAID, check, postings
from .record_checks import CLEAN_SQL, LINE, scrape_records


def ingested(spark, sf) -> str:
    """The stored table after two landings that share urls and a third that repeats the first."""
    root = work_path(spark, "stream")
    records = scrape_records(spark, sf)
    for day, odd in enumerate((0, 1, 0)):
        part = records.where(F.col("k2") % 2 == odd).drop(*[c for c in LINE if c != "collected_at"])
        part.write.option("compression", "gzip").json(f"{root}/landing/day={day}")
        ingest_new_postings(spark, f"{root}/landing/day=*", f"{root}/table", f"{root}/state", pattern="*.json.gz")
    return f"{root}/table"


@check(
    "stream_new_postings",
    CLEAN_SQL + " SELECT job_url, count(*) AS records FROM (SELECT DISTINCT job_url FROM cleaned) GROUP BY job_url",
)
def _(spark, sf):
    return spark.read.parquet(ingested(spark, sf)).groupBy("job_url").agg(F.count(F.lit(1)).alias("records"))


@check(
    "stream_known_urls",
    CLEAN_SQL + " SELECT job_url, count(*) AS times, 0 AS last_batch_rows FROM (SELECT DISTINCT job_url FROM cleaned) GROUP BY job_url",
)
def _(spark, sf):
    known = known_urls(spark, ingested(spark, sf))
    return known.groupBy("job_url").agg(F.count(F.lit(1)).alias("times"), F.count_if(F.col("batch_id") >= 2).cast("int").alias("last_batch_rows"))


@check(
    "stream_within_watermark",
    PAID + """, u AS (SELECT DISTINCT job_url FROM paid WHERE job_url IS NOT NULL)
    SELECT job_url FROM u UNION ALL SELECT job_url || '/new' FROM u""",
)
def _(spark, sf):
    """The latest record of each url; then their repeats, new urls of the last moment, and new urls too late for the watermark."""
    root = work_path(spark, "watermark")
    seen = postings(spark, sf).where("job_url IS NOT NULL").groupBy("job_url").agg(F.max("collected_at").alias("at"))
    first = seen.select("job_url", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("collected_at"))
    last = first.agg(F.max("collected_at")).scalar()
    new = first.select(F.concat("job_url", F.lit("/new")).alias("job_url"), last.alias("collected_at"))
    late = first.select(F.concat("job_url", F.lit("/late")).alias("job_url"), F.lit("1970-01-02 00:00:00").alias("collected_at"))
    for day, rows in enumerate((first, first.unionByName(new).unionByName(late))):
        rows.write.json(f"{root}/landing/day={day}")
        kept = within_watermark(stream_lines(spark, f"{root}/landing/day=*", "*.json")).select("job_url")
        sink = kept.writeStream.format("parquet").option("path", f"{root}/table").option("checkpointLocation", f"{root}/state")
        sink.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("job_url string").parquet(f"{root}/table")
