"""File-backed sources: registered parquet sources, JSON lines and dated snapshots."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..operators.records import first_per_key

SCRAPE_SCHEMA = (
    "collected_at string, position string, company string, location string, posted_date string, job_url string, "
    "salary string, seniority_level string, employment_type string, job_function string, industries string, "
    "applicant_count int, experience_years string, education string, skills array<string>, company_logo string, "
    "description string"
)
BAD = "_bad"
CONSOLIDATED = r"consolidated-.*\.jsonl$"
RAW = r"(ai-jobs-|batch-).*\.jsonl$"


def stamp_source(df: DataFrame, source: str) -> DataFrame:
    priority = rules.SOURCES.get(source, {}).get("priority", rules.UNKNOWN_PRIORITY)
    return df.withColumns({"data_source": F.lit(source), "source_priority": F.lit(priority)})


def load_source(spark: SparkSession, source: str, path: str, enabled: dict[str, bool] | None = None) -> DataFrame:
    """One registered parquet source with its name and priority; disabled, unknown or missing gives no rows."""
    entry = rules.SOURCES.get(source)
    on = entry is not None and (enabled or {}).get(source, entry["enabled"])
    if on:
        try:
            return stamp_source(spark.read.parquet(path), source)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    columns = entry["columns"] if entry else rules.CANONICAL_TYPES
    schema = ", ".join(f"{c} {rules.CANONICAL_TYPES[c]}" for c in columns)
    return stamp_source(spark.createDataFrame([], schema), source)


def read_jsonl(spark: SparkSession, path, schema: str = SCRAPE_SCHEMA, **options) -> DataFrame:
    """JSON lines with ``file_name``, ``line_at`` (row order inside the file's splits) and ``_bad``.

    ``_bad`` holds the text of malformed lines and is null for good ones; blank lines are skipped.
    """
    reader = spark.read.schema(f"{schema}, {BAD} string").option("mode", "PERMISSIVE")
    df = reader.options(columnNameOfCorruptRecord=BAD, **options).json(path)
    block = F.col("_metadata.file_block_start")
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("file_name"),
        F.struct(block.alias("block"), F.monotonically_increasing_id().alias("row")).alias("line_at"),
    )


def parse_jsonl(df: DataFrame, line_col: str, schema: str = SCRAPE_SCHEMA) -> DataFrame:
    """Parse a column of JSON lines; adds the schema's columns and ``_bad``; blank lines are skipped."""
    parsed = F.from_json(
        F.col(line_col),
        f"{schema}, {BAD} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD},
    )
    rest = [c for c in df.columns if c != line_col]
    return df.where(F.trim(line_col) != "").select(*rest, parsed.alias("__j")).select(*rest, "__j.*")


def good_lines(df: DataFrame) -> DataFrame:
    return df.where(F.col(BAD).isNull()).drop(BAD)


def rejected_lines(df: DataFrame) -> DataFrame:
    return df.where(F.col(BAD).isNotNull()).select(*[c for c in ("file_name", BAD) if c in df.columns])


def select_files(df: DataFrame, pattern: str, file_col: str = "file_name") -> DataFrame:
    """Rows whose file name matches the pattern."""
    return df.where(F.col(file_col).rlike(pattern))


def modified_after(days_back: int, now: datetime | None = None) -> dict[str, str]:
    """Reader option that skips files last modified before now - days, at listing time."""
    cut = (now or datetime.now(timezone.utc)) - timedelta(days=days_back)
    return {"modifiedAfter": cut.strftime("%Y-%m-%dT%H:%M:%S")}


def latest_snapshot(df: DataFrame, file_col: str = "file_name") -> DataFrame:
    """Rows of the lexicographically last file."""
    return df.where(F.col(file_col) == df.agg(F.max(file_col)).scalar())


def first_per_url(df: DataFrame, order: list[Column]) -> DataFrame:
    """First record per url, records without url dropped."""
    return first_per_key(df.where(F.col("job_url").isNotNull()), ["job_url"], order)


def load_latest(spark: SparkSession, processed: str, schema: str = SCRAPE_SCHEMA) -> DataFrame:
    """Good records of the last consolidated file; only that file is read."""
    names = (
        spark.read.format("binaryFile").option("pathGlobFilter", "consolidated-*.jsonl").load(processed)
        .select("path").where(F.col("path").rlike(CONSOLIDATED))
    )
    last = names.agg(F.max("path")).first()[0]
    if last is None:
        return spark.createDataFrame([], schema)
    return good_lines(read_jsonl(spark, last, schema)).drop("file_name", "line_at")


def load_history(
    spark: SparkSession, processed: str, raw: str | None = None, schema: str = SCRAPE_SCHEMA
) -> DataFrame:
    """Consolidated then raw files in name order; the first record per url wins."""
    parts = [
        read_jsonl(spark, processed, schema, pathGlobFilter="consolidated-*.jsonl").withColumn("stage", F.lit(0))
    ]
    if raw is not None:
        parts.append(
            read_jsonl(spark, raw, schema, pathGlobFilter="{ai-jobs-,batch-}*.jsonl").withColumn("stage", F.lit(1))
        )
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return merge_history(good_lines(both), [F.col("line_at")]).drop("stage", "file_name", "line_at")


def merge_history(df: DataFrame, line: list[Column]) -> DataFrame:
    """First per url over (stage, file name, line)."""
    return first_per_url(df, [F.col("stage"), F.col("file_name"), *line])


def load_recent(
    spark: SparkSession, raw: str, days_back: int = 7, schema: str = SCRAPE_SCHEMA, now: datetime | None = None
) -> DataFrame:
    """Raw files of the last days, first record per url."""
    opts = {"pathGlobFilter": "{ai-jobs-,batch-}*.jsonl", **modified_after(days_back, now)}
    df = good_lines(read_jsonl(spark, raw, schema, **opts))
    return first_per_url(df, [F.col("file_name"), F.col("line_at")]).drop("file_name", "line_at")
