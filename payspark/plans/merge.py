"""Merge of all enabled sources into one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..operators.broadcasts import one_row
from ..operators.profile import merge_summary, quality_by_source, source_counts
from ..operators.records import (
    add_quality_score,
    clean_merged,
    dedup_by_quality,
    filter_iqr,
    profile_sources,
    require_fields,
    standardize_source,
    union_sources,
)
from ..session import written_once
from ..sources.files import load_source
from ..sources.sinks import to_report, write_report, write_table


def merge_standardized(df: DataFrame, group_by_source: bool = True, tie_break: list[str] | None = None) -> DataFrame:
    """Validate, score, deduplicate and clean a union of standardised sources.

    Fences are per source, so validating the union equals validating each source.  The union's rows with all required
    fields are written to the shared folder once: the fences and the result both read that table.
    """
    valid = filter_iqr(written_once(require_fields(df), "standardized"))
    return clean_merged(dedup_by_quality(add_quality_score(valid), group_by_source, tie_break))


def merge_sources(tables: dict[str, DataFrame], profile: str | None = None, **options) -> DataFrame:
    """Stamped source tables by name to the merged table."""
    names = [s for s in tables if profile is None or s in profile_sources(profile)]
    return merge_standardized(union_sources([standardize_source(tables[s], s) for s in names]), **options)


def run_merge(spark, root: str, out: str, profile: str | None = None) -> DataFrame:
    """Load every registered source under ``root``, write the merged table and its report under ``out``."""
    enabled = rules.PROFILES[profile] if profile else None
    tables = {
        s: load_source(spark, s, f"{root}/{s}/processed/{entry['filename']}", enabled)
        for s, entry in rules.SOURCES.items()
    }
    names = [s for s in tables if profile is None or s in profile_sources(profile)]
    union = written_once(union_sources([standardize_source(tables[s], s) for s in names]), "sources")
    write_table(merge_standardized(union), f"{out}/merged_salary_data", ("data_source",))
    merged = spark.read.parquet(f"{out}/merged_salary_data")
    write_report(merge_report(merged, merge_counters(union, merged)), f"{out}/merge_report")
    return merged


def merge_counters(union: DataFrame, merged: DataFrame) -> DataFrame:
    """One row: sources loaded, rows before and after, records dropped as invalid, duplicates removed, their shares and the time."""
    before = union.agg(F.count_distinct("data_source").alias("sources_loaded"), F.count(F.lit(1)).alias("rows_before"))
    valid = filter_iqr(require_fields(union)).agg(F.count(F.lit(1)).alias("n")).scalar()
    after = merged.agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = before.withColumns({"rows_valid": valid, "rows_after": after})
    share = lambda n, of: F.when(F.col(of) > 0, F.col(n) / F.col(of)).otherwise(0.0)
    return counted.withColumns(
        {"invalid_records": F.col("rows_before") - F.col("rows_valid"), "duplicates_removed": F.col("rows_valid") - F.col("rows_after")}
    ).withColumns(
        {"filter_rate": share("invalid_records", "rows_before"), "duplicate_rate": share("duplicates_removed", "rows_valid"), "merged_at": F.current_timestamp()}
    )


def merge_report(merged: DataFrame, counters: DataFrame | None = None) -> DataFrame:
    """Summary, rows per source, quality statistics and, where given, the merge counters as one JSON row."""
    row = merge_summary(merged)
    counted = [] if counters is None else [one_row(counters).alias("merge_counters")]
    sources = source_counts(merged).agg(  # one entry per registered source
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("data_source", "records"))))
    )
    quality = quality_by_source(merged).where(F.col("data_source") == "all").select("mean", "median", "std")
    return to_report(
        row.select(
            F.struct(*row.columns).alias("summary_statistics"),
            sources.scalar().alias("source_distribution"),
            one_row(quality).alias("quality_score_stats"),
            *counted,
        )
    )
