"""From each feed to its cleaned table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pay
from ..operators.records import (
    clean_scrape_records,
    dedup_best_record,
    filter_ai_titles,
    filter_salaried,
    latest_per_key,
    standardize_postings,
    union_sources,
)
from ..sources.feeds import derive_posting_columns, flatten_postings, flatten_wage_series


def add_annual_salary(df: DataFrame) -> DataFrame:
    """Yearly pay of disclosure rows; without a unit column wages count as yearly."""
    if "wage_from" not in df.columns:
        return df
    unit = F.col("wage_unit") if "wage_unit" in df.columns else None
    updates = {c: pay.to_double(F.col(c)) for c in ("wage_from", "wage_to") if c in df.columns}
    return df.withColumns({**updates, "annual_salary": pay.annualize_wage(F.col("wage_from"), unit)})


def disclosure_table(years: dict[int, DataFrame], ai_only: bool = True) -> DataFrame:
    """Disclosure tables per fiscal year (headers already normalised) to one table."""
    parts = []
    for year, df in years.items():
        df = df.withColumn("fiscal_year", F.lit(year))
        parts.append(add_annual_salary(filter_ai_titles(df) if ai_only else df))
    return union_sources(parts)


def job_board_table(df: DataFrame, posting: str, query: Column, location: Column) -> DataFrame:
    return derive_posting_columns(flatten_postings(df, posting, query, location))


def postings_table(df: DataFrame, low: float | None = None, high: float | None = None) -> DataFrame:
    """Scraped records (latest, history or recent) to standardised, salaried postings."""
    return filter_salaried(standardize_postings(df), low, high)


def wage_benchmarks(df: DataFrame, payload: str) -> DataFrame:
    """Newest annual wage per occupation."""
    return latest_per_key(flatten_wage_series(df, payload), "soc_code", tie_break=[F.col("series_id")])


def scrape_dedup(df: DataFrame, seen: list[Column], now: Column | None = None) -> DataFrame:
    """Cleaned scrape records, the best one per url."""
    return dedup_best_record(clean_scrape_records(df, now), seen)


def scrape_counters(df: DataFrame, bad_col: str | None = None, file_col: str | None = None) -> DataFrame:
    """Files, records, invalid, duplicate and cleaned counts with the dedup rate; one pass plus a distinct."""
    bad = F.col(bad_col).isNotNull() if bad_col else F.lit(False)
    ok = ~bad
    for c in ("job_url", "position", "company"):
        ok = ok & F.coalesce(F.col(c) != "", F.lit(False))
    # count per url first, so the distinct count needs no wide shuffle
    per_url = df.groupBy(F.when(ok, F.col("job_url")).alias("url")).agg(F.count(F.lit(1)).alias("c"))
    row = per_url.agg(
        F.sum("c").alias("total_records"),
        F.coalesce(F.sum(F.when(F.col("url").isNull(), F.col("c"))), F.lit(0)).alias("invalid_records"),
        F.count("url").alias("cleaned_records"),
    )
    dup = F.col("total_records") - F.col("invalid_records") - F.col("cleaned_records")
    out = row.withColumn("duplicates_removed", dup).withColumn(
        "dedup_rate_pct", F.round(F.try_divide(F.col("duplicates_removed") * 100.0, F.col("total_records")), 1)
    )
    if file_col:
        out = out.withColumn("files_processed", df.agg(F.countDistinct(file_col)).scalar())
    return out
