"""Header normalisation and nested API payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..functions import pay, text
from ..functions.words import lookup

POSTING_SCHEMA = (
    "id string, title string, description string, company struct<display_name: string>, "
    "location struct<display_name: string, area: array<string>>, salary_min double, salary_max double, "
    "salary_is_predicted boolean, contract_type string, contract_time string, category struct<label: string>, "
    "created string, redirect_url string"
)
WAGE_SCHEMA = (
    "status string, Results struct<series: array<struct<seriesID: string, "
    "data: array<struct<year: string, period: string, value: string>>>>>"
)


def read_disclosures(spark: SparkSession, path: str, fiscal_year: int) -> DataFrame:
    """Disclosure CSV files with normalised headers and the fiscal year."""
    df = spark.read.option("header", True).option("multiLine", False).csv(path)
    return normalise_disclosure_columns(df).withColumn("fiscal_year", F.lit(fiscal_year))


def normalise_disclosure_columns(df: DataFrame) -> DataFrame:
    """Upper-case headers, then rename the known ones; unknown headers stay upper-case."""
    return df.toDF(*[rules.DISCLOSURE_HEADERS.get(c.upper(), c.upper()) for c in df.columns])


def rename_scraped_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(rules.SCRAPED_TABLE_HEADERS)


def flatten_postings(df: DataFrame, posting: str, query: Column, location: Column) -> DataFrame:
    """Nested job-board posting struct to 16 flat columns."""
    p = F.col(posting)
    return df.select(
        p["id"].alias("job_id"),
        p["title"].alias("title"),
        F.substring(F.coalesce(p["description"], F.lit("")), 1, rules.DESCRIPTION_CUT).alias("description"),
        p["company"]["display_name"].alias("company"),
        p["location"]["display_name"].alias("location"),
        F.concat_ws(", ", p["location"]["area"]).alias("location_area"),
        p["salary_min"].alias("salary_min"),
        p["salary_max"].alias("salary_max"),
        F.coalesce(p["salary_is_predicted"], F.lit(False)).alias("salary_predicted"),
        p["contract_type"].alias("contract_type"),
        p["contract_time"].alias("contract_time"),
        p["category"]["label"].alias("category"),
        p["created"].alias("created"),
        p["redirect_url"].alias("redirect_url"),
        query.alias("search_query"),
        location.alias("search_location"),
    )


def derive_posting_columns(df: DataFrame, substring_states: bool = False) -> DataFrame:
    """Mean salary, dates, state, remote flag and seniority of flat job-board postings."""
    created = pay.parse_date(F.col("created"))
    return df.select(
        *df.columns,
        pay.salary_mid(F.col("salary_min"), F.col("salary_max")).alias("salary_avg"),
        created.alias("created_date"),
        F.year(created).alias("year"),
        F.month(created).alias("month"),
        text.state_from_area(F.col("location_area"), substring_states).alias("state"),
        text.is_remote(F.col("title"), F.col("location")).alias("is_remote"),
        text.seniority_label(F.col("title")).alias("seniority"),
    )


def explode_histogram(df: DataFrame, query_col: str, histogram: Column) -> DataFrame:
    """Range -> count map (or its JSON text) to rows."""
    return df.select(F.col(query_col).alias("query"), F.explode(histogram).alias("salary_range", "job_count"))


def histogram_from_json(payload: Column) -> Column:
    return F.from_json(payload, "histogram map<string,bigint>")["histogram"]


def flatten_wage_series(df: DataFrame, payload: str) -> DataFrame:
    """Wage API payload struct to one row per series and annual value."""
    series = F.col("s.seriesID")
    names = {k: v[0] for k, v in rules.WAGE_SERIES.items()}
    titles = {k: v[1] for k, v in rules.WAGE_SERIES.items()}
    rows = (
        df.where(F.col(payload)["status"] == "REQUEST_SUCCEEDED")
        .select(F.explode(F.col(payload)["Results"]["series"]).alias("s"))
        .select("s.seriesID", F.explode("s.data").alias("d"), series.alias("series_id"))
        .where(F.col("d.period") == "A01")
        .withColumn("wage", F.replace(F.coalesce("d.value", F.lit("0")), F.lit(","), F.lit("")).try_cast("double"))
    )
    return rows.where(F.col("wage").isNotNull()).select(
        "series_id",
        F.lit("0000000").alias("area_code"),
        F.lit("National").alias("area_name"),
        lookup(F.col("series_id"), names, "").alias("soc_code"),
        lookup(F.col("series_id"), titles, "").alias("occupation"),
        F.col("d.year").try_cast("int").alias("year"),
        F.col("wage").alias("mean_annual_wage"),
        F.lit("BLS_OEWS").alias("data_source"),
    )
