"""Row filters, standardisation, validation, union and per-key selection."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import pay, text
from ..functions.words import blank, strip
from ..session import written_once
from .ranking import distribution, join_groups

# --- projection and standardisation -------------------------------------------------------------------


def standardize_source(df: DataFrame, source: str) -> DataFrame:
    """Project a source onto its registered target columns, typed.

    A candidate list resolves on the schema: the first column that exists is taken even where it is null.
    """
    have = set(df.columns)
    out = []
    for target, candidates in rules.SOURCES[source]["columns"].items():
        kind = rules.CANONICAL_TYPES[target]
        name = next((c for c in candidates if c in have), None)
        out.append((F.lit(None) if name is None else F.col(name)).try_cast(kind).alias(target))
    return df.select(*out, "data_source", "source_priority")


def standardize_postings(df: DataFrame) -> DataFrame:
    """Scraped postings to the common columns, relevant titles only."""
    have = set(df.columns)
    cols: list[Column] = []
    if "location" in have:
        cols.append(text.state_from_city(F.col("location")).alias("worksite_state"))
    renamed = {"position": "job_title", "company": "employer_name", "posted_date": "received_date"}
    kept = ("seniority_level", "employment_type", "job_function", "industries", "education")
    cols += [F.col(c).alias(n) for c, n in renamed.items() if c in have]
    cols += [F.col(c) for c in kept if c in have]
    if "salary" in have:
        cols.append(pay.parse_salary_text(F.col("salary")).alias("annual_salary"))
    if "experience_years" in have:
        cols.append(pay.parse_experience_years(F.col("experience_years")).alias("estimated_yoe"))
    if "skills" in have:
        cols.append(F.coalesce("skills", F.array().cast("array<string>")).alias("skills"))
    cols.append(F.lit("linkedin").alias("data_source"))
    if "collected_at" in have:
        seen = pay.parse_date(F.col("collected_at"))
        cols += [seen.alias("collection_date"), F.year(seen).alias("year")]
    else:
        cols.append(F.lit(date.today().year).alias("year"))
    if "job_url" in have:
        cols.append(F.col("job_url"))
    out = df.select(*cols)
    return filter_relevant_titles(out) if "position" in have else out


def clean_scrape_records(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Drop records without url, position or company; normalise salary, skills, time and padding."""
    needed = [~blank(F.col(c)) for c in ("job_url", "position", "company")]
    updates = {
        "salary": F.when(~F.col("salary").isin("", rules.NOT_SPECIFIED), F.col("salary")),
        "skills": F.coalesce("skills", F.array().cast("array<string>")),
        "collected_at": F.coalesce(
            F.when(F.col("collected_at").cast("string") != "", F.col("collected_at")),
            now if now is not None else F.current_timestamp().cast(dict(df.dtypes)["collected_at"]),
        ),
    }
    for c in ("position", "company", "location", "description"):
        if c in df.columns:
            updates[c] = strip(F.col(c))
    return df.where(reduce(lambda a, b: a & b, needed)).withColumns(updates)


def project_scrape_record(df: DataFrame, order: list[Column]) -> DataFrame:
    """Scraper fields to the stored record; the first record per url of the run is kept.

    The first place of each url is found over the url and the columns of ``order`` alone, so that no record is sorted whole but
    those in such a place.  ``order`` must give a row the same values whenever it is read.
    """
    names = {
        "collected_at": "collectedAt", "position": "position", "company": "company", "location": "location",
        "posted_date": "date", "job_url": "jobUrl", "salary": "salary", "seniority_level": "seniorityLevel",
        "employment_type": "employmentType", "job_function": "jobFunction", "industries": "industries",
        "applicant_count": "applicantCount", "experience_years": "experienceYears", "education": "education",
        "skills": "skills", "company_logo": "companyLogo", "description": "description",
    }
    special = {
        "skills": F.coalesce("skills", F.array().cast("array<string>")),
        "description": F.substring(F.coalesce("description", F.lit("")), 1, rules.DESCRIPTION_CUT),
    }
    places = [F.col(f"__o{i}") for i in range(len(order))]
    placed = df.select("*", *[o.alias(f"__o{i}") for i, o in enumerate(order)])
    best = first_per_key(placed.select(F.col("jobUrl").alias("__url"), *places), ["__url"], places)
    best = written_once(best.toDF(*[f"__best_{c}" for c in best.columns]), "best")  # a table of known size: few are broadcast
    same = [F.col("jobUrl").eqNullSafe(F.col("__best___url"))] + [p.eqNullSafe(F.col(f"__best___o{i}")) for i, p in enumerate(places)]
    first = first_per_key(placed.join(best, reduce(lambda a, b: a & b, same), "left_semi"), ["jobUrl"], places)
    return first.select(*[special.get(n, F.col(c)).alias(n) for n, c in names.items()])


# --- filters --------------------------------------------------------------------------------------------


def require_fields(df: DataFrame, fields=rules.REQUIRED_FIELDS) -> DataFrame:
    for f in fields:
        if f in df.columns:
            df = df.where(F.col(f).isNotNull())  # plain tests reach the scan, ``dropna`` does not
    return df


def filter_salary_range(df, low=rules.SALARY_MIN, high=rules.SALARY_MAX, column="annual_salary") -> DataFrame:
    """Inclusive range; null salaries drop out."""
    return df.where(F.col(column).between(low, high))


def iqr_bounds(
    df: DataFrame, by: str, low: float, high: float, multiplier: float, column: str = "annual_salary"
) -> DataFrame:
    """Per group: the fences [max(Q1-k*IQR, low), min(Q3+k*IQR, high)], open where there are too few rows."""
    d = distribution(df, [by], F.col(column), {"q1": 0.25, "q3": 0.75}, null_group=True)
    spread = (F.col("q3") - F.col("q1")) * F.lit(float(multiplier))
    many = F.col("n") > rules.IQR_MIN_ROWS
    return d.select(
        by,
        "n",
        F.when(many, F.greatest(F.col("q1") - spread, F.lit(float(low)))).otherwise(low).alias("low_fence"),
        F.when(many, F.least(F.col("q3") + spread, F.lit(float(high)))).otherwise(high).alias("high_fence"),
    )


def filter_iqr(
    df: DataFrame,
    by: str = "data_source",
    multiplier: float = rules.IQR_MULTIPLIER,
    low: float = rules.SALARY_MIN,
    high: float = rules.SALARY_MAX,
    column: str = "annual_salary",
) -> DataFrame:
    """Range filter, then the per-group interquartile fences."""
    ranged = filter_salary_range(df, low, high, column)
    fences = iqr_bounds(ranged, by, low, high, multiplier, column).drop("n")
    kept = join_groups(ranged, fences, [by]).where(F.col(column).between(F.col("low_fence"), F.col("high_fence")))
    return kept.select(*df.columns)


def validation_report(
    df: DataFrame,
    by: str = "data_source",
    multiplier: float = rules.IQR_MULTIPLIER,
    min_records: int = rules.MIN_RECORDS_PER_SOURCE,
) -> DataFrame:
    """Rows lost per group at each validation step and whether too few remain."""
    low, high = rules.SALARY_MIN, rules.SALARY_MAX
    ranged = filter_salary_range(require_fields(df), low, high)
    fences = iqr_bounds(ranged, by, low, high, multiplier).drop("n")
    has_fields = F.col("job_title").isNotNull() & F.col("annual_salary").isNotNull()
    in_range = has_fields & F.col("annual_salary").between(low, high)
    in_fence = in_range & F.col("annual_salary").between(F.col("low_fence"), F.col("high_fence"))
    counts = (
        join_groups(df, fences, [by], "left")
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(has_fields).alias("_fields"),
            F.count_if(in_range).alias("_range"),
            F.count_if(in_fence).alias("valid"),
        )
    )
    return counts.select(
        by,
        "total",
        (F.col("total") - F.col("_fields")).alias("missing_fields"),
        (F.col("_fields") - F.col("_range")).alias("out_of_range"),
        (F.col("_range") - F.col("valid")).alias("outliers"),
        "valid",
        (F.col("valid") < min_records).alias("below_minimum"),
    )


def filter_ai_titles(df: DataFrame) -> DataFrame:
    """Rows whose job title (or, without that column, occupation title) names an AI role."""
    name = next((c for c in ("job_title", "soc_title") if c in df.columns), None)
    return df if name is None else df.where(text.ai_title(F.col(name)))


def filter_relevant_titles(df: DataFrame, title_col: str = "job_title") -> DataFrame:
    return df.where(text.relevant_title(F.col(title_col)))


def filter_salaried(df: DataFrame, low: float | None = None, high: float | None = None) -> DataFrame:
    """Rows with a salary, optionally clamped to a plausible range."""
    out = df.where(F.col("annual_salary").isNotNull())
    return out if low is None else out.where(F.col("annual_salary").between(low, high))


def profile_sources(profile: str) -> list[str]:
    if profile not in rules.PROFILES:
        raise ValueError(f"Unknown training profile '{profile}'. Available profiles: {', '.join(rules.PROFILES)}")
    return [s for s, on in rules.PROFILES[profile].items() if on]


def apply_profile(df: DataFrame, profile: str) -> DataFrame:
    return df.where(F.col("data_source").isin(*profile_sources(profile)))


def filter_lookback(df: DataFrame, years: int, ref_year: int) -> DataFrame:
    return df.where(F.col("year") >= ref_year - years + 1)


# --- quality, union, per-key selection -------------------------------------------------------------------


def add_quality_score(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    skills = F.col("skills") if "skills" in have else F.lit(None).cast("array<string>")
    present = {c: F.col(c) for c in rules.QUALITY_WEIGHTS if c in have and c not in ("skills", "source_priority")}
    return df.withColumn("quality_score", pay.quality_score(skills, F.col("source_priority"), present))


def union_sources(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in ``order``; null keys compare equal.

    The ``row_number() = 1`` shape lets Spark keep one row per key inside each map task before the shuffle,
    so a hot key moves at most one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def dedup_by_quality(df: DataFrame, group_by_source: bool = True, tie_break: list[str] | None = None) -> DataFrame:
    """Best-scored row per match key, then the better source priority, then ``tie_break`` columns."""
    keys = [c for c in rules.MATCH_FIELDS if c in df.columns]
    if group_by_source and "data_source" not in keys:
        keys.append("data_source")
    order = [F.col("quality_score").desc(), F.col("source_priority").asc()]
    order += [F.col(c).asc_nulls_last() for c in _tie_columns(df, keys, tie_break)]
    return first_per_key(df, keys, order)


def _tie_columns(df: DataFrame, keys: list[str], tie_break: list[str] | None) -> list[str]:
    """Without a given tie-break every orderable column decides, so reruns pick the same row."""
    if tie_break is not None:
        return tie_break
    used = {*keys, "quality_score", "source_priority"}
    return [c for c, kind in df.dtypes if c not in used and not kind.startswith("map")]


def dedup_best_record(df: DataFrame, seen: list[Column]) -> DataFrame:
    """Per url: a salary-bearing record, then the latest collected (as time, whatever its offset), then the first seen."""
    at = F.col("collected_at").cast("string").try_cast("timestamp")
    order = [F.col("salary").isNotNull().desc(), at.desc_nulls_last(), *seen]
    return first_per_key(df, ["job_url"], order)


def latest_per_key(df: DataFrame, key: str, year: str = "year", tie_break: list[Column] | None = None) -> DataFrame:
    return first_per_key(df, [key], [F.col(year).desc_nulls_last(), *(tie_break or [])])


def limit_per_key(df: DataFrame, key: str, n: int, order: list[Column]) -> DataFrame:
    """The first n rows of every key."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def new_records(df: DataFrame, known: DataFrame, key: str = "job_url") -> DataFrame:
    """Rows whose key is not among the known ones."""
    return df.join(known.select(key).distinct(), key, "left_anti")


def clean_merged(df: DataFrame) -> DataFrame:
    updates = {}
    if "location_state" in df.columns:
        updates["location_state"] = text.clean_state(F.col("location_state"))
    if "year" in df.columns:
        updates["year"] = pay.fill_year(F.col("year"))
    return df.withColumns(updates)


# --- lookups ---------------------------------------------------------------------------------------------


def add_benchmark(df: DataFrame, wages: DataFrame, key: str = "soc_code") -> DataFrame:
    """Benchmark wage of the occupation, null where there is none; ``wages`` holds one row per occupation."""
    return df.join(wages.select(key, F.col("mean_annual_wage").alias("benchmark_wage")), key, "left")
