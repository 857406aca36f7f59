"""The full profile of the merged table as named reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import profile as p
from ..operators.features import company_tier


def explore(merged: DataFrame, sources: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Lazy reports by name.  Write ``merged`` as a table first: every report reads only its own columns."""
    tables = {"merged": merged, **(sources or {})}
    tiered = merged.withColumn("company_tier", company_tier(F.col("employer_name")))
    salary = F.col(p.SALARY)
    valid = p.valid_salaries(merged, p.EDA_LOW, p.EDA_HIGH)
    reports = {
        "table_profile": p.table_profile(merged),
        "missing_report": p.missing_report(merged),
        "missing_status": p.missing_status(merged),
        "numeric_describe": p.numeric_describe(merged),
        "type_counts": p.type_counts(merged),
        "source_counts": p.source_counts(merged),
        "salary_by_state": p.salary_by_state(merged),
        "state_tiers": p.state_tiers(merged),
        "salary_by_tier": p.salary_by_tier(tiered),
        "salary_by_title": p.salary_by_title(merged),
        "title_cardinality": p.title_cardinality(merged),
        "top_titles": p.top_values(merged, "job_title", 15),
        "salary_histogram": p.histogram(valid, salary, 50),
        "log_salary_histogram": p.histogram(valid, F.log10(salary), 50),
        "outlier_report": p.outlier_report(merged),
        "percentile_table": p.percentile_table(merged),
        "skill_coverage": p.skill_category_coverage(merged),
        "category_overlap": p.category_overlap(merged),
        "correlation": p.correlation_with(merged),
        "feature_availability": p.feature_availability(tables),
    }
    have = set(merged.columns)
    if "quality_score" in have:
        reports["quality_by_source"] = p.quality_by_source(merged)
        reports["quality_histogram"] = p.histogram(merged, F.col("quality_score"), 30)
    if "seniority_level" in have:
        reports["salary_by_seniority"] = p.salary_by_seniority(merged)
    if "estimated_yoe" in have:
        reports["poly_trend"] = p.poly_trend(valid)
    if "wage_level" in have:
        reports["salary_by_wage_level"] = p.salary_by_wage_level(merged)
    if "skills" in have:
        reports["skill_count_histogram"] = p.histogram(merged, F.coalesce(F.size("skills"), F.lit(0)), 30)
        reports["skill_frequency"] = p.skill_frequency(merged)
        reports["best_paid_skills"] = p.best_paid_skills(merged)
        reports["skill_cooccurrence"] = p.skill_cooccurrence(merged)
    return reports
