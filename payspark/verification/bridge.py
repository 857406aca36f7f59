"""Posting-shaped tables derived from the star-schema test tables, in Spark and in plain SQL.

Both engines run the same text; ``{name}`` marks a table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pay
from ..operators.features import company_tier
from ..plans.merge import merge_sources
from ..session import written_once
from ..sources.files import stamp_source

# --- fixed values: the derived postings table ---------------------------------------------------------------
POSTINGS = """
SELECT l.l_orderkey AS k1, l.l_linenumber AS k2, l.l_partkey AS k3, l.l_suppkey AS k4,
 CASE o.o_orderstatus WHEN 'F' THEN 'h1b' WHEN 'O' THEN 'adzuna' ELSE 'linkedin' END AS data_source,
 CASE p.p_type WHEN 'ECONOMY' THEN 'Data Scientist' WHEN 'SMALL' THEN 'Junior ML Engineer'
   WHEN 'MEDIUM' THEN 'Senior Machine Learning Engineer' WHEN 'PROMO' THEN 'Principal AI Researcher'
   WHEN 'STANDARD' THEN 'Data Engineer' ELSE 'Retail Sales Associate' END AS job_title,
 CASE p.p_partkey % 8 WHEN 0 THEN 'Google LLC' WHEN 1 THEN 'OpenAI' WHEN 2 THEN 'Lyft Inc'
   WHEN 3 THEN 'Goldman Sachs' WHEN 4 THEN NULL ELSE c.c_name END AS employer_name,
 CASE c.c_nationkey % 9 WHEN 0 THEN 'CA' WHEN 1 THEN 'new york' WHEN 2 THEN ' WA ' WHEN 3 THEN 'TX'
   WHEN 4 THEN 'Massachusetts' WHEN 5 THEN 'CO' WHEN 6 THEN 'IL' WHEN 7 THEN 'FL' END AS location_state,
 CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Hour' WHEN '2-HIGH' THEN 'Week' WHEN '3-MEDIUM' THEN 'Bi-Weekly'
   WHEN '4-NOT SPECIFIED' THEN 'Month' ELSE 'Year' END AS wage_unit,
 l.l_extendedprice * 3 / CASE o.o_orderpriority WHEN '1-URGENT' THEN 2080 WHEN '2-HIGH' THEN 52
   WHEN '3-MEDIUM' THEN 26 WHEN '4-NOT SPECIFIED' THEN 12 ELSE 1 END AS wage_from,
 CASE p.p_size % 5 WHEN 0 THEN 'python,pytorch,aws' WHEN 1 THEN 'sql,spark,airflow' WHEN 2 THEN 'nlp,llm,docker'
   WHEN 3 THEN '' END AS skills_csv,
 CASE l.l_linenumber % 4 WHEN 0 THEN '$120K - $150K'
   WHEN 1 THEN '$' || CAST(CAST(floor(l.l_quantity) AS BIGINT) AS VARCHAR(20)) || '/hr'
   WHEN 2 THEN '$95,500.50/yr' ELSE 'Not specified' END AS salary_text,
 CASE l.l_linenumber % 4 WHEN 0 THEN '5+ years' WHEN 1 THEN '3-6 years' WHEN 2 THEN '7 yrs'
   ELSE 'Not specified' END AS experience_text,
 CASE l.l_returnflag WHEN 'N' THEN 'Mid-Senior level' WHEN 'R' THEN 'Entry level' END AS seniority_level,
 CASE l.l_linestatus WHEN 'F' THEN 'Masters' END AS education,
 'https://jobs.example.com/' || CAST(l.l_orderkey % 997 AS VARCHAR(20)) AS job_url,
 o.o_orderdate AS received_date, l.l_shipdate AS collected_at,
 CAST(year(o.o_orderdate) + 24 AS INT) AS year
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {customer} c ON o.o_custkey = c.c_custkey
 JOIN {part} p ON l.l_partkey = p.p_partkey
"""
TABLES = ("lineitem", "orders", "customer", "part")

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query and, where it can be said in SQL, its check."""

    def register(fn):
        REGISTRY[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def postings(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(POSTINGS, **{t: table(spark, sf, t) for t in TABLES})


def skills_array():
    """null csv -> null, empty csv -> empty array."""
    csv = F.col("skills_csv")
    return F.when(csv == "", F.array().cast("array<string>")).otherwise(F.split(csv, ","))


def paid(spark: SparkSession, sf: str) -> DataFrame:
    """Postings with yearly pay and the skills array."""
    return postings(spark, sf).withColumns(
        {
            "annual_salary": pay.annualize_wage(F.col("wage_from"), F.col("wage_unit")),
            "skills": skills_array(),
            "estimated_yoe": pay.parse_experience_years(F.col("experience_text")),
        }
    )


def source_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return tables_of(paid(spark, sf))


def tables_of(df: DataFrame) -> dict[str, DataFrame]:
    """One table per registered source, in that source's own column names."""

    def part(source):
        return df.where(F.col("data_source") == source)

    h1b = part("h1b").select(
        "job_title", "employer_name", F.concat(F.lit("City "), F.col("k4") % 10).alias("worksite_city"),
        F.col("location_state").alias("worksite_state"), "annual_salary", F.col("year").alias("fiscal_year"),
        F.concat(F.lit("15-"), F.col("k3") % 5).alias("soc_code"),
    )
    adzuna = part("adzuna").select(
        F.col("job_title").alias("title"), F.col("employer_name").alias("company"),
        F.concat(F.lit("City "), F.col("k4") % 10).alias("location"), F.col("location_state").alias("state"),
        F.col("annual_salary").alias("salary_avg"), "year",
    )
    linkedin = part("linkedin").select(
        "job_title", "employer_name", F.col("location_state").alias("worksite_state"), "annual_salary", "year",
        "job_url", "seniority_level", "education", "estimated_yoe", "skills",
    )
    return {"h1b": h1b, "adzuna": adzuna, "linkedin": linkedin}


def stamped_sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {s: stamp_source(df, s) for s, df in source_tables(spark, sf).items()}


def merged(spark: SparkSession, sf: str) -> DataFrame:
    """The merged table as its readers see it: written once."""
    return written_once(merge_sources(stamped_sources(spark, sf)), "merged")


def tiered(spark: SparkSession, sf: str) -> DataFrame:
    return paid(spark, sf).withColumn("company_tier", company_tier(F.col("employer_name")))


# --- the same tables for the checking engine ------------------------------------------------------------------


def any_of(expr: str, words) -> str:
    tests = " OR ".join(f"contains({expr}, '{w}')" for w in words)
    return f"coalesce({tests}, false)"


def ladder(expr: str, rules, default: str, missing: str) -> str:
    whens = " ".join(f"WHEN {any_of(f'lower({expr})', words)} THEN '{label}'" for label, words in rules)
    return f"CASE WHEN {expr} IS NULL THEN '{missing}' {whens} ELSE '{default}' END"


YEARS_SQL = (
    "CASE WHEN experience_text IS NULL OR experience_text IN ('', 'Not specified') THEN NULL "
    r"WHEN regexp_matches(experience_text, '\d+\+') THEN CAST(regexp_extract(experience_text, '(\d+)\+', 1) AS INT) "
    r"WHEN regexp_matches(experience_text, '\d+\s*-\s*\d+') THEN "
    r"CAST(floor((CAST(regexp_extract(experience_text, '(\d+)\s*-\s*(\d+)', 1) AS INT) + "
    r"CAST(regexp_extract(experience_text, '(\d+)\s*-\s*(\d+)', 2) AS INT)) / 2) AS INT) "
    r"ELSE TRY_CAST(regexp_extract(experience_text, '\d+') AS INT) END"
)
PAID_SQL = f"""postings AS ({POSTINGS.format(**{t: t for t in TABLES})}),
paid AS (SELECT *, CASE wage_unit WHEN 'Hour' THEN wage_from * 2080 WHEN 'Week' THEN wage_from * 52
  WHEN 'Bi-Weekly' THEN wage_from * 26 WHEN 'Month' THEN wage_from * 12 ELSE wage_from END AS annual_salary,
  CASE WHEN skills_csv = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(skills_csv, ',') END AS skills,
  {YEARS_SQL} AS estimated_yoe FROM postings)"""
PAID = f"WITH {PAID_SQL} "
CLEAN_STATE_SQL = (
    "CASE upper(trim({c})) WHEN 'CALIFORNIA' THEN 'CA' WHEN 'NEW YORK' THEN 'NY' WHEN 'WASHINGTON' THEN 'WA' "
    "WHEN 'TEXAS' THEN 'TX' WHEN 'MASSACHUSETTS' THEN 'MA' ELSE upper(trim({c})) END"
)
MERGED_SQL = f"""{PAID_SQL},
std AS (SELECT job_title, employer_name,
  CASE WHEN data_source IN ('h1b', 'adzuna') THEN 'City ' || CAST(k4 % 10 AS VARCHAR) END AS location_city,
  location_state, annual_salary, year,
  CASE WHEN data_source = 'h1b' THEN '15-' || CAST(k3 % 5 AS VARCHAR) END AS soc_code,
  CASE WHEN data_source = 'linkedin' THEN job_url END AS job_url,
  CASE WHEN data_source = 'linkedin' THEN seniority_level END AS seniority_level,
  CASE WHEN data_source = 'linkedin' THEN education END AS education,
  CASE WHEN data_source = 'linkedin' THEN estimated_yoe END AS estimated_yoe,
  CASE WHEN data_source = 'linkedin' THEN skills END AS skills,
  data_source, CASE WHEN data_source = 'adzuna' THEN 2 ELSE 1 END AS source_priority FROM paid),
ranged AS (SELECT * FROM std WHERE job_title IS NOT NULL AND annual_salary BETWEEN 35000 AND 600000),
fences AS (SELECT data_source, count(*) AS n, quantile_cont(annual_salary, 0.25) AS q1,
  quantile_cont(annual_salary, 0.75) AS q3 FROM ranged GROUP BY data_source),
valid AS (SELECT r.* FROM ranged r JOIN fences f USING (data_source) WHERE n <= 10 OR
  (annual_salary >= greatest(q1 - 3 * (q3 - q1), 35000) AND annual_salary <= least(q3 + 3 * (q3 - q1), 600000))),
scored AS (SELECT *, round(least(1.0, CASE WHEN len(skills) > 0 THEN 0.3 ELSE 0 END
  + CASE WHEN estimated_yoe IS NOT NULL THEN 0.2 ELSE 0 END + CASE WHEN education IS NOT NULL THEN 0.1 ELSE 0 END
  + CASE WHEN seniority_level IS NOT NULL THEN 0.1 ELSE 0 END + CASE WHEN employer_name IS NOT NULL THEN 0.1 ELSE 0 END
  + CASE WHEN location_state IS NOT NULL THEN 0.1 ELSE 0 END + 0.1 / source_priority), 6) AS quality_score FROM valid),
ranked AS (SELECT *, row_number() OVER (PARTITION BY job_title, employer_name, location_state, year, annual_salary,
  job_url, data_source ORDER BY quality_score DESC, source_priority, location_city NULLS LAST, soc_code NULLS LAST,
  seniority_level NULLS LAST, education NULLS LAST, estimated_yoe NULLS LAST, skills NULLS LAST) AS rn FROM scored),
merged AS (SELECT job_title, employer_name, location_city, {CLEAN_STATE_SQL.format(c="location_state")} AS location_state,
  annual_salary, coalesce(year, 2024) AS year, soc_code, job_url, seniority_level, education, estimated_yoe, skills,
  data_source, source_priority, CAST(quality_score AS DOUBLE) AS quality_score FROM ranked WHERE rn = 1)"""
MERGED = f"WITH {MERGED_SQL} "
