"""Checks that go through the writers and readers, and a merge whose every step drops rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.profile import correlation_matrix
from ..operators.records import standardize_source, union_sources
from ..plans.merge import merge_counters, merge_standardized
from ..session import work_path, written_once
from ..sources import files, ledger, sinks
from .bridge import MERGED_SQL, PAID, PAID_SQL, check, paid, source_tables, tables_of
from .record_checks import LINE, SCRAPE_SQL, scrape_records
from .text_checks import K, KEYS

DIRTY_SQL = """dirty0 AS (SELECT * REPLACE (CASE WHEN k1 % 50 = 7 THEN NULL ELSE job_title END AS job_title,
    CASE WHEN k1 % 60 = 9 THEN NULL WHEN k1 % 97 = 0 THEN 590000.0 ELSE 90000.0 + k3 % 500 END AS annual_salary,
    CASE WHEN data_source = 'linkedin' AND k1 >= 200 THEN 'adzuna' ELSE data_source END AS data_source)
  FROM paid AS p),
dirty AS (SELECT * FROM dirty0 UNION ALL SELECT * FROM dirty0 WHERE k2 = 1)"""
MERGED_DIRTY_SQL = MERGED_SQL.replace(PAID_SQL, f"{PAID_SQL}, {DIRTY_SQL}", 1).replace("FROM paid)", "FROM dirty)", 1)


def dirty_union(spark, sf):
    """Postings with missing titles and pay, far outliers, exact copies and a source of a few rows, standardised."""
    pay = F.when(F.col("k1") % 60 == 9, None).when(F.col("k1") % 97 == 0, 590000.0).otherwise(90000.0 + F.col("k3") % 500)
    source = F.when((F.col("data_source") == "linkedin") & (F.col("k1") >= 200), "adzuna").otherwise(F.col("data_source"))
    rows = paid(spark, sf).withColumns(
        {"job_title": F.when(F.col("k1") % 50 != 7, F.col("job_title")), "annual_salary": pay, "data_source": source}
    )
    tables = tables_of(rows.unionByName(rows.where("k2 = 1")))
    return union_sources([standardize_source(files.stamp_source(df, s), s) for s, df in tables.items()])


@check(
    "merged_dirty_postings",
    f"WITH {MERGED_DIRTY_SQL} SELECT job_title, employer_name, location_city, location_state, annual_salary, year, soc_code, job_url, "
    "seniority_level, education, estimated_yoe, array_to_string(skills, ',') AS skills, data_source, source_priority, quality_score FROM merged",
)
def _(spark, sf):
    return merge_standardized(dirty_union(spark, sf)).select(
        "job_title", "employer_name", "location_city", "location_state", "annual_salary", "year", "soc_code", "job_url", "seniority_level",
        "education", "estimated_yoe", F.array_join("skills", ",").alias("skills"), "data_source", "source_priority",
        F.round("quality_score", 6).alias("quality_score"),
    )


@check(
    "merge_counters",
    f"""WITH {MERGED_DIRTY_SQL}, c AS (SELECT (SELECT count(DISTINCT data_source) FROM dirty) AS sources_loaded, (SELECT count(*) FROM dirty) AS rows_before,
      (SELECT count(*) FROM valid) AS rows_valid, (SELECT count(*) FROM merged) AS rows_after)
    SELECT *, rows_before - rows_valid AS invalid_records, rows_valid - rows_after AS duplicates_removed,
      (rows_before - rows_valid) / rows_before AS filter_rate, (rows_valid - rows_after) / rows_valid AS duplicate_rate FROM c""",
)
def _(spark, sf):
    union = written_once(dirty_union(spark, sf), "sources")  # as run_merge does: counts and merge read one table
    return merge_counters(union, merge_standardized(union)).drop("merged_at")


@check(
    "landed_source",
    PAID + "SELECT job_title, employer_name, annual_salary, year AS fiscal_year, data_source, 1 AS source_priority FROM paid WHERE data_source = 'h1b'",
)
def _(spark, sf):
    path = work_path(spark, "landed")
    sinks.write_table(source_tables(spark, sf)["h1b"], path, ("fiscal_year",))
    out = files.load_source(spark, "h1b", path)
    return out.select("job_title", "employer_name", "annual_salary", "fiscal_year", "data_source", "source_priority")


@check(
    "landed_lines",
    PAID + f"SELECT {K}, job_url, job_title AS position, false AS rejected FROM paid WHERE k2 % 5 <> 0 "
    f"UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, true FROM paid WHERE k2 % 5 = 0",
)
def _(spark, sf):
    rows = paid(spark, sf).select(*KEYS, "job_url", F.col("job_title").alias("position"))
    line = F.to_json(F.struct(*rows.columns))
    path = work_path(spark, "lines")
    rows.select(F.when(F.col("k2") % 5 == 0, F.substring(line, 1, 25)).otherwise(line)).write.text(path)
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    read = files.read_jsonl(spark, path, schema)
    kept = F.col(files.BAD).isNull()
    return read.select(*[F.when(kept, F.col(c)).alias(c) for c in rows.columns], (~kept).alias("rejected"))


@check(
    "landed_versions",
    PAID + f"SELECT {K}, data_source, copy FROM paid, (VALUES ('version'), ('latest')) AS c(copy)",
)
def _(spark, sf):
    root = work_path(spark, "versions")
    version = sinks.write_versioned(paid(spark, sf).select(*KEYS, "data_source"), root, "postings", "20250101")
    parts = [spark.read.parquet(p).withColumn("copy", F.lit(n)) for n, p in (("version", version), ("latest", f"{root}/postings_latest.parquet"))]
    return parts[0].unionByName(parts[1])


@check(
    "landed_json_table",
    PAID + f"SELECT {K}, job_title, skills_csv FROM paid",
)
def _(spark, sf):
    path = work_path(spark, "json")
    rows = paid(spark, sf).select(*KEYS, "job_title", "skills_csv")
    sinks.write_jsonl(rows, path)
    return spark.read.schema(rows.schema).json(path)


def landing(spark, sf, root: str, day: int) -> list[tuple[str, str]]:
    """One day's files: even lines come on day 0, odd ones on day 1; every third order is consolidated, the others are raw."""
    rows = scrape_records(spark, sf).where(F.col("k2") % 2 == day)
    for name, of_name in (("processed", F.col("k1") % 3 == 0), ("raw", F.col("k1") % 3 != 0)):
        landed = rows.where(of_name).drop(*[c for c in LINE if c != "collected_at"])
        landed.write.option("compression", "gzip").json(f"{root}/{name}/day={day}")
    return [(f"{root}/processed", "*.json.gz"), (f"{root}/raw", "*.json.gz")]


@check(
    "incremental_history",
    SCRAPE_SQL + """ SELECT job_url, min(CASE WHEN k1 % 3 = 0 THEN 0 ELSE 1 END)::INT AS stage, 0 AS read_again FROM scrape WHERE job_url IS NOT NULL GROUP BY job_url""",
)
def _(spark, sf):
    root = work_path(spark, "history")
    for day in (0, 1):
        folders = landing(spark, sf, root, day)
        ledger.advance_history(spark, folders, f"{root}/state")
    found, again = ledger.advance_history(spark, folders, f"{root}/state")  # nothing has landed since
    return found.select("job_url", "stage", F.lit(again).alias("read_again"))


CORRELATED = ("wage_from", "annual_salary", "year")


@check(
    "stored_matrix",
    PAID + " UNION ALL ".join(
        f"SELECT '{a}' AS column_name, '{b}' AS other, round(corr({a}, {b}), 6) AS correlation FROM paid" for a in CORRELATED for b in CORRELATED
    ),
)
def _(spark, sf):
    path = f"{work_path(spark, 'report')}/matrix"
    sinks.write_report(correlation_matrix(paid(spark, sf), list(CORRELATED)), path)
    stored = spark.read.schema("column_name string, other string, correlation double").json(path)
    return stored.withColumn("correlation", F.round("correlation", 6))
