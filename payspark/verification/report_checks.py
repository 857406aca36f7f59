"""Checks of the profile reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules
from ..operators import profile as p
from ..plans.merge import merge_report
from .bridge import MERGED, PAID, any_of, check, merged, paid, stamped_sources, tiered
from .record_checks import SKILL_TABLE, SKILL_TEXT, TIER_SQL, wage_payloads  # noqa: F401

EDA = "annual_salary BETWEEN 30000 AND 1000000"


def rounded(df, digits=4, keep=()):
    kinds = dict(df.dtypes)
    return df.select(
        *[F.round(c, digits).alias(c) if kinds[c] == "double" and c not in keep else F.col(c) for c in df.columns]
    )


def q(x, pct, name, digits=4):
    return f"round(quantile_cont({x}, {pct}), {digits}) AS {name}"


def moments(x, names=("mean", "std", "min", "max"), prefix="", digits=4):
    f = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max", "median": "median"}
    return ", ".join(f"round({f[n]}({x}), {digits}) AS {prefix}{n}" for n in names)


A = "annual_salary"


@check(
    "salary_summary",
    PAID + f"SELECT count(*) AS count, {moments(A)}, {q(A, 0.5, 'median')}, {q(A, 0.25, 'percentile_25')}, "
    f"{q(A, 0.75, 'percentile_75')}, {q(A, 0.9, 'percentile_90')} FROM paid WHERE {A} BETWEEN 50000 AND 1000000",
)
def _(spark, sf):
    return rounded(p.salary_summary(paid(spark, sf)))


@check(
    "merge_summary",
    MERGED + "SELECT count(*) AS total_records, count(DISTINCT employer_name) AS unique_employers, count(DISTINCT job_title) AS unique_titles, "
    + moments(A, ("mean", "median", "std", "min", "max"), "salary_") + " FROM merged",
)
def _(spark, sf):
    return rounded(p.merge_summary(merged(spark, sf)))


@check(
    "merge_report_counts",
    MERGED + "SELECT count(*) AS total_records, count(*) FILTER (data_source = 'h1b') AS h1b, round(avg(quality_score), 4) AS quality_mean FROM merged",
)
def _(spark, sf):
    text = merge_report(merged(spark, sf))
    parsed = F.from_json(
        "report",
        "summary_statistics struct<total_records: bigint>, source_distribution map<string, bigint>, "
        "quality_score_stats struct<mean: double>",
    )
    return text.select(parsed.alias("r")).select(
        F.col("r.summary_statistics.total_records").alias("total_records"),
        F.col("r.source_distribution")["h1b"].alias("h1b"),
        F.round("r.quality_score_stats.mean", 4).alias("quality_mean"),
    )


ROLE = f"""{PAID}, r AS (SELECT job_title AS search_query, annual_salary AS salary_avg, CASE WHEN k2 % 3 > 0 THEN annual_salary * 0.9 END AS lo,
  annual_salary * 1.1 AS hi FROM paid WHERE annual_salary > 30000) """


@check(
    "salary_by_role",
    ROLE + "SELECT search_query, " + ", ".join(
        f"round_even({f}(salary_avg), 0) AS salary_avg_{n}"
        for n, f in (("mean", "avg"), ("median", "median"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
    ) + ", count(*) AS salary_avg_count, round_even(avg(lo), 0) AS salary_min_mean, round_even(avg(hi), 0) AS salary_max_mean FROM r GROUP BY 1",
)
def _(spark, sf):
    pay = F.col(A)
    df = paid(spark, sf).select(
        F.col("job_title").alias("search_query"), pay.alias("salary_avg"),
        F.when(F.col("k2") % 3 > 0, pay * 0.9).alias("salary_min"), (pay * 1.1).alias("salary_max"),
    )
    return p.salary_by_role(df)


@check(
    "salary_by_state",
    PAID + f"""SELECT location_state, count(*) AS count, {q(A, 0.5, 'median')}, {moments(A, ('mean', 'std'))} FROM paid
    WHERE {EDA} AND location_state IS NOT NULL GROUP BY 1 HAVING count(*) >= 10 ORDER BY quantile_cont({A}, 0.5) DESC, 1 LIMIT 15""",
)
def _(spark, sf):
    return rounded(p.salary_by_state(paid(spark, sf)))


@check(
    "median_salary_by_state",
    MERGED + f"""SELECT location_state, count(*) AS count, {q(A, 0.5, 'median')} FROM merged WHERE {EDA} AND location_state IS NOT NULL
    GROUP BY 1 HAVING count(*) >= 10 ORDER BY quantile_cont({A}, 0.5) DESC, 1 LIMIT 15""",
)
def _(spark, sf):
    return rounded(p.group_medians(merged(spark, sf), "location_state", 10, 15))


@check(
    "state_tiers",
    PAID + f""", s AS (SELECT location_state, count(*) AS count, quantile_cont({A}, 0.5) AS median FROM paid
      WHERE {EDA} AND location_state IS NOT NULL GROUP BY 1 HAVING count(*) >= 20 ORDER BY 3 DESC, 1 LIMIT 15),
    c AS (SELECT *, (SELECT quantile_cont(median, 0.75) FROM s) AS t, (SELECT quantile_cont({A}, 0.5) FROM paid WHERE {EDA}) AS o FROM s)
    SELECT location_state, count, round(median, 4) AS median, round(t, 4) AS tier1_threshold, round(o, 4) AS overall_median,
      median >= t AS tier1, median > o AS above_overall FROM c""",
)
def _(spark, sf):
    return rounded(p.state_tiers(paid(spark, sf)))


@check(
    "salary_by_tier",
    PAID + f""", t AS (SELECT *, {TIER_SQL} AS company_tier FROM paid) SELECT company_tier, count(*) AS count, {q(A, 0.5, 'median')}
    FROM t WHERE {EDA} GROUP BY 1 HAVING count(*) >= 10""",
)
def _(spark, sf):
    return rounded(p.salary_by_tier(tiered(spark, sf)))


@check(
    "salary_by_seniority",
    PAID + f""", b AS (SELECT seniority_level, count(*) AS count, quantile_cont({A}, 0.25) AS q25, quantile_cont({A}, 0.5) AS median,
      quantile_cont({A}, 0.75) AS q75 FROM paid WHERE {EDA} AND seniority_level IS NOT NULL GROUP BY 1 HAVING count(*) >= 10),
    w AS (SELECT seniority_level, min({A}) AS lo, max({A}) AS hi FROM paid JOIN b USING (seniority_level)
      WHERE {EDA} AND {A} BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) GROUP BY 1)
    SELECT seniority_level, count, round(q25, 4) AS q25, round(median, 4) AS median, round(q75, 4) AS q75,
      round(lo, 4) AS whisker_low, round(hi, 4) AS whisker_high FROM b JOIN w USING (seniority_level)""",
)
def _(spark, sf):
    return rounded(p.salary_by_seniority(paid(spark, sf)))


@check(
    "salary_by_wage_level",
    PAID + f"""SELECT k2 % 4 + 1 AS wage_level, count(*) AS count, {q(A, 0.5, 'median')} FROM paid WHERE {EDA} GROUP BY 1 HAVING count(*) >= 10""",
)
def _(spark, sf):
    return rounded(p.salary_by_wage_level(paid(spark, sf).withColumn("wage_level", F.col("k2") % 4 + 1)))


@check(
    "salary_by_title",
    PAID + f"""SELECT job_title, count(*) AS count, {q(A, 0.5, 'median')}, {moments(A, ('mean',))} FROM paid WHERE {EDA} GROUP BY 1
    HAVING count(*) >= 20 ORDER BY quantile_cont({A}, 0.5) DESC, 1 LIMIT 15""",
)
def _(spark, sf):
    return rounded(p.salary_by_title(paid(spark, sf)))


@check(
    "salary_by_clean_title",
    PAID + f"""SELECT lower(trim(job_title)) AS job_title, count(*) AS count, {q(A, 0.5, 'median')}, {moments(A, ('mean',))} FROM paid WHERE {EDA}
    GROUP BY 1 HAVING count(*) >= 5 ORDER BY quantile_cont({A}, 0.5) DESC, 1 LIMIT 20""",
)
def _(spark, sf):
    return rounded(p.salary_by_title(paid(spark, sf), 5, 20, normalise=True))


MELT = ("employer_name", "location_state", "skills_csv", "seniority_level", "education", "job_title")


def _missing_sql():
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS missing FROM paid" for c in MELT
    )
    return f", m AS ({rows}) "


@check("missing_profile", PAID + _missing_sql() + "SELECT column_name, rows, missing, round(missing * 100.0 / rows, 4) AS missing_pct FROM m")
def _(spark, sf):
    return rounded(p.missing_counts(paid(spark, sf).select(*MELT)), 4)


@check(
    "missing_report",
    PAID + _missing_sql() + "SELECT column_name, missing, round(missing * 100.0 / rows, 2) AS percentage FROM m WHERE missing > 0 ORDER BY missing DESC, 1 LIMIT 10",
)
def _(spark, sf):
    return p.missing_report(paid(spark, sf).select(*MELT))


@check(
    "missing_status",
    PAID + """, m AS (SELECT 'employer_name' AS column_name, (count(*) - count(employer_name)) * 100.0 / count(*) AS v FROM paid UNION ALL
      SELECT 'annual_salary', (count(*) - count(annual_salary)) * 100.0 / count(*) FROM paid)
    SELECT column_name, round(v, 4) AS missing_pct, CASE WHEN v < 5 THEN 'Good' WHEN v < 20 THEN 'Fair' ELSE 'Poor' END AS status FROM m""",
)
def _(spark, sf):
    return rounded(p.missing_status(paid(spark, sf), ("employer_name", "annual_salary")), 4)


@check(
    "table_profile",
    PAID + f"SELECT count(*) AS records, 22 AS columns, count({A}) AS salary_count, "
    + moments(A, ("mean", "median", "std", "min", "max"), "salary_") + f", {q(A, 0.25, 'salary_q25')}, {q(A, 0.75, 'salary_q75')} FROM paid",
)
def _(spark, sf):
    return rounded(p.table_profile(paid(spark, sf)))


def _describe_sql():
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, {moments(c, ('mean', 'std', 'min'))}, {q(c, 0.25, 'q25')}, "
        f"{q(c, 0.5, 'median')}, {q(c, 0.75, 'q75')}, round(max({c}), 4) AS max FROM d"
        for c in ("annual_salary", "estimated_yoe", "year")
    )


@check(
    "numeric_describe",
    PAID + ", d AS (SELECT annual_salary, CAST(estimated_yoe AS DOUBLE) AS estimated_yoe, CAST(year AS DOUBLE) AS year FROM paid) " + _describe_sql(),
)
def _(spark, sf):
    return rounded(p.numeric_describe(paid(spark, sf), ["annual_salary", "estimated_yoe", "year"]))


@check("source_counts", PAID + "SELECT data_source, count(*) AS records FROM paid GROUP BY 1")
def _(spark, sf):
    return p.source_counts(paid(spark, sf))


@check(
    "quality_by_source",
    MERGED + """, w AS (SELECT data_source, quality_score FROM merged UNION ALL SELECT 'all', quality_score FROM merged)
    SELECT data_source, count(*) AS records, round(avg(quality_score), 4) AS mean, round(median(quality_score), 4) AS median,
      round(stddev_samp(quality_score), 4) AS std FROM w GROUP BY 1""",
)
def _(spark, sf):
    return rounded(p.quality_by_source(merged(spark, sf)), 4)


@check(
    "title_cardinality",
    PAID + "SELECT count(*) AS records, count(DISTINCT job_title) AS unique_titles, round(count(DISTINCT job_title) / count(*), 8) AS ratio, false AS high_cardinality FROM paid",
)
def _(spark, sf):
    return rounded(p.title_cardinality(paid(spark, sf)), 8)


@check("top_titles", PAID + "SELECT job_title, count(*) AS count FROM paid GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def _(spark, sf):
    return p.top_values(paid(spark, sf), "job_title", 15)


@check(
    "top_employers",
    PAID + "SELECT employer_name, count(*) AS count FROM paid WHERE employer_name IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def _(spark, sf):
    return p.top_values(paid(spark, sf), "employer_name", 10)


def _hist_sql(expr, bins, where="true", source="paid"):
    return f""", x AS (SELECT {expr} AS x FROM {source} WHERE {where}), e AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / {bins} AS w FROM x),
    g AS (SELECT least(floor((x - lo) / w), {bins - 1}) AS b, x, lo, hi, w FROM x, e),
    f AS (SELECT CASE WHEN x < lo + b * w THEN b - 1 WHEN x >= lo + (b + 1) * w AND b < {bins - 1} THEN b + 1 ELSE b END AS b FROM g),
    c AS (SELECT CAST(b AS INT) AS b, count(*) AS n FROM f GROUP BY 1)
    SELECT CAST(i AS INT) AS bin, round(lo + i * w, 4) AS lower, round(lo + (i + 1) * w, 4) AS upper, coalesce(n, 0) AS count
    FROM range({bins}) t(i) CROSS JOIN e LEFT JOIN c ON b = i"""


@check("salary_histogram", PAID + _hist_sql(A, 50, EDA))
def _(spark, sf):
    df = p.valid_salaries(paid(spark, sf), p.EDA_LOW, p.EDA_HIGH)
    return rounded(p.histogram(df, F.col(A), 50), 4)


@check("log_salary_histogram", PAID + _hist_sql(f"log10({A})", 50, EDA))
def _(spark, sf):
    df = p.valid_salaries(paid(spark, sf), p.EDA_LOW, p.EDA_HIGH)
    return rounded(p.histogram(df, F.log10(A), 50), 4)


@check("skill_count_histogram", PAID + _hist_sql("CAST(coalesce(len(skills), 0) AS DOUBLE)", 30))
def _(spark, sf):
    return rounded(p.histogram(paid(spark, sf), F.coalesce(F.size("skills"), F.lit(0)), 30), 4)


@check("quality_histogram", MERGED + _hist_sql("quality_score", 30, source="merged"))
def _(spark, sf):
    return rounded(p.histogram(merged(spark, sf), F.round("quality_score", 6), 30), 4)


@check(
    "outlier_report",
    PAID + f""", b AS (SELECT count(*) AS n, quantile_cont({A}, 0.25) AS q1, quantile_cont({A}, 0.75) AS q3 FROM paid WHERE {EDA}),
    f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lb, q3 + 1.5 * (q3 - q1) AS ub FROM b),
    o AS (SELECT count(*) AS c FROM paid, f WHERE {EDA} AND ({A} < lb OR {A} > ub))
    SELECT n, round(q1, 4) AS q1, round(q3, 4) AS q3, round(lb, 4) AS lower_bound, round(ub, 4) AS upper_bound, c AS outliers,
      round(c * 100.0 / n, 4) AS outlier_pct FROM f, o""",
)
def _(spark, sf):
    return rounded(p.outlier_report(paid(spark, sf)))


@check(
    "percentile_table",
    PAID + " UNION ALL ".join(
        f"SELECT 'P{n}' AS percentile, round(quantile_cont({A}, {n / 100}), 4) AS value FROM paid WHERE {EDA}"
        for n in (10, 25, 50, 75, 90, 95, 99)
    ),
)
def _(spark, sf):
    return rounded(p.percentile_table(paid(spark, sf)))


CAT_SQL = ", f AS (SELECT annual_salary, " + ", ".join(
    f"CAST(({any_of(SKILL_TEXT, w)} OR {any_of('lower(job_title)', w)}) AS INT) AS {c}" for c, w in rules.SKILL_CATEGORIES.items()
) + " FROM paid) "


@check(
    "skill_coverage",
    PAID + CAT_SQL + ", o AS (SELECT quantile_cont(annual_salary, 0.5) AS o FROM paid), u AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS category, sum({c}) AS jobs, sum({c}) * 100.0 / count(*) AS cov, "
        f"quantile_cont(CASE WHEN {c} = 1 AND {EDA} THEN annual_salary END, 0.5) AS m FROM f"
        for c in rules.SKILL_CATEGORIES
    ) + """) SELECT category, CAST(jobs AS BIGINT) AS jobs, round(cov, 4) AS coverage_pct, round(m, 4) AS median_salary,
      round(o, 4) AS overall_median, m > o AS above_overall FROM u, o""",
)
def _(spark, sf):
    return rounded(p.skill_category_coverage(paid(spark, sf)), 4)


@check(
    "category_overlap",
    PAID + CAT_SQL + "SELECT " + " + ".join(rules.SKILL_CATEGORIES) + " AS categories, count(*) AS jobs FROM f GROUP BY 1",
)
def _(spark, sf):
    return p.category_overlap(paid(spark, sf))


SKILL_LONG = ", l AS (SELECT lower(trim(unnest(skills))) AS skill, annual_salary FROM paid) "


@check(
    "skill_frequency",
    PAID + SKILL_LONG + f"""SELECT skill, count(*) AS count, round(coalesce(quantile_cont(CASE WHEN {EDA} THEN annual_salary END, 0.5), 0), 4) AS median_salary
    FROM l GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30""",
)
def _(spark, sf):
    return rounded(p.skill_frequency(paid(spark, sf)))


@check(
    "best_paid_skills",
    PAID + SKILL_LONG + f"""SELECT skill, count(*) AS n, {q(A, 0.5, 'median_salary')} FROM l WHERE {EDA} GROUP BY 1 HAVING count(*) >= 10
    ORDER BY quantile_cont({A}, 0.5) DESC, 1 LIMIT 20""",
)
def _(spark, sf):
    return rounded(p.best_paid_skills(paid(spark, sf)))


REPEATED = "CASE WHEN k2 % 3 = 0 AND skills IS NOT NULL THEN list_concat(skills, ['sql', 'aws', 'sql']) ELSE skills END"


@check(
    "skill_cooccurrence",
    PAID + f""", s AS (SELECT row_number() OVER () AS id, {REPEATED} AS skills FROM paid),
    l AS (SELECT id, unnest(skills) AS skill, generate_subscripts(skills, 1) AS pos FROM s),
    t AS (SELECT skill FROM l GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5),
    k AS (SELECT * FROM l WHERE skill IN (SELECT skill FROM t)),
    p AS (SELECT a.skill AS x, b.skill AS y FROM k a JOIN k b ON a.id = b.id AND a.pos <= b.pos),
    c AS (SELECT x AS skill, y AS other FROM p UNION ALL SELECT y, x FROM p WHERE x <> y),
    n AS (SELECT skill, other, count(*) AS count FROM c GROUP BY 1, 2)
    SELECT *, round(count * 100.0 / sum(count) OVER (PARTITION BY skill), 6) AS row_pct FROM n""",
)
def _(spark, sf):
    more = F.concat("skills", F.array(F.lit("sql"), F.lit("aws"), F.lit("sql")))
    df = paid(spark, sf).withColumn("skills", F.when(F.col("k2") % 3 == 0, more).otherwise(F.col("skills")))
    return rounded(p.skill_cooccurrence(df, 5), 6)


NUM = ("annual_salary", "wage_from", "estimated_yoe", "year", "k3")


@check(
    "correlation",
    PAID + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(corr({c}, annual_salary), 6) AS correlation FROM paid" for c in NUM
    ),
)
def _(spark, sf):
    return rounded(p.correlation_with(paid(spark, sf), columns=list(NUM)), 6)


@check(
    "correlation_matrix",
    PAID + " UNION ALL ".join(
        f"SELECT '{a}' AS column_name, '{b}' AS other, round(corr({a}, {b}), 6) AS correlation FROM paid" for a in NUM for b in NUM
    ),
)
def _(spark, sf):
    return rounded(p.correlation_matrix(paid(spark, sf), list(NUM)), 6)


@check(
    "poly_trend",
    PAID + f""", d AS (SELECT CAST(estimated_yoe AS DOUBLE) AS x, annual_salary AS y FROM paid WHERE estimated_yoe IS NOT NULL AND {EDA}),
    s AS (SELECT count(*) AS n, avg(x) AS s1, avg(x*x) AS s2, avg(x*x*x) AS s3, avg(x*x*x*x) AS s4, avg(y) AS t0, avg(x*y) AS t1, avg(x*x*y) AS t2 FROM d),
    m AS (SELECT *, s4*(s2-s1*s1) - s3*(s3-s1*s2) + s2*(s3*s1-s2*s2) AS det FROM s)
    SELECT n, round((t2*(s2-s1*s1) - s3*(t1-s1*t0) + s2*(t1*s1-s2*t0)) / det, 2) AS a,
      round((s4*(t1-s1*t0) - t2*(s3-s1*s2) + s2*(s3*t0-t1*s2)) / det, 2) AS b,
      round((s4*(s2*t0-t1*s1) - s3*(s3*t0-t1*s2) + t2*(s3*s1-s2*s2)) / det, 1) AS c FROM m""",
)
def _(spark, sf):
    out = p.poly_trend(p.valid_salaries(paid(spark, sf), p.EDA_LOW, p.EDA_HIGH))
    return out.select("n", F.round("a", 2).alias("a"), F.round("b", 2).alias("b"), F.round("c", 1).alias("c"))


AVAIL = {
    "h1b": {"job_title": "job_title", "employer_name": "employer_name", "worksite_state": "location_state", "soc_code": "k3"},
    "adzuna": {"company": "employer_name", "location": "k4", "state": "location_state", "year": "year"},
    "linkedin": {
        "job_title": "job_title", "employer_name": "employer_name", "worksite_state": "location_state", "skills": "skills",
        "seniority_level": "seniority_level", "estimated_yoe": "estimated_yoe", "education": "education", "year": "year",
    },
}


@check(
    "feature_availability",
    PAID + " UNION ALL ".join(
        f"SELECT '{s}' AS source, '{f}' AS feature, "
        + (f"round(count({AVAIL[s][f]}) * 100.0 / count(*), 4)" if f in AVAIL[s] else "max(CAST(NULL AS DOUBLE))")
        + f" AS completeness FROM paid WHERE data_source = '{s}'"
        for s in AVAIL for f in rules.KEY_FEATURES
    ),
)
def _(spark, sf):
    tables = {s: df.select(*AVAIL[s]) for s, df in stamped_sources(spark, sf).items()}
    return rounded(p.feature_availability(tables), 4)


@check(
    "availability_matrix",
    PAID + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, " + ", ".join(
            (f"coalesce(format('{{:.1f}}%', count({AVAIL[s][f]}) FILTER (data_source = '{s}') * 100.0 / "
             f"nullif(count(*) FILTER (data_source = '{s}'), 0)), 'N/A')" if f in AVAIL[s] else "'N/A'") + f" AS {s}"
            for s in AVAIL
        ) + " FROM paid GROUP BY ()"
        for f in rules.KEY_FEATURES
    ),
)
def _(spark, sf):
    tables = {s: df.select(*AVAIL[s]) for s, df in stamped_sources(spark, sf).items()}
    return p.availability_matrix(p.feature_availability(tables), list(tables))


# --- missing numbers: NaN counts as missing everywhere --------------------------------------------------------------------

GAP = "CASE WHEN k2 = 3 THEN NULL WHEN k2 = 5 THEN 'NaN'::DOUBLE ELSE annual_salary END"
GAPS = PAID + f", holed AS (SELECT * REPLACE ({GAP} AS annual_salary) FROM paid), held AS (SELECT * FROM holed WHERE NOT isnan(annual_salary))"


def holed(spark, sf):
    """Postings whose pay is null on one line and NaN on another."""
    pay = F.when(F.col("k2") == 3, None).when(F.col("k2") == 5, float("nan")).otherwise(F.col(A))
    return paid(spark, sf).withColumn(A, pay)


@check(
    "missing_with_nan",
    GAPS + f"""SELECT '{A}' AS column_name, count(*) AS rows, count(*) - (SELECT count(*) FROM held) AS missing,
      round((count(*) - (SELECT count(*) FROM held)) * 100.0 / count(*), 4) AS missing_pct FROM holed""",
)
def _(spark, sf):
    return rounded(p.missing_counts(holed(spark, sf).select(A)), 4)


@check("histogram_with_nan", GAPS + _hist_sql(A, 20, source="held").removeprefix(PAID))
def _(spark, sf):
    return rounded(p.histogram(holed(spark, sf), F.col(A), 20), 4)


@check("histogram_lines", GAPS + f" SELECT round(avg({A}), 4) AS mean, round(quantile_cont({A}, 0.5), 4) AS median FROM held")
def _(spark, sf):
    return rounded(p.histogram_lines(holed(spark, sf), F.col(A)), 4)


@check(
    "correlation_with_nan",
    GAPS + " UNION ALL ".join(f" SELECT '{c}' AS column_name, round(corr({c}, {A}), 6) AS correlation FROM held" for c in NUM if c != A),
)
def _(spark, sf):
    return rounded(p.correlation_with(holed(spark, sf), columns=[c for c in NUM if c != A]), 6)


REPORTS = {"by_title": "job_title", "by_employer": "employer_name", "by_year": "year", "by_unit": "wage_unit", "by_level": "seniority_level", "overall": "'all'"}


@check(
    "percentile_reports",
    GAPS + ", cells AS (" + " UNION ALL ".join(f"SELECT '{r}' AS report, CAST({e} AS VARCHAR) AS group_value, {A} AS v FROM held" for r, e in REPORTS.items())
    + """) SELECT report, group_value, count(*) AS n, round(avg(v) + 1e-7, 4) AS mean, round(quantile_cont(v, 0.25), 4) AS q25, round(quantile_cont(v, 0.5), 4) AS median,
      round(quantile_cont(v, 0.75), 4) AS q75 FROM cells WHERE group_value IS NOT NULL GROUP BY report, group_value""",
)
def _(spark, sf):
    reports = p.percentile_reports(holed(spark, sf), {r: F.expr(e) for r, e in REPORTS.items()}, F.col(A))
    return rounded(reports.withColumn("mean", F.col("mean") + 1e-7), 4)  # means of few cents lie on rounding's edge
