"""Checks of sources, filters, joins, selection and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules
from ..functions import text
from ..functions.text import html_payload
from ..operators import features as fe
from ..operators import records as r
from ..operators.ordering import with_positions
from ..operators.profile import skill_items
from ..operators.splits import stratified_split, temporal_split
from ..plans.collect import add_annual_salary, job_board_table, scrape_counters, scrape_dedup, wage_benchmarks
from ..sources import feeds, files, html
from .bridge import (
    MERGED, PAID, any_of, check, ladder, merged, paid, postings, skills_array, source_tables, stamped_sources, table,
)
from .text_checks import K, KEYS



def in_order(*names):
    return [F.col(c) for c in names]


# --- sources ----------------------------------------------------------------------------------------------------


@check(
    "source_rows",
    PAID + """SELECT data_source, CASE WHEN data_source = 'adzuna' THEN 2 ELSE 1 END AS source_priority, count(*) AS records
    FROM paid GROUP BY 1, 2""",
)
def _(spark, sf):
    parts = [df.select("data_source", "source_priority") for df in stamped_sources(spark, sf).values()]
    return r.union_sources(parts).groupBy("data_source", "source_priority").agg(F.count(F.lit(1)).alias("records"))


def scrape_records(spark, sf):
    """Postings in the stored scrape layout, with gaps to clean."""
    df = postings(spark, sf)
    return df.select(
        "k1", "k2", "k3", "k4", "wage_from",
        F.col("collected_at").cast("string").alias("collected_at"),
        F.concat(F.lit(" "), "job_title", F.lit(" ")).alias("position"),
        F.when(F.col("k2") % 5 != 0, F.coalesce("employer_name", F.lit(""))).alias("company"),
        F.concat(F.lit("Metro, "), F.coalesce("location_state", F.lit("NY")), F.lit(" ")).alias("location"),
        F.col("received_date").cast("string").alias("posted_date"),
        F.when(F.col("k2") % 6 != 0, F.col("job_url")).alias("job_url"),
        F.col("salary_text").alias("salary"),
        "seniority_level",
        F.col("experience_text").alias("experience_years"),
        "education",
        skills_array().alias("skills"),
        F.lit(" some text ").alias("description"),
    )


SCRAPE_SQL = PAID + """, scrape AS (SELECT k1, k2, k3, k4, wage_from, collected_at, ' ' || job_title || ' ' AS position,
  CASE WHEN k2 % 5 <> 0 THEN coalesce(employer_name, '') END AS company,
  'Metro, ' || coalesce(location_state, 'NY') || ' ' AS location, CASE WHEN k2 % 6 <> 0 THEN job_url END AS job_url,
  salary_text AS salary, seniority_level, experience_text AS experience_years, education, skills, received_date FROM paid)"""


@check(
    "jsonl_records",
    SCRAPE_SQL + """ SELECT k1, k2, k3, k4, count(*) AS copies, min(position) AS position, min(job_url) AS job_url,
      min(len(skills)) AS skills FROM scrape WHERE k4 % 7 <> 1 AND k4 % 7 <> 0 GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY k1, k2, k3, k4"),
)
def _(spark, sf):
    df = scrape_records(spark, sf)
    line = F.to_json(F.struct("position", "job_url", "skills"))
    # one line in seven is cut off, one is blank
    broken = F.when(F.col("k4") % 7 == 0, F.substring(line, 1, 20)).when(F.col("k4") % 7 == 1, "  ").otherwise(line)
    lines = df.select("k1", "k2", "k3", "k4", broken.alias("line"))
    good = files.good_lines(files.parse_jsonl(lines, "line", "position string, job_url string, skills array<string>"))
    return good.groupBy("k1", "k2", "k3", "k4").agg(
        F.count(F.lit(1)).alias("copies"), F.min("position").alias("position"), F.min("job_url").alias("job_url"),
        F.min(F.size("skills")).alias("skills"),
    )


def landed(spark, sf):
    """Scrape records by file: later ship months are raw batches."""
    df = scrape_records(spark, sf)
    stage = F.when(F.col("k1") % 2 == 0, 0).otherwise(1)
    stem = F.when(stage == 0, "consolidated-").otherwise("batch-")
    return df.withColumns(
        {"stage": stage, "file_name": F.concat(stem, F.substring("collected_at", 1, 7), F.lit(".jsonl"))}
    )


LANDED_SQL = SCRAPE_SQL + """, landed AS (SELECT *, CAST(k1 % 2 AS INT) AS stage, CASE WHEN k1 % 2 = 0 THEN 'consolidated-' ELSE 'batch-' END
  || strftime(collected_at, '%Y-%m') || '.jsonl' AS file_name FROM scrape)"""
LINE = ["k1", "k2", "k3", "k4", "collected_at", "wage_from"]
LINE_SQL = ", ".join(LINE)


@check(
    "selected_files",
    LANDED_SQL + """ SELECT file_name, count(*) AS records FROM landed
    WHERE regexp_matches(file_name, '(ai-jobs-|batch-).*\\.jsonl$') GROUP BY file_name""",
)
def _(spark, sf):
    chosen = files.select_files(landed(spark, sf), files.RAW)
    return chosen.groupBy("file_name").agg(F.count(F.lit(1)).alias("records"))


@check(
    "latest_snapshot",
    LANDED_SQL + " SELECT k1, k2, k3, k4, file_name FROM landed WHERE file_name = (SELECT max(file_name) FROM landed)",
)
def _(spark, sf):
    return files.latest_snapshot(landed(spark, sf)).select("k1", "k2", "k3", "k4", "file_name")


@check(
    "history_first_per_url",
    LANDED_SQL + f""", n AS (SELECT *, row_number() OVER (PARTITION BY job_url ORDER BY stage, file_name, {LINE_SQL}) AS rn
    FROM landed WHERE job_url IS NOT NULL) SELECT job_url, file_name, k1, k2, k3, k4 FROM n WHERE rn = 1""",
)
def _(spark, sf):
    out = files.merge_history(landed(spark, sf), in_order(*LINE))
    return out.select("job_url", "file_name", "k1", "k2", "k3", "k4")


@check(
    "recent_first_per_url",
    LANDED_SQL + f""", n AS (SELECT *, row_number() OVER (PARTITION BY job_url ORDER BY file_name, {LINE_SQL}) AS rn
    FROM landed WHERE job_url IS NOT NULL AND stage = 1 AND collected_at >= TIMESTAMP '1998-01-01')
    SELECT job_url, file_name, k1, k2, k3, k4 FROM n WHERE rn = 1""",
)
def _(spark, sf):
    df = files.select_files(landed(spark, sf), files.RAW).where(F.col("collected_at") >= "1998-01-01")
    out = files.first_per_url(df, in_order("file_name", *LINE))
    return out.select("job_url", "file_name", "k1", "k2", "k3", "k4")


@check(
    "disclosure_table",
    PAID + f""" SELECT {K}, job_title, employer_name, worksite_state, year AS fiscal_year, round(annual_salary, 4) AS annual_salary,
      k4 AS "EXTRA_FLAG" FROM (SELECT *, location_state AS worksite_state FROM paid)
      WHERE {any_of('lower(job_title)', rules.AI_TITLE_PATTERNS)}""",
)
def _(spark, sf):
    raw = postings(spark, sf).select(
        *[F.col(c) for c in KEYS],
        F.col("job_title").alias("LCA_CASE_JOB_TITLE"),
        F.col("employer_name").alias("Employer_Name"),
        F.col("location_state").alias("worksite_state"),
        F.col("wage_from").cast("string").alias("WAGE_RATE_OF_PAY_FROM"),
        F.col("wage_unit").alias("WAGE_UNIT_OF_PAY"),
        F.col("k4").alias("extra_flag"),
        F.col("year").alias("fiscal_year"),
    )
    df = feeds.normalise_disclosure_columns(raw)
    df = r.filter_ai_titles(add_annual_salary(df))
    return df.select(
        *[F.col(c.upper()).alias(c) for c in KEYS], "job_title", "employer_name", "worksite_state",
        F.col("FISCAL_YEAR").alias("fiscal_year"), F.round("annual_salary", 4).alias("annual_salary"), "EXTRA_FLAG",
    )


@check(
    "scraped_table_columns",
    PAID + f" SELECT {K}, employer_name, job_title, round(wage_from, 7) AS wage_from, location_state AS worksite_location FROM paid",
)
def _(spark, sf):
    raw = postings(spark, sf).select(
        *KEYS, F.col("employer_name").alias("EMPLOYER"), F.col("job_title").alias("JOB TITLE"),
        F.round("wage_from", 7).alias("BASE SALARY"), F.col("location_state").alias("LOCATION"),
    )
    return feeds.rename_scraped_columns(raw)


@check(
    "html_payloads",
    """SELECT page_id, (contains(lower(left(html, 100)), '<!doctype html') OR contains(lower(left(html, 100)), '<html')) AS is_html
    FROM pages""",
)
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", html_payload(F.col("html")).alias("is_html"))


@check("data_documents", "SELECT doc_id FROM documents WHERE NOT (contains(lower(left(text, 100)), '<!doctype html') OR contains(lower(left(text, 100)), '<html'))")
def _(spark, sf):
    return html.reject_html_payloads(table(spark, sf, "documents"), "text").select("doc_id")


def board_postings(spark, sf):
    """Postings as nested job-board payloads."""
    return postings(spark, sf).select(
        *KEYS, "wage_unit",
        F.struct(
            F.concat_ws("-", "k1", "k2").alias("id"),
            F.col("job_title").alias("title"),
            F.repeat(F.concat("job_title", F.lit(". ")), F.lit(40)).alias("description"),
            F.struct(F.col("employer_name").alias("display_name")).alias("company"),
            F.struct(
                F.when(F.col("k2") % 3 == 0, "Remote").otherwise(F.col("location_state")).alias("display_name"),
                F.array(F.lit("US"), F.coalesce(F.trim("location_state"), F.lit("Elsewhere"))).alias("area"),
            ).alias("location"),
            F.when(F.col("k2") % 3 > 0, F.col("wage_from")).alias("salary_min"),
            F.when(F.col("k2") % 2 == 0, F.col("wage_from") * 2).alias("salary_max"),
            F.when(F.col("k2") % 2 == 0, F.lit(True)).alias("salary_is_predicted"),
            F.lit("permanent").alias("contract_type"),
            F.lit("full_time").alias("contract_time"),
            F.struct(F.lit("IT Jobs").alias("label")).alias("category"),
            F.col("received_date").cast("string").alias("created"),
            F.col("job_url").alias("redirect_url"),
        ).alias("posting"),
    )


BOARD_SQL = PAID + f""", b AS (SELECT k1, k2, k3, k4, collected_at, CAST(k1 AS VARCHAR) || '-' || CAST(k2 AS VARCHAR) AS job_id, job_title AS title,
  left(repeat(job_title || '. ', 40), 500) AS description, employer_name AS company,
  CASE WHEN k2 % 3 = 0 THEN 'Remote' ELSE location_state END AS location,
  'US, ' || coalesce(trim(location_state), 'Elsewhere') AS location_area,
  CASE WHEN k2 % 3 > 0 THEN wage_from END AS salary_min, CASE WHEN k2 % 2 = 0 THEN wage_from * 2 END AS salary_max,
  k2 % 2 = 0 AS salary_predicted, received_date, job_url, wage_unit FROM paid)"""


@check(
    "flattened_postings",
    BOARD_SQL + """ SELECT job_id, title, description, company, location, location_area, round(salary_min, 7) AS salary_min,
      round(salary_max, 7) AS salary_max, salary_predicted, 'permanent' AS contract_type, 'IT Jobs' AS category,
      job_url AS redirect_url, wage_unit AS search_query, 'us' AS search_location FROM b""",
)
def _(spark, sf):
    flat = feeds.flatten_postings(board_postings(spark, sf), "posting", F.col("wage_unit"), F.lit("us"))
    return flat.drop("created", "contract_time").withColumns(
        {c: F.round(c, 7) for c in ("salary_min", "salary_max")}
    )


def _area_case():
    whens = " ".join(
        f"WHEN regexp_matches(lower(location_area), '\\b{n}\\b') THEN '{c}'" for n, c in rules.AREA_STATES
    )
    return f"CASE {whens} ELSE 'Other' END"


@check(
    "job_board_table",
    BOARD_SQL + f""" SELECT job_id, CASE WHEN salary_min IS NULL THEN salary_max WHEN salary_max IS NULL THEN salary_min
      ELSE (salary_min + salary_max) / 2 END AS salary_avg, CAST(year(received_date) AS INT) AS year,
      CAST(month(received_date) AS INT) AS month, {_area_case()} AS state,
      coalesce(contains(lower(location), 'remote'), false) AS is_remote,
      {ladder('title', rules.SENIORITY_LABELS, 'Mid-level', 'Unknown')} AS seniority FROM b""",
)
def _(spark, sf):
    df = job_board_table(board_postings(spark, sf), "posting", F.col("wage_unit"), F.lit("us"))
    return df.select(
        "job_id", "salary_avg", "year", "month", "state", "is_remote", "seniority"
    )


@check(
    "histogram_rows",
    PAID + f""" SELECT {K}, job_title AS query, unnest([CAST(k2 * 10000 AS VARCHAR), 'above']) AS salary_range,
      unnest([k3, k4]) AS job_count FROM paid""",
)
def _(spark, sf):
    df = postings(spark, sf)
    counts = F.create_map((F.col("k2") * 10000).cast("string"), "k3", F.lit("above"), "k4")
    payload = F.to_json(F.struct(counts.alias("histogram")))
    rows = df.select(*KEYS, "job_title", payload.alias("payload"))
    keyed = rows.select(F.struct(*KEYS, "job_title").alias("key"), "payload")
    out = feeds.explode_histogram(keyed, "key", feeds.histogram_from_json(F.col("payload")))
    return out.select(*[F.col(f"query.{c}").alias(c) for c in KEYS], F.col("query.job_title").alias("query"),
                      "salary_range", "job_count")


SERIES = list(rules.WAGE_SERIES)


def wage_payloads(spark, sf):
    """Orders as wage-series payloads: two annual values, one of another period, one unparsable."""
    orders = table(spark, sf, "orders")
    series = F.element_at(F.array(*map(F.lit, SERIES)), (F.col("o_custkey") % len(SERIES) + 1).cast("int"))
    year = F.year("o_orderdate")
    value = F.format_number("o_totalprice", 2)

    def point(y, period, v):
        return F.struct(y.cast("string").alias("year"), F.lit(period).alias("period"), v.alias("value"))

    data = F.array(
        point(year, "A01", value), point(year - 1, "A01", F.lit("-")), point(year, "M01", value),
        point(year - 2, "A01", F.lit("50,000")),
    )
    status = F.when(F.col("o_orderstatus") == "P", "REQUEST_FAILED").otherwise("REQUEST_SUCCEEDED")
    return orders.select(
        F.struct(
            status.alias("status"),
            F.struct(F.array(F.struct(series.alias("seriesID"), data.alias("data"))).alias("series")).alias("Results"),
        ).alias("payload")
    )


WAGE_SQL = "WITH w AS (SELECT CASE o_custkey % 7 " + " ".join(
    f"WHEN {i} THEN '{s}'" for i, s in enumerate(SERIES)
) + """ END AS series_id, year(o_orderdate) AS y, round(o_totalprice, 2) AS v FROM orders WHERE o_orderstatus <> 'P'),
  p AS (SELECT series_id, y AS year, v AS wage FROM w UNION ALL SELECT series_id, y - 2, 50000 FROM w),
  n AS (SELECT *, CASE series_id """ + " ".join(
    f"WHEN '{s}' THEN '{v[0]}'" for s, v in rules.WAGE_SERIES.items()
) + " END AS soc_code, CASE series_id " + " ".join(
    f"WHEN '{s}' THEN '{v[1]}'" for s, v in rules.WAGE_SERIES.items()
) + " END AS occupation FROM p) "


@check(
    "wage_series",
    WAGE_SQL + """SELECT series_id, soc_code, occupation, CAST(year AS INT) AS year, count(*) AS records,
      round(sum(wage), 2) AS total FROM n GROUP BY 1, 2, 3, 4""",
)
def _(spark, sf):
    rows = feeds.flatten_wage_series(wage_payloads(spark, sf), "payload")
    return rows.groupBy("series_id", "soc_code", "occupation", "year").agg(
        F.count(F.lit(1)).alias("records"), F.round(F.sum("mean_annual_wage"), 2).alias("total")
    )


@check("wage_benchmarks", WAGE_SQL + "SELECT soc_code, occupation, CAST(max(year) AS INT) AS year FROM n GROUP BY 1, 2")
def _(spark, sf):
    return wage_benchmarks(wage_payloads(spark, sf), "payload").select("soc_code", "occupation", "year")


def card_pages(spark, sf):
    """Postings rendered as one search-result page each, with a complete card and one without a company."""
    df = postings(spark, sf)
    card = F.concat(
        F.lit('<ul>\n<li class="x"><div class="base-card">\n <a class="base-card__full-link big" href="'), "job_url",
        F.lit('?a=1&amp;b=2"><span>link</span></a>\n<img class="artdeco-entity-image" data-delayed-url="https://img/'), "k4",
        F.lit('.png">\n<h3 class="base-search-card__title">\n  '), "job_title",
        F.lit('  </h3><h4 class="base-search-card__subtitle"><a href="#">'), F.coalesce("employer_name", F.lit("")),
        F.lit('</a></h4><span class="job-search-card__location">'), F.coalesce(F.trim("location_state"), F.lit("")),
        F.lit('</span><span class="job-search-card__salary-info">'),
        F.when(F.col("salary_text") == "Not specified", "").otherwise(F.regexp_replace("salary_text", " ", "\n    ")),
        F.lit('</span><time class="job-search-card__listdate" datetime="'), F.date_format("received_date", "yyyy-MM-dd"),
        F.lit('">2 days ago &amp; more</time></div></li>\n<li><h3 class="base-search-card__title">No company</h3></li></ul>'),
    )
    return df.select(*KEYS, card.alias("html"))


CARD_SQL = PAID + f""" SELECT {K}, 0 AS card_index, job_title AS position, employer_name AS company,
  coalesce(trim(location_state), '') AS location, strftime(received_date, '%Y-%m-%d') AS date, salary_text AS salary,
  job_url || '?a=1&b=2' AS job_url, 'https://img/' || CAST(k4 AS VARCHAR) || '.png' AS company_logo, '2 days ago & more' AS ago_time
  FROM paid WHERE employer_name IS NOT NULL"""


@check("job_cards", CARD_SQL)
def _(spark, sf):
    return html.extract_job_cards(card_pages(spark, sf))


@check("job_cards_with_salary", CARD_SQL + " AND salary_text <> 'Not specified'")
def _(spark, sf):
    return html.extract_job_cards(card_pages(spark, sf), require_salary=True)


@check("page_job_cards", "SELECT page_id FROM pages WHERE contains(html, 'base-search-card__title')")
def _(spark, sf):
    return html.extract_job_cards(table(spark, sf, "pages")).select("page_id")


def detail_pages(spark, sf):
    df = postings(spark, sf)

    def criterion(label, value):
        return F.concat(
            F.lit(f'<li class="description__job-criteria-item"><h3>{label}</h3><span class="description__job-criteria-text criteria">\n '),
            value, F.lit(" </span></li>"),
        )

    body = F.concat(
        F.lit('<html><body><div class="compensation__salary"> '), F.regexp_replace("salary_text", "Not specified", ""),
        F.lit('</div><figcaption class="num-applicants__caption">Over '), "k4",
        F.lit(' applicants</figcaption><div class="description__text"><div>We need <div><b>Python</b></div> &amp; '),
        F.coalesce("skills_csv", F.lit("C++")), F.lit("</div><p>3 to 5 years, "), F.coalesce("education", F.lit("none")),
        F.lit("</p></div><ul>"),
        criterion("Seniority level", F.coalesce("seniority_level", F.lit(""))),
        criterion("Employment type", F.lit("Full-time")),
        F.lit("</ul></body></html>"),
    )
    return df.select(*KEYS, body.alias("html"))


@check(
    "job_details",
    PAID + f""" SELECT {K}, salary_text AS salary, coalesce(seniority_level, 'Not specified') AS seniority_level,
      'Full-time' AS employment_type, 'Not specified' AS job_function, 'Not specified' AS industries,
      CAST(k4 AS INT) AS applicant_count,
      'We need Python & ' || coalesce(skills_csv, 'C++') || '3 to 5 years, ' || coalesce(education, 'none') AS description,
      '3-5 years' AS experience_years, CASE WHEN education IS NULL THEN 'Not specified' ELSE 'Masters' END AS education FROM paid""",
)
def _(spark, sf):
    return html.extract_job_details(detail_pages(spark, sf)).drop("skills")


@check(
    "scrape_run_records",
    PAID + f""", n AS (SELECT *, row_number() OVER (PARTITION BY job_url ORDER BY {LINE_SQL}) AS rn FROM paid)
    SELECT job_title AS position, employer_name AS company, job_url, k3 AS applicant_count,
      array_to_string(coalesce(skills, []), ',') AS skills, left(repeat(job_title || '. ', 40), 500) AS description
    FROM n WHERE rn = 1""",
)
def _(spark, sf):
    df = postings(spark, sf)
    nothing = F.lit(None).cast("string")
    raw = df.select(
        *LINE, F.col("collected_at").alias("collectedAt"), F.col("job_title").alias("position"),
        F.col("employer_name").alias("company"), F.col("location_state").alias("location"),
        F.col("received_date").alias("date"), F.col("job_url").alias("jobUrl"), F.col("salary_text").alias("salary"),
        F.col("seniority_level").alias("seniorityLevel"), nothing.alias("employmentType"),
        nothing.alias("jobFunction"), nothing.alias("industries"), F.col("k3").alias("applicantCount"),
        F.col("experience_text").alias("experienceYears"), "education", skills_array().alias("skills"),
        nothing.alias("companyLogo"), F.repeat(F.concat("job_title", F.lit(". ")), F.lit(40)).alias("description"),
    )
    out = r.project_scrape_record(raw, in_order(*LINE))
    return out.select(
        "position", "company", "job_url", "applicant_count", F.array_join("skills", ",").alias("skills"), "description"
    )


# --- filters ----------------------------------------------------------------------------------------------------


@check(
    "standardized_rows",
    MERGED + """SELECT data_source, count(*) AS records, count(location_city) AS cities, count(soc_code) AS soc,
      count(job_url) AS urls, count(skills) AS skills, round(sum(annual_salary), 0) AS pay, max(source_priority) AS source_priority
      FROM std GROUP BY data_source""",
)
def _(spark, sf):
    parts = [r.standardize_source(df, s) for s, df in stamped_sources(spark, sf).items()]
    return r.union_sources(parts).groupBy("data_source").agg(
        F.count(F.lit(1)).alias("records"), F.count("location_city").alias("cities"), F.count("soc_code").alias("soc"),
        F.count("job_url").alias("urls"), F.count("skills").alias("skills"),
        F.round(F.sum("annual_salary"), 0).alias("pay"), F.max("source_priority").alias("source_priority"),
    )


@check(
    "standardized_postings",
    SCRAPE_SQL + f""" SELECT k1, k2, k3, k4, trim(position) AS job_title,
      CASE WHEN length(trim(string_split(location, ',')[-1])) = 2 THEN upper(trim(string_split(location, ',')[-1])) END AS worksite_state,
      coalesce(len(skills), 0) AS skills, CAST(year(collected_at) AS INT) AS year, job_url FROM scrape
      WHERE {any_of('lower(position)', rules.INCLUDE_KEYWORDS)} AND NOT {any_of('lower(position)', rules.EXCLUDE_KEYWORDS)}""",
)
def _(spark, sf):
    df = scrape_records(spark, sf)
    # the identifying columns ride along inside the url
    keyed = df.withColumn("job_url", F.to_json(F.struct("k1", "k2", "k3", "k4", F.col("job_url").alias("u"))))
    out = r.standardize_postings(keyed)
    key = F.from_json("job_url", "k1 bigint, k2 int, k3 bigint, k4 bigint, u string")
    return out.select(
        key.alias("k"), F.trim("job_title").alias("job_title"), "worksite_state", F.size("skills").alias("skills"), "year"
    ).select("k.k1", "k.k2", "k.k3", "k.k4", "job_title", "worksite_state", "skills", "year", F.col("k.u").alias("job_url"))


@check("required_fields", PAID + f"SELECT {K} FROM paid WHERE employer_name IS NOT NULL AND location_state IS NOT NULL")
def _(spark, sf):
    return r.require_fields(postings(spark, sf), ("employer_name", "location_state")).select(*KEYS)


@check("salary_range", PAID + f"SELECT {K} FROM paid WHERE annual_salary BETWEEN 35000 AND 600000")
def _(spark, sf):
    return r.filter_salary_range(paid(spark, sf)).select(*KEYS)


def _fence_sql(k):
    return f"""{PAID}, ranged AS (SELECT * FROM paid WHERE annual_salary BETWEEN 35000 AND 600000),
      f AS (SELECT data_source, count(*) AS n, quantile_cont(annual_salary, 0.25) AS q1, quantile_cont(annual_salary, 0.75) AS q3
      FROM ranged GROUP BY data_source) """


@check(
    "iqr_filtered",
    _fence_sql(0.5) + f"""SELECT {K}, data_source FROM ranged JOIN f USING (data_source)
    WHERE annual_salary BETWEEN greatest(q1 - 0.5 * (q3 - q1), 35000) AND least(q3 + 0.5 * (q3 - q1), 600000)""",
)
def _(spark, sf):
    return r.filter_iqr(paid(spark, sf), multiplier=0.5).select(*KEYS, "data_source")


@check(
    "validation_report",
    _fence_sql(0.5) + """, t AS (SELECT data_source, count(*) AS total, count(*) FILTER (annual_salary BETWEEN 35000 AND 600000) AS inside,
      count(*) FILTER (annual_salary BETWEEN greatest(q1 - 0.5 * (q3 - q1), 35000) AND least(q3 + 0.5 * (q3 - q1), 600000)) AS valid
      FROM paid JOIN f USING (data_source) GROUP BY data_source)
    SELECT data_source, total, 0 AS missing_fields, total - inside AS out_of_range, inside - valid AS outliers, valid,
      valid < 100 AS below_minimum FROM t""",
)
def _(spark, sf):
    return r.validation_report(paid(spark, sf), multiplier=0.5)


@check("ai_title_filter", PAID + f"SELECT {K}, job_title FROM paid WHERE {any_of('lower(job_title)', rules.AI_TITLE_PATTERNS)}")
def _(spark, sf):
    return r.filter_ai_titles(postings(spark, sf)).select(*KEYS, "job_title")


@check(
    "include_exclude_filter",
    PAID + f"SELECT {K}, job_title FROM paid WHERE {any_of('lower(job_title)', rules.INCLUDE_KEYWORDS)} "
    f"AND NOT {any_of('lower(job_title)', rules.EXCLUDE_KEYWORDS)}",
)
def _(spark, sf):
    return r.filter_relevant_titles(postings(spark, sf)).select(*KEYS, "job_title")


@check("salaried_clamped", PAID + f"SELECT {K} FROM paid WHERE annual_salary BETWEEN 30000 AND 1000000")
def _(spark, sf):
    return r.filter_salaried(paid(spark, sf), 30000.0, 1000000.0).select(*KEYS)


CLEAN_SQL = SCRAPE_SQL + """, cleaned AS (SELECT *, CASE WHEN salary NOT IN ('', 'Not specified') THEN salary END AS pay FROM scrape
  WHERE coalesce(job_url, '') <> '' AND position <> '' AND coalesce(company, '') <> '')"""


@check(
    "cleaned_scrape_records",
    CLEAN_SQL + """ SELECT k1, k2, k3, k4, trim(position) AS position, trim(company) AS company, trim(location) AS location, pay AS salary,
      array_to_string(coalesce(skills, []), ',') AS skills, 'some text' AS description FROM cleaned""",
)
def _(spark, sf):
    out = r.clean_scrape_records(scrape_records(spark, sf))
    return out.select(
        "k1", "k2", "k3", "k4", "position", "company", "location", "salary", F.array_join("skills", ",").alias("skills"),
        "description",
    )


@check("profile_filter", PAID + f"SELECT {K}, data_source FROM paid WHERE data_source = 'linkedin'")
def _(spark, sf):
    return r.apply_profile(postings(spark, sf), "linkedin_only").select(*KEYS, "data_source")


@check("lookback_filter", PAID + f"SELECT {K}, year FROM paid WHERE year >= 2024")
def _(spark, sf):
    return r.filter_lookback(postings(spark, sf), 2, 2025).select(*KEYS, "year")


@check("target_filter", PAID + f"SELECT {K} FROM paid WHERE annual_salary BETWEEN 50000 AND 1000000")
def _(spark, sf):
    return fe.filter_target(paid(spark, sf), "annual_salary").select(*KEYS)


@check(
    "numeric_matrix",
    PAID + f"SELECT {K}, coalesce(CAST(estimated_yoe AS DOUBLE), 0) AS estimated_yoe, CAST(0 AS DOUBLE) AS job_title, "
    "CAST(year AS DOUBLE) AS year FROM paid",
)
def _(spark, sf):
    return fe.numeric_matrix(paid(spark, sf), ["estimated_yoe", "job_title", "year", "year", "absent"], KEYS)


@check(
    "aligned_features",
    PAID + f"SELECT {K}, CAST(0 AS DOUBLE) AS absent, CAST(year AS DOUBLE) AS year, coalesce(CAST(estimated_yoe AS DOUBLE), 0) AS estimated_yoe FROM paid",
)
def _(spark, sf):
    return fe.align_features(paid(spark, sf), ["absent", "year", "estimated_yoe", "year"], KEYS)


# --- joins and selection --------------------------------------------------------------------------------------------


@check(
    "new_urls",
    PAID + f"SELECT {K}, job_url FROM paid WHERE year = 2025 AND job_url NOT IN (SELECT job_url FROM paid WHERE year = 2019 AND k2 > 3)",
)
def _(spark, sf):
    df = postings(spark, sf)
    known = df.where((F.col("year") == 2019) & (F.col("k2") > 3))
    return r.new_records(df.where(F.col("year") == 2025), known).select(*KEYS, "job_url")


@check(
    "benchmark_join",
    WAGE_SQL + """, m AS (SELECT soc_code, max(year) AS y FROM n GROUP BY soc_code),
    b AS (SELECT soc_code, max(wage) AS w FROM n JOIN m USING (soc_code) WHERE year = y GROUP BY soc_code)
    SELECT p_partkey, c AS soc_code, round(w, 1) AS benchmark_wage FROM
      (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '15-1221' WHEN 1 THEN '15-2051' ELSE '99-9999' END AS c FROM part)
      LEFT JOIN b ON c = soc_code""",
)
def _(spark, sf):
    wages = feeds.flatten_wage_series(wage_payloads(spark, sf), "payload")
    newest = r.latest_per_key(wages, "soc_code", tie_break=[F.desc("mean_annual_wage")])
    code = F.when(F.col("p_partkey") % 3 == 0, "15-1221").when(F.col("p_partkey") % 3 == 1, "15-2051").otherwise("99-9999")
    rows = table(spark, sf, "part").select("p_partkey", code.alias("soc_code"))
    return r.add_benchmark(rows, newest).select(
        "p_partkey", "soc_code", F.round("benchmark_wage", 1).alias("benchmark_wage")
    )


@check(
    "quality_scored",
    MERGED + """SELECT data_source, job_title, CAST(quality_score AS DOUBLE) AS quality_score, count(*) AS records FROM scored GROUP BY 1, 2, 3""",
)
def _(spark, sf):
    parts = [r.standardize_source(df, s) for s, df in stamped_sources(spark, sf).items()]
    df = r.add_quality_score(r.filter_iqr(r.require_fields(r.union_sources(parts))))
    return df.groupBy("data_source", "job_title", F.round("quality_score", 6).alias("quality_score")).agg(
        F.count(F.lit(1)).alias("records")
    )


@check(
    "dedup_by_quality",
    PAID + """, s AS (SELECT *, round(0.1 + CASE WHEN len(skills) > 0 THEN 0.3 ELSE 0 END + CASE WHEN estimated_yoe IS NOT NULL THEN 0.2 ELSE 0 END
      + CASE WHEN education IS NOT NULL THEN 0.1 ELSE 0 END + CASE WHEN seniority_level IS NOT NULL THEN 0.1 ELSE 0 END
      + CASE WHEN employer_name IS NOT NULL THEN 0.1 ELSE 0 END + CASE WHEN location_state IS NOT NULL THEN 0.1 ELSE 0 END, 6) AS q FROM paid),
    n AS (SELECT *, row_number() OVER (PARTITION BY job_title, employer_name, location_state, year, job_url, data_source
      ORDER BY q DESC, k1, k2, k3, k4, collected_at, wage_from) AS rn FROM s)
    SELECT k1, k2, k3, k4, collected_at, CAST(q AS DOUBLE) AS quality_score FROM n WHERE rn = 1""",
)
def _(spark, sf):
    df = paid(spark, sf).withColumn("source_priority", F.lit(1))
    scored = r.add_quality_score(df).withColumn("quality_score", F.round("quality_score", 6))
    # yearly pay is left out of the keys here so that there is something to drop
    out = r.dedup_by_quality(
        scored.withColumnRenamed("annual_salary", "pay"),
        tie_break=["k1", "k2", "k3", "k4", "collected_at", "wage_from"],
    )
    return out.select(*KEYS, "quality_score")


@check(
    "merged_postings",
    MERGED + """SELECT job_title, employer_name, location_city, location_state, round(annual_salary, 4) AS annual_salary, year, soc_code, job_url,
      seniority_level, education, estimated_yoe, array_to_string(skills, ',') AS skills, data_source, source_priority,
      quality_score FROM merged""",
)
def merged_postings(spark, sf):
    return merged(spark, sf).select(
        "job_title", "employer_name", "location_city", "location_state", F.round("annual_salary", 4).alias("annual_salary"),
        "year", "soc_code", "job_url", "seniority_level", "education", "estimated_yoe",
        F.array_join("skills", ",").alias("skills"), "data_source", "source_priority",
        F.round("quality_score", 6).alias("quality_score"),
    )


BEST_SQL = CLEAN_SQL + f""", n AS (SELECT *, row_number() OVER (PARTITION BY job_url ORDER BY pay IS NOT NULL DESC, collected_at DESC,
  k1, k2, k3, k4, wage_from) AS rn FROM cleaned)"""


@check("best_record_dedup", BEST_SQL + " SELECT job_url, k1, k2, k3, k4, pay AS salary FROM n WHERE rn = 1")
def _(spark, sf):
    out = scrape_dedup(scrape_records(spark, sf), in_order("k1", "k2", "k3", "k4", "wage_from"))
    return out.select("job_url", "k1", "k2", "k3", "k4", "salary")


@check(
    "scrape_counters",
    LANDED_SQL + """, g AS (SELECT count(*) AS t, count(DISTINCT file_name) AS f,
      count(*) FILTER (coalesce(job_url, '') <> '' AND coalesce(company, '') <> '') AS ok,
      count(DISTINCT job_url) FILTER (coalesce(job_url, '') <> '' AND coalesce(company, '') <> '') AS u FROM landed)
    SELECT t AS total_records, t - ok AS invalid_records, u AS cleaned_records, ok - u AS duplicates_removed,
      round((ok - u) * 100.0 / t, 1) AS dedup_rate_pct, f AS files_processed FROM g""",
)
def _(spark, sf):
    return scrape_counters(landed(spark, sf), file_col="file_name")


@check("latest_per_key", "SELECT o_custkey, CAST(max(year(o_orderdate)) AS INT) AS year FROM orders GROUP BY o_custkey")
def _(spark, sf):
    orders = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return r.latest_per_key(orders, "o_custkey", tie_break=[F.col("o_orderkey")]).select("o_custkey", "year")


@check(
    "limit_per_key",
    PAID + f""", n AS (SELECT *, row_number() OVER (PARTITION BY job_title ORDER BY {LINE_SQL}) AS rn FROM paid)
    SELECT {K}, job_title FROM n WHERE rn <= 25""",
)
def _(spark, sf):
    return r.limit_per_key(postings(spark, sf), "job_title", 25, in_order(*LINE)).select(*KEYS, "job_title")


@check(
    "quality_priority_sort",
    PAID + f"""SELECT {K}, wage_from, CASE WHEN data_source = 'adzuna' THEN 2 ELSE 1 END AS source_priority,
      row_number() OVER (ORDER BY wage_from DESC, CASE WHEN data_source = 'adzuna' THEN 2 ELSE 1 END, {LINE_SQL}) AS position FROM paid""",
)
def _(spark, sf):
    priority = F.when(F.col("data_source") == "adzuna", 2).otherwise(1)
    df = postings(spark, sf).select(*KEYS, "wage_from", priority.alias("source_priority"))
    return with_positions(df, [F.desc("wage_from"), "source_priority", *in_order(*LINE)])


@check(
    "skill_sets",
    PAID + f"""SELECT {K}, len(list_distinct(list_transform(skills, lambda s: lower(s)))) AS skills,
      CASE WHEN skills IS NULL THEN NULL ELSE list_contains(skills, 'python') AND list_contains(skills, 'aws') END AS has_both,
      len(list_intersect(skills, ['sql', 'nlp', 'docker'])) AS shared FROM paid""",
)
def _(spark, sf):
    s = F.col("skills")
    need = F.array(F.lit("python"), F.lit("aws"))
    other = F.array(F.lit("sql"), F.lit("nlp"), F.lit("docker"))
    return paid(spark, sf).select(
        *KEYS, F.size(F.array_distinct(skill_items(s))).alias("skills"),
        (F.size(F.array_except(need, s)) == 0).alias("has_both"), F.size(F.array_intersect(s, other)).alias("shared"),
    )


# --- splits -----------------------------------------------------------------------------------------------------------

HASH_SQL = """, h AS (SELECT *, CAST('0x' || left(md5('42|' || CAST(k1 AS VARCHAR) || '|' || CAST(k2 AS VARCHAR) || '|' || CAST(k3 AS VARCHAR) || '|'
  || CAST(k4 AS VARCHAR) || '|' || strftime(collected_at, '%Y-%m-%d %H:%M:%S')), 15) AS BIGINT) AS h FROM paid)"""


@check(
    "stratified_split",
    PAID + HASH_SQL + f""", n AS (SELECT *, rank() OVER (PARTITION BY year ORDER BY h) AS rk,
      count(*) OVER (PARTITION BY year) AS n FROM h),
    c AS (SELECT *, ceil(round(n * 0.15, 6)) AS t FROM n), d AS (SELECT *, ceil(round((n - t) * (0.15 / 0.85), 6)) AS v FROM c)
    SELECT {K}, year, CASE WHEN rk <= t THEN 'test' WHEN rk <= t + v THEN 'val' ELSE 'train' END AS split FROM d""",
)
def _(spark, sf):
    df = postings(spark, sf).select(*KEYS, "year")
    return stratified_split(df, KEYS)


@check(
    "temporal_split",
    PAID + HASH_SQL + f""", o AS (SELECT *, rank() OVER (ORDER BY h) AS rk, count(*) OVER () AS n FROM h WHERE year < 2024)
    SELECT {K}, year, CASE WHEN rk <= floor(round(n * 0.15, 6)) THEN 'val' ELSE 'train' END AS split FROM o
    UNION ALL SELECT {K}, year, 'test' FROM paid WHERE year >= 2024""",
)
def _(spark, sf):
    df = postings(spark, sf).select(*KEYS, "year")
    return temporal_split(df, KEYS)


# --- features ---------------------------------------------------------------------------------------------------------


def _flag_sql(expr, table_):
    return ", ".join(f"CAST({any_of(expr, w)} AS INT) AS {n}" for n, w in table_.items())


SKILL_TABLE = {f"skill_{c}": w for c, w in rules.SKILL_CATEGORIES.items()}


@check("skill_flags_from_title", PAID + f"SELECT {K}, {_flag_sql('lower(job_title)', SKILL_TABLE)} FROM paid")
def _(spark, sf):
    flags = fe.skill_flags(F.col("job_title"))
    return postings(spark, sf).select(*KEYS, *[v.alias(k) for k, v in flags.items()])


SKILL_TEXT = "coalesce(array_to_string(skills, ' '), '')"


@check("skill_flags_from_array", PAID + f"SELECT {K}, {_flag_sql(SKILL_TEXT, SKILL_TABLE)} FROM paid")
def _(spark, sf):
    flags = fe.skill_flags_from_array(F.col("skills"))
    return paid(spark, sf).select(*KEYS, *[v.alias(k) for k, v in flags.items()])


TIER_SQL = ladder("employer_name", list(rules.COMPANY_TIERS.items()), "other", "unknown")


@check("company_tier", PAID + f"SELECT {K}, {TIER_SQL} AS company_tier FROM paid")
def _(spark, sf):
    return postings(spark, sf).select(*KEYS, fe.company_tier(F.col("employer_name")).alias("company_tier"))


YOE_SQL = "CASE WHEN is_director = 1 THEN 12 WHEN is_principal = 1 OR is_staff = 1 THEN 10 WHEN is_lead = 1 OR is_manager = 1 THEN 7 WHEN is_senior = 1 THEN 5 WHEN is_entry = 1 THEN 1 ELSE 3 END"


@check(
    "experience_flags",
    PAID + f", f AS (SELECT {K}, {_flag_sql('lower(job_title)', rules.TITLE_FLAGS)} FROM paid) SELECT *, {YOE_SQL} AS estimated_yoe FROM f",
)
def _(spark, sf):
    flags = fe.title_flags(F.col("job_title"))
    df = postings(spark, sf).select(*KEYS, *[v.alias(k) for k, v in flags.items()])
    return df.withColumn("estimated_yoe", fe.title_years({k: F.col(k) for k in flags}))


@check("role_flags", PAID + f"SELECT {K}, {_flag_sql('lower(job_title)', rules.ROLE_FLAGS)} FROM paid")
def _(spark, sf):
    return postings(spark, sf).select(*KEYS, *[v.alias(k) for k, v in fe.role_flags(F.col("job_title")).items()])


def _in(codes):
    return "CAST(coalesce(s IN (" + ", ".join(f"'{c}'" for c in codes) + "), false) AS INT)"


LOC_SQL = ("CAST(coalesce(CASE s " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in rules.LOCATION_MULTIPLIERS.items())
           + f" END, 1.0) AS DOUBLE) AS col_multiplier, {_in(rules.MAJOR_HUBS)} AS is_major_tech_hub, "
           f"{_in(rules.SECONDARY_HUBS)} AS is_secondary_hub, {_in(rules.REMOTE_FRIENDLY)} AS is_remote_friendly")


@check("location_features", PAID + f", f AS (SELECT *, left(trim(upper(location_state)), 2) AS s FROM paid) SELECT {K}, {LOC_SQL} FROM f")
def _(spark, sf):
    df = postings(spark, sf).select(*KEYS, fe.state_code(F.col("location_state")).alias("s"))
    return df.select(*KEYS, *[v.alias(k) for k, v in fe.location_features(F.col("s")).items()])


@check(
    "time_features",
    PAID + f"""SELECT {K}, CAST(year(received_date) AS INT) AS year, CAST(quarter(received_date) AS INT) AS quarter,
      CAST(month(received_date) AS INT) AS month, CASE WHEN quarter(received_date) IN (1, 4) THEN 1 ELSE 0 END AS is_peak_hiring FROM paid""",
)
def _(spark, sf):
    df = postings(spark, sf)
    return df.select(*KEYS, *[v.alias(k) for k, v in fe.time_features(F.col("received_date")).items()])


STATE_SQL = "CASE s " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(rules.STATE_CODES)) + " ELSE 20 END"
TIER_CODE_SQL = "CASE company_tier " + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(rules.TIER_CODES)) + " ELSE 6 END"
FEATURE_SQL = PAID + f""", f AS (SELECT {K}, annual_salary, estimated_yoe AS given, received_date, left(trim(upper(location_state)), 2) AS s,
  {_flag_sql(SKILL_TEXT, SKILL_TABLE)}, {_flag_sql('lower(job_title)', rules.TITLE_FLAGS)},
  {_flag_sql('lower(job_title)', rules.ROLE_FLAGS)}, {TIER_SQL} AS company_tier FROM paid),
  g AS (SELECT *, coalesce(given, {YOE_SQL}) AS estimated_yoe, {LOC_SQL}, {' + '.join(SKILL_TABLE)} AS skill_count FROM f)"""
FEATURES = [*SKILL_TABLE, *rules.TITLE_FLAGS, *rules.ROLE_FLAGS, "estimated_yoe", "company_tier", "col_multiplier",
            "is_major_tech_hub", "is_secondary_hub", "is_remote_friendly", "skill_count"]


def feature_rows(spark, sf):
    df = paid(spark, sf).withColumnRenamed("location_state", "worksite_state")
    return fe.engineer_features(df, date_col="received_date")


@check(
    "feature_table",
    FEATURE_SQL + f" SELECT {K}, {', '.join(FEATURES)}, s AS state_clean, CAST(year(received_date) AS INT) AS year, "
    "CAST(quarter(received_date) AS INT) AS quarter FROM g",
)
def _(spark, sf):
    return feature_rows(spark, sf).select(*KEYS, *FEATURES, "state_clean", "year", "quarter")


@check(
    "encoded_features",
    FEATURE_SQL + f" SELECT {K}, {TIER_CODE_SQL} AS company_tier_encoded, {STATE_SQL} AS state_clean_encoded FROM g",
)
def _(spark, sf):
    return fe.encode_features(feature_rows(spark, sf)).select(*KEYS, "company_tier_encoded", "state_clean_encoded")


@check(
    "label_encoded",
    PAID + f""", l AS (SELECT s, row_number() OVER (ORDER BY s) - 1 AS code FROM (SELECT DISTINCT coalesce(seniority_level, 'unknown') AS s FROM paid))
    SELECT {K}, CAST(code AS DOUBLE) AS seniority_level_encoded FROM paid JOIN l ON s = coalesce(seniority_level, 'unknown')""",
)
def _(spark, sf):
    df = postings(spark, sf).select(*KEYS, "seniority_level")
    return fe.encode_labels(df, fe.label_codes(df, "seniority_level"), "seniority_level").select(*KEYS, "seniority_level_encoded")


@check(
    "label_encoded_unseen",
    PAID + f""", fitted AS (SELECT DISTINCT coalesce(seniority_level, 'unknown') AS s FROM paid
      WHERE year < 2022 AND coalesce(seniority_level, '') <> 'Entry level'),
    l AS (SELECT s, row_number() OVER (ORDER BY s) - 1 AS code FROM fitted),
    given AS (SELECT *, CASE WHEN k2 = 7 THEN 'Fellow' ELSE seniority_level END AS given_level FROM paid)
    SELECT {K}, CAST(coalesce(l.code, u.code, -1) AS DOUBLE) AS seniority_level_encoded
    FROM given LEFT JOIN l ON l.s = coalesce(given_level, 'unknown') LEFT JOIN l u ON u.s = 'unknown'""",
)
def _(spark, sf):
    df = postings(spark, sf)
    known = (F.col("year") < 2022) & (F.coalesce("seniority_level", F.lit("")) != "Entry level")
    codes = fe.label_codes(df.where(known), "seniority_level")
    given = df.withColumn("seniority_level", F.when(F.col("k2") == 7, "Fellow").otherwise(F.col("seniority_level")))
    return fe.encode_labels(given.select(*KEYS, "seniority_level"), codes, "seniority_level").select(*KEYS, "seniority_level_encoded")


@check(
    "latest_by_time_offset",
    PAID + """, c AS (SELECT job_url, k1, k2, k1 % 24 AS h, k2 % 2 AS odd FROM paid),
    r AS (SELECT job_url, k1, k2, row_number() OVER (PARTITION BY job_url ORDER BY h + CASE WHEN odd = 1 THEN 5 ELSE 0 END DESC, k1, k2) AS rn FROM c)
    SELECT job_url, k1, k2 FROM r WHERE rn = 1""",
)
def _(spark, sf):
    # half of the times are local, five hours behind the others: text order and time order differ
    hour = F.lpad((F.col("k1") % 24).cast("string"), 2, "0")
    zone = F.when(F.col("k2") % 2 == 1, "-05:00").otherwise("Z")
    df = postings(spark, sf).select(
        "job_url", "k1", "k2", F.lit("x").alias("salary"), F.concat(F.lit("2025-01-01T"), hour, F.lit(":00:00"), zone).alias("collected_at")
    )
    return r.dedup_best_record(df, [F.col("k1"), F.col("k2")]).select("job_url", "k1", "k2")


@check(
    "any_white_space_stripped",
    PAID + f"SELECT {K}, location_state AS given, upper(left(trim(location_state), 1)) AS first FROM paid WHERE location_state IS NOT NULL",
)
def _(spark, sf):
    df = postings(spark, sf).where(F.col("location_state").isNotNull())
    padded = F.concat(F.lit("\t\u00a0"), F.trim("location_state"), F.lit(" \r\n"))
    return df.select(*KEYS, F.col("location_state").alias("given"), F.substring(text.clean_state(padded), 1, 1).alias("first"))


@check(
    "user_skills",
    PAID + f", f AS (SELECT {K}, skills, {_flag_sql('lower(job_title)', SKILL_TABLE)} FROM paid) SELECT {K}, "
    + ", ".join(
        f"CAST(CASE WHEN coalesce(len(list_filter(skills, lambda s: contains(s, '{c.replace('_', ' ')}') OR contains('{c.replace('_', ' ')}', s))) > 0, false) THEN 1 ELSE skill_{c} END AS INT) AS skill_{c}"
        for c in rules.SKILL_CATEGORIES
    ) + " FROM f",
)
def _(spark, sf):
    flags = fe.skill_flags(F.col("job_title"))
    df = paid(spark, sf).select(*KEYS, "skills", *[v.alias(k) for k, v in flags.items()])
    return fe.apply_user_skills(df, "skills").select(*KEYS, *flags)
