"""Checks of the text, pay and resume expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules
from ..functions import pay, resume, text
from ..operators.scoring import display_name
from .bridge import (
    CLEAN_STATE_SQL, PAID, YEARS_SQL, any_of, check, ladder, paid, postings, table,
)

KEYS = ["k1", "k2", "k3", "k4", "collected_at"]
K = ", ".join(KEYS)
SALARY_SQL = r"""CASE WHEN t IS NULL OR t IN ('', 'not specified', 'none') OR len(v) = 0 THEN NULL
  WHEN contains(t, '/hr') OR contains(t, 'per hour') OR contains(t, 'hourly')
    OR (list_avg(v) < 300 AND list_avg(v) * 2080 BETWEEN 30000 AND 700000) THEN list_avg(v) * 2080
  ELSE list_avg(v) END"""
NUMBERS_SQL = r"""list_transform(list_zip(
    regexp_extract_all(b, '(\d+(?:\.\d+)?)(k?)', 1), regexp_extract_all(b, '(\d+(?:\.\d+)?)(k?)', 2)),
    lambda x: CAST(x[1] AS DOUBLE) * CASE WHEN x[2] = 'k' THEN 1000 ELSE 1 END)"""


@check("annualized_wage", f"{PAID} SELECT {K}, wage_unit, round(annual_salary, 4) AS annual_salary FROM paid")
def _(spark, sf):
    return paid(spark, sf).select(*KEYS, "wage_unit", F.round("annual_salary", 4).alias("annual_salary"))


@check(
    "salary_text_parsed",
    PAID + r""", a AS (SELECT *, lower(salary_text) AS t,
      regexp_replace(lower(salary_text), '\$|,|/yr|/hr|per hour|hourly', '', 'g') AS b FROM paid),
    c AS (SELECT *, """ + NUMBERS_SQL + " AS v FROM a) SELECT " + K + ", round(" + SALARY_SQL + ", 2) AS salary FROM c",
)
def _(spark, sf):
    return postings(spark, sf).select(*KEYS, F.round(pay.parse_salary_text(F.col("salary_text")), 2).alias("salary"))


@check("experience_parsed", f"{PAID} SELECT {K}, {YEARS_SQL} AS years FROM paid")
def _(spark, sf):
    return postings(spark, sf).select(*KEYS, pay.parse_experience_years(F.col("experience_text")).alias("years"))


CITY = "CASE WHEN k2 % 3 = 0 THEN 'Remote' ELSE 'Metro ' || CAST(k3 AS STRING) || ', ' || coalesce(location_state, 'Paris, France') END"


@check(
    "state_from_city",
    f"""{PAID}, a AS (SELECT {K}, {CITY} AS location FROM paid)
    SELECT {K}, CASE WHEN len(string_split(location, ',')) >= 2 AND length(trim(string_split(location, ',')[-1])) = 2
      THEN upper(trim(string_split(location, ',')[-1])) END AS state FROM a""",
)
def _(spark, sf):
    return postings(spark, sf).select(*KEYS, text.state_from_city(F.expr(CITY)).alias("state"))


AREA = ("CASE k2 % 5 WHEN 0 THEN 'US, Illinois, Chicago' WHEN 1 THEN 'US, New Jersey, Newark' "
        "WHEN 2 THEN 'US, ' || trim(location_state) WHEN 3 THEN 'Nowhere' END")


def _area_sql(test):
    whens = " ".join(f"WHEN {test(n)} THEN '{c}'" for n, c in rules.AREA_STATES)
    return f"CASE WHEN area IS NULL THEN 'Unknown' {whens} ELSE 'Other' END"


@check(
    "state_from_area",
    f"{PAID}, a AS (SELECT {K}, {AREA} AS area FROM paid) SELECT {K}, "
    + _area_sql(lambda n: f"regexp_matches(lower(area), '\\b{n}\\b')") + " AS state, "
    + _area_sql(lambda n: f"contains(lower(area), '{n}')") + " AS state_substring FROM a",
)
def _(spark, sf):
    area = F.expr(AREA)
    return postings(spark, sf).select(
        *KEYS, text.state_from_area(area).alias("state"), text.state_from_area(area, True).alias("state_substring")
    )


@check("seniority_label", f"{PAID} SELECT {K}, {ladder('job_title', rules.SENIORITY_LABELS, 'Mid-level', 'Unknown')} AS seniority FROM paid")
def _(spark, sf):
    return postings(spark, sf).select(*KEYS, text.seniority_label(F.col("job_title")).alias("seniority"))


PLACE = "CASE WHEN k2 % 3 = 0 THEN 'Remote, US' ELSE location_state END"


@check("remote_flag", f"{PAID} SELECT {K}, coalesce(contains(lower({PLACE}), 'remote'), false) AS is_remote FROM paid")
def _(spark, sf):
    return postings(spark, sf).select(*KEYS, text.is_remote(F.col("job_title"), F.expr(PLACE)).alias("is_remote"))


LOW = "CASE WHEN k2 % 3 > 0 THEN wage_from END"
HIGH = "CASE WHEN k2 % 2 = 0 THEN wage_from * 2 END"


@check(
    "salary_mid",
    f"{PAID} SELECT {K}, coalesce(({LOW} + {HIGH}) / 2, {LOW}, {HIGH}) AS salary_avg FROM paid",
)
def _(spark, sf):
    return postings(spark, sf).select(
        *KEYS, pay.salary_mid(F.expr(LOW), F.expr(HIGH)).alias("salary_avg")
    )


@check(
    "created_dates",
    f"{PAID} SELECT {K}, CAST(CASE WHEN k2 % 4 > 0 THEN year(received_date) END AS INT) AS year, "
    "CAST(CASE WHEN k2 % 4 > 0 THEN month(received_date) END AS INT) AS month FROM paid",
)
def _(spark, sf):
    created = F.when(F.col("k2") % 4 > 0, F.col("received_date").cast("string")).otherwise("soon")
    when = pay.parse_date(created)
    return postings(spark, sf).select(*KEYS, F.year(when).alias("year"), F.month(when).alias("month"))


@check("clean_state", f"{PAID} SELECT {K}, {CLEAN_STATE_SQL.format(c='location_state')} AS state FROM paid")
def _(spark, sf):
    return postings(spark, sf).select(*KEYS, text.clean_state(F.col("location_state")).alias("state"))


YEAR_TEXT = "CASE k2 % 3 WHEN 0 THEN CAST(year AS STRING) WHEN 1 THEN 'n/a' END"


@check("fill_year", f"{PAID} SELECT {K}, CASE WHEN k2 % 3 = 0 THEN year ELSE 2024 END AS year FROM paid")
def _(spark, sf):
    return postings(spark, sf).select(*KEYS, pay.fill_year(F.expr(YEAR_TEXT)).alias("year"))


@check(
    "string_similarity",
    f"""{PAID} SELECT {K}, round(CASE WHEN employer_name IS NULL THEN 0 ELSE 1 - levenshtein(lower(employer_name),
      lower(job_title)) / CAST(greatest(length(employer_name), length(job_title)) AS DOUBLE) END, 6) AS similarity FROM paid""",
)
def _(spark, sf):
    score = text.similarity_levenshtein(F.col("employer_name"), F.col("job_title"))
    return postings(spark, sf).select(*KEYS, F.round(score, 6).alias("similarity"))


DESCRIPTION = (
    "'We want ' || experience_text || ' and a ' || coalesce(education, 'B.S. degree') || '. Tools: ' || "
    "coalesce(skills_csv, 'C++ and R') || '. At least ' || CAST(k2 AS STRING) || ' years of Java, Go.'"
)


def _skill_sql():
    out = []
    for s in rules.DESCRIPTION_SKILLS:
        p = s.replace("+", r"\+") + ("" if s.endswith("+") else r"\b")
        out.append(f"CASE WHEN regexp_matches(d, '\\b{p}') THEN '{s}' END")
    return "list_filter([" + ", ".join(out) + "], lambda s: s IS NOT NULL)"


@check(
    "skills_from_text",
    f"{PAID}, a AS (SELECT {K}, lower({DESCRIPTION}) AS d FROM paid) SELECT {K}, array_to_string({_skill_sql()}, ',') AS skills FROM a",
)
def _(spark, sf):
    df = postings(spark, sf).select(*KEYS, F.lower(F.expr(DESCRIPTION)).alias("d"))
    return df.select(*KEYS, F.array_join(text.description_skills(F.col("d")), ",").alias("skills"))


@check(
    "experience_phrase",
    PAID + f", a AS (SELECT {K}, {DESCRIPTION} AS d FROM paid) SELECT {K}, " + r"""CASE
    WHEN regexp_matches(d, '(?i)\d+\+?\s*(to|-)\s*\d+\s*(years?|yrs?)') THEN
      regexp_extract(d, '(?i)(\d+)\+?\s*(?:to|-)\s*(\d+)\s*(?:years?|yrs?)', 1) || '-' ||
      regexp_extract(d, '(?i)(\d+)\+?\s*(?:to|-)\s*(\d+)\s*(?:years?|yrs?)', 2) || ' years'
    WHEN regexp_matches(d, '(?i)\d+\+\s*(years?|yrs?)') THEN regexp_extract(d, '(?i)(\d+)\+\s*(?:years?|yrs?)', 1) || '+ years'
    WHEN regexp_matches(d, '(?i)at least\s+\d+\s*(years?|yrs?)') THEN
      regexp_extract(d, '(?i)at least\s+(\d+)\s*(?:years?|yrs?)', 1) || '+ years' ELSE 'Not specified' END AS experience FROM a""",
)
def _(spark, sf):
    return postings(spark, sf).select(*KEYS, text.experience_phrase(F.expr(DESCRIPTION)).alias("experience"))


@check(
    "education_level",
    f"{PAID}, a AS (SELECT {K}, {DESCRIPTION} AS d FROM paid) SELECT {K}, "
    f"{ladder('d', rules.EDUCATION_LEVELS, 'Not specified', 'Not specified')} AS education FROM a",
)
def _(spark, sf):
    return postings(spark, sf).select(*KEYS, text.education_level(F.expr(DESCRIPTION)).alias("education"))


APPLICANTS = ("CASE k2 % 4 WHEN 0 THEN 'Over ' || CAST(k3 AS STRING) || ' applicants' WHEN 1 THEN CAST(k4 AS STRING) || ' applicants' "
              "WHEN 2 THEN CAST(k4 AS STRING) || ' - ' || CAST(k3 AS STRING) ELSE '' END")


@check(
    "applicant_count",
    f"{PAID} SELECT {K}, CAST(CASE k2 % 4 WHEN 0 THEN k3 WHEN 1 THEN k4 WHEN 2 THEN k3 ELSE 0 END AS INT) AS applicants FROM paid",
)
def _(spark, sf):
    return postings(spark, sf).select(*KEYS, text.applicant_count(F.expr(APPLICANTS)).alias("applicants"))


# --- documents and resumes ------------------------------------------------------------------------------------

RESUME = ("'Experienced ' || job_title || ' in ' || coalesce(location_state, 'remote') || '.\n\n' || experience_text || "
          "' of experience.  Skills: ' || coalesce(skills_csv, '') || '\n  Employment\n' || "
          "CASE WHEN k2 % 2 = 0 THEN 'AI Engineer at ' ELSE 'Worker at ' END || coalesce(employer_name, 'home') || '\n'")


def resumes(spark, sf):
    return postings(spark, sf).select(*KEYS, F.expr(RESUME).alias("text"))


def _sql_pattern(p: str) -> str:
    return p.replace("'", "''")


RESUME_SQL = PAID + f", a AS (SELECT {K}, {RESUME} AS text FROM paid), b AS (SELECT *, " + (
    r"trim(regexp_replace(text, '\s+', ' ', 'g')) AS clean, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS low FROM a)"
)


def _offset(p):
    """0-based offset of a pattern in low, -1 when absent."""
    whole = f"regexp_extract(low, '{_sql_pattern(p)}')"
    # RE2 has no position function: split at the first hit instead
    return f"(CASE WHEN regexp_matches(low, '{_sql_pattern(p)}') THEN length(regexp_split_to_array(low, '{_sql_pattern(p)}')[1]) ELSE -1 END)", whole


def _title_score_sql():
    n = len(rules.TITLE_PATTERNS)
    rows = []
    for i, (p, t) in enumerate(rules.TITLE_PATTERNS):
        at, _ = _offset(p)
        rows.append(
            f"CASE WHEN {at} >= 0 THEN {{'s': {n - i} + CASE WHEN {at} <= 800 THEN 3 WHEN {at} <= 2000 THEN 1 ELSE 0 END, 'o': {-i}, 't': '{t}'}} END"
        )
    return f"list_aggregate(list_filter([{', '.join(rows)}], lambda r: r IS NOT NULL), 'max')"


def _state_sql(prefix="", suffix=""):
    def pat(p):
        return p if not prefix else prefix + p[2:-2] + suffix

    whens = " ".join(f"WHEN regexp_matches(low, '{pat(p)}') THEN '{s}'" for s, p in rules.STATE_PATTERNS.items())
    return f"CASE {whens} END"


def _years_sql(title):
    def num(p, g=1):
        return f"CAST(regexp_extract(low, '{p}', {g}) AS BIGINT)"

    span = rules.RANGE_YEARS_PATTERN
    whens = [f"WHEN regexp_matches(low, '{span}') THEN least(round_even(({num(span)} + {num(span, 2)}) / 2, 0), 30)"]
    whens += [f"WHEN regexp_matches(low, '{p}') THEN least({num(p)}, 30)" for p in rules.YEARS_PATTERNS]
    for words, years in rules.TITLE_YEARS_HINTS:
        whens.append(f"WHEN {any_of(f'lower({title})', words)} THEN {years}")
    whens.append(f"WHEN {any_of('low', rules.TEXT_YEARS_WORDS)} THEN {rules.TEXT_YEARS}")
    return f"CAST(CASE {' '.join(whens)} ELSE 3 END AS INT)"


def _resume_skills_sql():
    names = sorted(rules.SKILL_PATTERNS)
    cases = [f"CASE WHEN regexp_matches(low, '{rules.SKILL_PATTERNS[n]}') THEN '{n}' END" for n in names]
    return "list_filter([" + ", ".join(cases) + "], lambda s: s IS NOT NULL)"


def _hint_sql():
    rows = []
    for i, (t, need, plus) in enumerate(rules.SKILL_TITLE_HINTS):
        ok = " AND ".join(f"list_contains(skills, '{s}')" for s in need)
        score = "0.4" + "".join(f" + CASE WHEN list_contains(skills, '{s}') THEN 0.05 ELSE 0 END" for s in plus)
        rows.append(f"CASE WHEN {ok} THEN {{'s': {score}, 'o': {-i}, 't': '{t}'}} END")
    return f"list_aggregate(list_filter([{', '.join(rows)}], lambda r: r IS NOT NULL), 'max')"


@check(
    "normalized_text",
    r"""SELECT doc_id, length(c) AS clean_chars, left(lower(c), 800) AS summary,
      len(list_filter(list_transform(regexp_split_to_array(text, '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]'),
        lambda x: regexp_replace(x, '^[\s\x1c-\x1f\x{85}\p{Z}]+|[\s\x1c-\x1f\x{85}\p{Z}]+$', '', 'g')), lambda x: x <> '')) AS lines
      FROM (SELECT *, trim(regexp_replace(text, '[\s\x1c-\x1f\x{85}\p{Z}]+', ' ', 'g')) AS c FROM documents)""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents")
    clean = resume.clean_text(F.col("text"))
    return docs.select("doc_id", clean.alias("c"), F.size(resume.text_lines(F.col("text"))).alias("lines")).select(
        "doc_id", F.length("c").alias("clean_chars"), resume.summary_text(F.lower("c")).alias("summary"), "lines"
    )


@check(
    "title_scores",
    RESUME_SQL + f", s AS (SELECT {K}, {_title_score_sql()} AS m FROM b) SELECT {K}, m.t AS title, CAST(coalesce(m.s, 0) AS DOUBLE) AS score FROM s",
)
def _(spark, sf):
    low = F.lower(resume.clean_text(F.col("text")))
    best = F.col("best")
    return resumes(spark, sf).select(*KEYS, low.alias("low")).select(
        *KEYS, resume.best_title(F.col("low")).alias("best")
    ).select(*KEYS, best["title"].alias("title"), F.coalesce(best["score"], F.lit(0.0)).alias("score"))


@check("resume_skills", RESUME_SQL + f" SELECT {K}, array_to_string({_resume_skills_sql()}, ',') AS skills FROM b")
def _(spark, sf):
    low = F.lower(resume.clean_text(F.col("text")))
    df = resumes(spark, sf).select(*KEYS, low.alias("low"))
    return df.select(*KEYS, F.array_join(resume.resume_skills(F.col("low")), ",").alias("skills"))


@check(
    "document_locations",
    r"""SELECT doc_id, """ + _state_sql(r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])") + r""" AS state
      FROM (SELECT doc_id, lower(trim(regexp_replace(text, '[\s\x1c-\x1f\x{85}\p{Z}]+', ' ', 'g'))) AS low FROM documents)""",
)
def _(spark, sf):
    low = F.lower(resume.clean_text(F.col("text")))
    docs = table(spark, sf, "documents").select("doc_id", low.alias("low"))
    return docs.select("doc_id", resume.resume_location(F.col("low"))["state"].alias("state"))


@check(
    "resume_years",
    RESUME_SQL + f", s AS (SELECT *, ({_title_score_sql()}).t AS title FROM b) SELECT {K}, {_years_sql('title')} AS years FROM s",
)
def _(spark, sf):
    low = F.lower(resume.clean_text(F.col("text")))
    df = resumes(spark, sf).select(*KEYS, low.alias("low")).select(
        *KEYS, "low", resume.best_title(F.col("low"))["title"].alias("title")
    )
    return df.select(*KEYS, resume.resume_years(F.col("low"), F.col("title"))["years"].alias("years"))


def _first_title_sql(expr):
    whens = " ".join(f"WHEN regexp_matches(lower({expr}), '{p}') THEN '{t}'" for p, t in rules.TITLE_PATTERNS)
    return f"CASE {whens} END"


@check(
    "section_titles",
    # the employment line is followed by one line; the experience line above it is followed by both
    PAID + f", a AS (SELECT *, CASE WHEN k2 % 2 = 0 THEN 'AI Engineer at x' ELSE 'Worker at x' END AS l4 FROM paid) SELECT {K}, "
    f"coalesce({_first_title_sql('l4')}, {_first_title_sql('job_title')}) AS title, "
    f"CAST(CASE WHEN k2 % 2 = 0 OR ({_first_title_sql('job_title')}) IS NOT NULL THEN "
    f"CASE WHEN k2 % 2 = 0 THEN 0.7 ELSE 0.5 END ELSE 0 END AS DOUBLE) AS confidence FROM a",
)
def _(spark, sf):
    # the greeting line must not count as an experience heading here
    quiet = F.regexp_replace("text", "^Experienced ", "")
    hit = resume.section_title(resume.text_lines(quiet))
    return resumes(spark, sf).select(*KEYS, hit.alias("h")).select(
        *KEYS, F.col("h.title").alias("title"), F.col("h.confidence").alias("confidence")
    )


@check(
    "skill_titles",
    RESUME_SQL + f", s AS (SELECT *, {_resume_skills_sql()} AS skills FROM b), h AS (SELECT {K}, {_hint_sql()} AS m FROM s) "
    f"SELECT {K}, m.t AS title, CAST(round(coalesce(m.s, 0), 4) AS DOUBLE) AS confidence FROM h",
)
def _(spark, sf):
    low = F.lower(resume.clean_text(F.col("text")))
    df = resumes(spark, sf).select(*KEYS, low.alias("low"))
    df = df.select(*KEYS, resume.resume_skills(F.col("low")).alias("skills"))
    return df.select(*KEYS, resume.skills_title(F.col("skills")).alias("h")).select(
        *KEYS, F.col("h.title").alias("title"), F.round("h.confidence", 4).alias("confidence")
    )


@check(
    "resume_fields",
    RESUME_SQL + f""", s AS (SELECT *, {_title_score_sql()} AS m, {_resume_skills_sql()} AS skills FROM b),
    h AS (SELECT *, {_hint_sql()} AS hint FROM s),
    t AS (SELECT *, coalesce(m.t, CASE WHEN contains(low, ' at ') AND contains(low, 'ai engineer') THEN 'AI Engineer' END, hint.t) AS title FROM h)
    SELECT {K}, title AS job_title, {_state_sql()} AS location, {_years_sql('title')} AS experience_years,
      array_to_string(skills, ',') AS skills, CAST(coalesce(m.s, round(hint.s, 4), 0) AS DOUBLE) AS title_confidence, left(clean, 500) AS preview,
      CASE WHEN title IS NULL THEN 'Resume parsed but no job title detected' ELSE 'Resume parsed successfully' END AS message FROM t""",
)
def _(spark, sf):
    out = resume.parse_documents(resumes(spark, sf))
    return out.select(
        *KEYS, "job_title", "location", "experience_years", F.array_join("skills", ",").alias("skills"),
        F.round("confidence.job_title", 4).alias("title_confidence"),
        F.col("extracted_text_preview").alias("preview"), "message",
    )


# word boundaries that hold for letters of any language, as in document_locations
EDGES = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"


def _located_sql():
    """Confidence of the first state found: 1.5 where it starts within the first 2,000 characters after the start."""
    whens = []
    for p in rules.STATE_PATTERNS.values():
        p = EDGES[0] + p[2:-2] + EDGES[1]
        at = f"length(regexp_split_to_array(low, '{p}')[1]) + length(regexp_extract(low, '{p}', 1))"
        whens.append(f"WHEN regexp_matches(low, '{p}') THEN CASE WHEN {at} <= 2000 THEN 1.5 ELSE 1 END")
    return f"CAST(CASE {' '.join(whens)} ELSE 0 END AS DOUBLE)"


def _years_sure_sql(title):
    written = " OR ".join(f"regexp_matches(low, '{p}')" for p in (rules.RANGE_YEARS_PATTERN, *rules.YEARS_PATTERNS))
    hinted = " OR ".join(any_of(f"lower({title})", words) for words, _ in rules.TITLE_YEARS_HINTS)
    return f"CAST(CASE WHEN {written} THEN 1 WHEN {hinted} THEN 0.5 WHEN {any_of('low', rules.TEXT_YEARS_WORDS)} THEN 0.4 ELSE 0 END AS DOUBLE)"


@check(
    "document_fields",
    r"""WITH b AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[\s\x1c-\x1f\x{85}\p{Z}]+', ' ', 'g')) AS clean, lower(clean) AS low FROM documents),"""
    + f""" s AS (SELECT *, {_title_score_sql()} AS m, {_resume_skills_sql()} AS skills FROM b),
    h AS (SELECT *, {_hint_sql()} AS hint FROM s),
    t AS (SELECT *, CASE WHEN hint.t IS NOT NULL AND (m.t IS NULL OR hint.s > m.s) THEN hint.t ELSE m.t END AS title FROM h)
    SELECT doc_id, title AS job_title, {_state_sql(*EDGES)} AS location, {_years_sql('title')} AS experience_years, array_to_string(skills, ',') AS skills,
      CAST(greatest(coalesce(m.s, 0), coalesce(round(hint.s, 4), 0)) AS DOUBLE) AS title_confidence, {_located_sql()} AS location_confidence,
      {_years_sure_sql('title')} AS experience_confidence, CAST(CASE WHEN len(skills) > 0 THEN 1 ELSE 0 END AS DOUBLE) AS skills_confidence,
      CASE WHEN clean <> '' THEN left(clean, 500) END AS preview, clean <> '' AS success,
      CASE WHEN clean = '' THEN 'Could not extract text from file. Please try a different format.'
        WHEN title IS NULL THEN 'Resume parsed but no job title detected' ELSE 'Resume parsed successfully' END AS message FROM t""",
)
def _(spark, sf):
    out = resume.parse_documents(table(spark, sf, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "job_title", "location", "experience_years", F.array_join("skills", ",").alias("skills"),
        F.round("confidence.job_title", 4).alias("title_confidence"), F.col("confidence.location").alias("location_confidence"),
        F.col("confidence.experience").alias("experience_confidence"), F.col("confidence.skills").alias("skills_confidence"),
        F.col("extracted_text_preview").alias("preview"), "success", "message",
    )


@check(
    "feature_names",
    PAID + """, n AS (SELECT DISTINCT unnest(skills) AS s FROM paid)
    SELECT 'skill_' || s AS feature, 'Skill: ' || upper(left(s, 1)) || substring(s, 2) AS display_name FROM n""",
)
def _(spark, sf):
    names = paid(spark, sf).select(F.explode("skills").alias("s")).distinct()
    name = F.concat(F.lit("skill_"), F.col("s"))
    return names.select(name.alias("feature"), display_name(name).alias("display_name"))
