"""Literal cases of the column functions."""


import pytest
from pyspark.sql import functions as F

from payspark.functions import pay, resume, text
from payspark.operators import features as fe


def apply(spark, expr, rows, kinds):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + kinds)
    return [r[0] for r in df.orderBy("i").select(expr.alias("x")).collect()]


def test_salary_text(spark):
    cases = {
        "$150,000 - $200,000": 175000, "$150K - $200K": 175000, "$150,000/yr": 150000, "$50/hr": 104000,
        "Not specified": None, "": None, None: None, "45": 93600, "10": 10, "$120.5K": 120500, "20 per hour": 41600,
        "negotiable": None, "None": None,
    }
    got = apply(spark, pay.parse_salary_text(F.col("t")), [(k,) for k in cases], "t string")
    assert got == list(cases.values())


def test_experience_years(spark):
    cases = {"5+ years": 5, "3-5 years": 4, "3-6 years": 4, "7 yrs": 7, "Not specified": None, "": None, None: None, "n/a": None}
    assert apply(spark, pay.parse_experience_years(F.col("t")), [(k,) for k in cases], "t string") == list(cases.values())


def test_annualize(spark):
    rows = [("10", "Hour"), ("10", "Week"), ("10", "Bi-Weekly"), ("10", "Month"), ("10", "Year"), ("x", "Hour"), ("10", None)]
    assert apply(spark, pay.annualize_wage(F.col("w"), F.col("u")), rows, "w string, u string") == [
        20800, 520, 260, 120, 10, None, 10,
    ]
    assert apply(spark, pay.annualize_wage(F.col("w"), F.col("u"), week_first=True), rows, "w string, u string")[2] == 520


@pytest.mark.parametrize(
    "fn, cases",
    [
        (text.state_from_city, {"San Francisco, CA": "CA", "Remote": None, "Paris, France": None, "x, ny ": "NY", None: None}),
        (text.state_from_area, {"US, California": "CA", "Chicago, Cook County": "Other", None: "Unknown", "Austin, tx": "TX"}),
        (
            text.seniority_label,
            {
                "Lead Data Scientist": "Senior", "Junior Data Scientist": "Junior", "Head of AI": "Executive",
                "AI Manager": "Manager", "ML Engineer": "Mid-level", None: "Unknown",
            },
        ),
        (text.education_level, {"PhD or Master": "PhD", "Master's": "Masters", "B.S. required": "Bachelors", "none": "Not specified", None: "Not specified"}),
        (text.applicant_count, {"Over 200 applicants": 200, "57 applicants": 57, "": 0, "100-200 people": 200, None: 0}),
        (text.experience_phrase, {"3 to 5 years": "3-5 years", "4+ yrs": "4+ years", "at least 2 years": "2+ years", "minimum of 6 years": "6+ years", "": "Not specified", None: "Not specified"}),
        (text.clean_state, {" california ": "CA", "tx": "TX", "Ohio": "OHIO", None: None}),
        (
            fe.company_tier,
            {"Google": "faang", "OpenAI": "tier1", "Lyft Inc": "tier2", "Goldman Sachs": "finance", "Small Company": "other", None: "unknown"},
        ),
        (fe.encode_tier, {"faang": 0, "other": 5, "unknown": 6, "startup": 4, None: 6}),
        (fe.encode_state, {"CA": 0, "UT": 19, "ZZ": 20, None: 20}),
    ],
)
def test_text_cases(spark, fn, cases):
    assert apply(spark, fn(F.col("t")), [(k,) for k in cases], "t string") == list(cases.values())


def test_area_substring(spark):
    rows = [("Chicago",), ("Newark",)]
    assert apply(spark, text.state_from_area(F.col("t"), substring=True), rows, "t string") == ["CA", "WA"]


def test_description_skills(spark):
    rows = [("Python, C++ and R; CI/CD on AWS. JavaScript too",), ("",), (None,)]
    got = apply(spark, text.description_skills(F.col("t")), rows, "t string")
    assert got == [["python", "javascript", "c++", "r", "aws", "ci/cd"], [], []]


def test_title_flags(spark):
    titles = ["Senior Machine Learning Engineer", "Principal AI Researcher", "Junior ML Engineer", None]
    flags = fe.title_flags(F.col("t")) | fe.role_flags(F.col("t"))
    expr = F.struct(*[v.alias(k) for k, v in flags.items()], fe.title_years(flags).alias("yoe"))
    a, b, c, d = apply(spark, expr, [(t,) for t in titles], "t string")
    assert (a.is_senior, a.yoe) == (1, 5)
    assert (b.is_principal, b.yoe, b.role_researcher) == (1, 10, 1)
    assert (c.is_entry, c.yoe) == (1, 1)
    assert sum(d) == 3 and d.yoe == 3


def test_location_features(spark):
    expr = F.struct(*[v.alias(k) for k, v in fe.location_features(F.col("t")).items()])
    got = apply(spark, expr, [("CA",), ("TX",), ("ZZ",), (None,)], "t string")
    assert [tuple(r) for r in got] == [(1.35, 1, 0, 0), (1.0, 0, 1, 1), (1.0, 0, 0, 0), (1.0, 0, 0, 0)]


def test_quality_score(spark):
    names = ["estimated_yoe", "education", "seniority_level", "employer_name", "location_state"]
    expr = pay.quality_score(F.col("skills"), F.col("p"), {n: F.col(n) for n in names})
    rows = [
        (["a"], 1, "1", "e", "s", "x", "CA"), ([], 1, None, None, None, "x", "CA"), (None, 2, None, None, None, "x", "CA"),
        (None, 999, None, None, None, None, None),
    ]
    got = apply(spark, expr, rows, "skills array<string>, p int, " + ", ".join(f"{n} string" for n in names))
    assert got == pytest.approx([1.0, 0.3, 0.25, 0.0])


def test_similarity(spark):
    rows = [("Data Scientist", "data scientists"), ("abc", None), ("", ""), ("ML Engineer", "Engineer, ML")]
    lev = apply(spark, text.similarity_levenshtein(F.col("a"), F.col("b")), rows, "a string, b string")
    assert lev[:3] == pytest.approx([1 - 1 / 15, 0.0, 1.0])


RESUMES = [
    "Senior Data Scientist at X\nBoston, MA\n7+ years of experience with Python, SQL and PyTorch",
    "Jane\nEXPERIENCE\nML Engineer - Acme\n3-6 years",
    "skills: mlops kubernetes aws gcp. principal reviewer",
    "",
    None,
    "Ingénieur à Paris, coöp",
    "x " * 500 + " data engineer",
]


def test_parse_documents(spark):
    df = spark.createDataFrame(list(enumerate(RESUMES)), "doc_id int, text string")
    rows = {r.doc_id: r for r in resume.parse_documents(df).collect()}
    assert (rows[0].job_title, rows[0].confidence.job_title) == ("Senior Data Scientist", 17.0)
    assert (rows[0].location, rows[0].experience_years, rows[0].skills) == ("MA", 7, ["PyTorch", "Python", "SQL"])
    assert (rows[1].job_title, rows[1].experience_years) == ("ML Engineer", 4)  # 4.5 rounds half to even
    assert (rows[2].job_title, rows[2].experience_years) == ("MLOps Engineer", 8)
    assert rows[2].confidence.job_title == pytest.approx(0.55)
    assert not rows[3].success and not rows[4].success and rows[3].experience_years == 3
    assert rows[5].location is None and rows[5].job_title is None
    assert rows[6].confidence.job_title == 4 + 1


def test_section_title_never_decides(spark):
    """A section title exists only where the whole text has a scored title, so leaving it out changes nothing."""
    lines = ["Experience", "Data Engineer at Acme", "staff ml  engineer", "foo - bar", "Head of AI | X", "work history", "é ai engineer"]
    texts = ["\n".join(lines[i:] + lines[:j]) for i in range(7) for j in range(7)] + RESUMES
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    low = F.lower(resume.clean_text(F.col("text")))
    out = df.select(
        resume.section_title(resume.text_lines(F.col("text")))["title"].alias("s"), resume.best_title(low).alias("b")
    )
    assert out.where("s IS NOT NULL AND b IS NULL").count() == 0
    assert out.where("s IS NOT NULL").count() > 20


def test_section_title(spark):
    rows = [
        ("Experience\nAcme Corp\nData Engineer\n",), ("Data Scientist\nfoo",), ("Experience\n" + "a\n" * 6 + "AI Engineer",),
        ("Experience\n" + "x" * 130 + " ai engineer\n",), ("nothing",), ("Employment\nML Engineer at Acme",),
    ]
    got = apply(spark, resume.section_title(resume.text_lines(F.col("t"))), rows, "t string")
    assert [(r.title, r.confidence) for r in got] == [
        ("Data Engineer", 0.7), ("Data Scientist", 0.5), ("AI Engineer", 0.5), (None, 0.0), (None, 0.0), ("ML Engineer", 0.7),
    ]


def test_skills_title(spark):
    rows = [(["AWS", "GCP", "Kubernetes", "MLOps"],), (["SQL", "Spark"],), ([],), (["Machine Learning", "Python", "NLP", "LLMs"],)]
    got = apply(spark, resume.skills_title(F.col("s")), rows, "s array<string>")
    assert [(r.title, round(r.confidence, 4)) for r in got] == [
        ("MLOps Engineer", 0.55), ("Data Engineer", 0.4), (None, 0.0), ("Data Scientist", 0.5),
    ]


def test_gates_hold_every_word_of_their_patterns():
    import itertools
    import re

    from payspark import rules
    from payspark.functions.resume import listed_words
    from payspark.functions.words import trie, whole_word

    for pattern, _ in rules.TITLE_PATTERNS:  # every way through the groups holds a noun
        parts = [g.strip("()").split("|") for g in re.split(r"(\([^)]*\))", pattern)]
        assert all(any(n in "".join(way) for n in rules.TITLE_NOUNS) for way in itertools.product(*parts)), pattern
    for patterns in (rules.SKILL_PATTERNS.values(), rules.STATE_PATTERNS.values()):
        words = listed_words(patterns)
        found = re.compile(whole_word(words))
        for w in words:
            assert re.fullmatch(trie(words), w)
            for text in (w, f"in {w}.", f"x{w}", f"{w}x", f"{w[:-1]} {w}"):
                assert bool(found.search(text)) == any(re.search(p, text) for p in patterns), text
    assert re.fullmatch(trie(["a+b", "a", "ab"]), "a+b") and not re.fullmatch(trie(["a+b", "ab"]), "a")


def test_one_scan_finds_every_listed_word(spark):
    from payspark.functions.words import whole_words

    words = ["new york", "new", "york city", "sql", "my sql", "r", "ci/cd", "ci"]
    texts = ["new york city", "my sql, mysql r", "newt ci/cd", "", None, "xnew york_city ci-r newé"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.w if r.w is None else sorted(r.w) for r in rows.select(whole_words(F.col("t"), words).alias("w")).collect()]
    want = rows.select(*[F.col("t").rlike(rf"\b{w}\b").alias(w) for w in words]).collect()
    assert [None if g is None else sorted(set(g)) for g in got] == [
        None if t is None else sorted(w for w in words if r[w]) for t, r in zip(texts, want)
    ]


def test_title_of_short_and_long_texts(spark):
    """The first title of a short text is the best of all scores; patterns are looked for in a text that holds their words."""
    import re

    from payspark import rules

    tails = ["ai engineer", "sr. data  scientist", "senior ml engineer", "vp of ai", "ai manager", "lead data scientists", "data\nengineer at head of ml"]
    texts = [f"{'x ' * k}{a} and {'y ' * k}{b}" for k in (0, 300, 390, 500, 1200) for a in tails for b in tails]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", resume.best_title(F.col("t")).alias("b"), F.array_max(resume.title_scores(F.col("t"))).alias("m")).collect()
    n = len(rules.TITLE_PATTERNS)
    for r in got:
        best = None
        for i, (p, title) in enumerate(rules.TITLE_PATTERNS):
            if m := re.search(p, r.t):
                score = float(n - i + (3 if m.start() <= rules.SUMMARY_WINDOW else 1 if m.start() <= rules.MID_WINDOW else 0))
                best = max(best or (score, -i, title), (score, -i, title))
        assert (None if r.b is None else tuple(r.b)) == best and r.b == r.m
