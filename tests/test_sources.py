"""Readers, payloads, markup, sinks, streams and composed jobs on small written files."""

import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from payspark import rules
from payspark.operators import model as m
from payspark.operators import records as r
from payspark.plans import collect, explore, merge, training
from payspark.sources import feeds, files, html, sinks
from payspark.streaming import postings as stream


def record(url, **kw):
    base = {"collected_at": "2025-11-25T01:00:00Z", "position": "ML Engineer", "company": "Acme", "location": "X, CA",
            "job_url": url, "salary": "$150K - $200K", "experience_years": "3-5 years", "skills": ["python"], "description": " d "}
    return json.dumps(base | kw)


def put(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture
def lake(tmp_path):
    put(f"{tmp_path}/processed/consolidated-20250101.jsonl", [record("u1", company="Old"), "", "{broken", record("u2")])
    put(f"{tmp_path}/processed/consolidated-20250201.jsonl", [record("u1", company="New"), record("u3"), record("u3", company="Second")])
    put(f"{tmp_path}/raw/batch-1.jsonl", [record("u4"), record("u2", company="Raw"), record(None)])
    put(f"{tmp_path}/raw/other.jsonl", [record("u9")])
    return str(tmp_path)


def test_jsonl(spark, lake):
    df = files.read_jsonl(spark, f"{lake}/processed/consolidated-20250101.jsonl").cache()
    assert files.good_lines(df).count() == 2
    assert [x[files.BAD] for x in files.rejected_lines(df).collect()] == ["{broken"]


def test_snapshots(spark, lake):
    latest = files.load_latest(spark, f"{lake}/processed")
    assert sorted(x.company for x in latest.collect()) == ["Acme", "New", "Second"]
    history = {x.job_url: x.company for x in files.load_history(spark, f"{lake}/processed", f"{lake}/raw").collect()}
    assert history == {"u1": "Old", "u2": "Acme", "u3": "Acme", "u4": "Acme"}
    recent = files.load_recent(spark, f"{lake}/raw")
    assert sorted(x.job_url for x in recent.collect()) == ["u2", "u4"]
    os.utime(f"{lake}/raw/batch-1.jsonl", (time.time() - 30 * 86400,) * 2)
    assert files.load_recent(spark, f"{lake}/raw").count() == 0
    assert files.load_latest(spark, f"{lake}/raw").count() == 0


def test_load_source(spark, tmp_path):
    assert files.load_source(spark, "h1b", f"{tmp_path}/none").count() == 0
    path = f"{tmp_path}/a.parquet"
    spark.createDataFrame([("x",)], "title string").write.parquet(path)
    row = files.load_source(spark, "adzuna", path).first()
    assert (row.data_source, row.source_priority) == ("adzuna", 2)
    assert files.load_source(spark, "adzuna", path, {"adzuna": False}).count() == 0
    assert files.load_source(spark, "other", path).count() == 0


def test_disclosure_csv(spark, tmp_path):
    put(f"{tmp_path}/d.csv", ["Case_Number,LCA_CASE_JOB_TITLE,Wage_Rate_Of_Pay_From,WAGE_UNIT_OF_PAY,Extra", "1,Data Scientist,50,Hour,x", "2,Cook,1,Year,y"])
    df = feeds.read_disclosures(spark, f"{tmp_path}/d.csv", 2024)
    assert df.columns == ["case_number", "job_title", "wage_from", "wage_unit", "EXTRA", "fiscal_year"]
    out = collect.disclosure_table({2023: df, 2024: df.drop("wage_unit")})
    assert sorted((x.fiscal_year, x.annual_salary) for x in out.collect()) == [(2023, 104000.0), (2024, 50.0)]


def test_api_payloads(spark):
    posting = {"id": "1", "title": "Lead NLP (remote)", "company": {"display_name": "A"}, "location": {"display_name": "SF", "area": ["US", "California"]},
               "salary_min": 100.0, "created": "2025-01-02T03:04:05Z"}
    df = spark.createDataFrame([(json.dumps(posting),)], "j string").select(F.from_json("j", feeds.POSTING_SCHEMA).alias("p"))
    row = collect.job_board_table(df, "p", F.lit("q"), F.lit("us")).first()
    assert (row.state, row.is_remote, row.seniority, row.salary_avg, row.year, row.salary_predicted, row.description) == ("CA", True, "Senior", 100.0, 2025, False, "")
    hist = spark.createDataFrame([("ml", '{"histogram": {"0": 3, "10000": 4}}')], "q string, j string")
    assert sorted(tuple(x) for x in feeds.explode_histogram(hist, "q", feeds.histogram_from_json(F.col("j"))).collect()) == [("ml", "0", 3), ("ml", "10000", 4)]
    sid = "OEUN0000000000000015205104"
    data = [{"year": "2023", "period": "A01", "value": "1,000"}, {"year": "2024", "period": "A01", "value": "-"}, {"year": "2024", "period": "M01", "value": "5"}]
    body = {"status": "REQUEST_SUCCEEDED", "Results": {"series": [{"seriesID": sid, "data": data}]}}
    wages = spark.createDataFrame([(json.dumps(body),), (json.dumps(body | {"status": "X"}),)], "j string").select(F.from_json("j", feeds.WAGE_SCHEMA).alias("p"))
    out = collect.wage_benchmarks(wages, "p").collect()
    assert [(x.soc_code, x.year, x.mean_annual_wage) for x in out] == [("15-2051", 2023, 1000.0)]


def test_markup(spark):
    card = """<ul><li class='a'><a href="https://x/1?a=1&amp;b=2" class="base-card__full-link"></a>
      <h3 class="base-search-card__title">ML &amp; AI</h3><h4 class="x base-search-card__subtitle"> <a>Acme</a> </h4>
      <time datetime="2025-01-01" class="job-search-card__listdate">1 day</time></li><li>none</li></ul>"""
    df = spark.createDataFrame([(1, card)], "page_id int, html string")
    row = html.extract_job_cards(df).first()
    assert (row.position, row.company, row.salary, row.job_url, row.date, row.company_logo, row.location) == (
        "ML & AI", "Acme", "Not specified", "https://x/1?a=1&b=2", "2025-01-01", "", "")
    assert html.extract_job_cards(df, require_salary=True).count() == 0
    detail = """<div class="salary">$1</div><div class="description__text"><div>PhD <div>and 5+ years</div></div> python</div>
      <li class="description__job-criteria-item"><h3>Industries</h3><span class="description__job-criteria-text"> Tech </span></li>
      <span class="num-applicants__caption">Over 25 applicants</span><br>"""
    out = html.extract_job_details(spark.createDataFrame([(1, detail), (2, None)], "page_id int, html string")).orderBy("page_id").collect()
    assert (out[0].salary, out[0].industries, out[0].applicant_count, out[0].education, out[0].experience_years, out[0].skills) == (
        "$1", "Tech", 25, "PhD", "5+ years", ["python"])
    assert out[0].description == "PhD and 5+ years python"
    assert out[1].salary == "Not specified" and out[1].skills == []
    pages = spark.createDataFrame([("<!DOCTYPE html><p>",), ("case,1",), (" " * 101 + "<html>",)], "t string")
    assert html.reject_html_payloads(pages, "t").count() == 2


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, None)], "data_source string, x int, y string")
    sinks.write_table(df, f"{tmp_path}/t", ("data_source",))
    assert os.path.isdir(f"{tmp_path}/t/data_source=a")
    at = sinks.write_versioned(df, str(tmp_path), "merged", "20250101")
    assert spark.read.parquet(at).count() == spark.read.parquet(f"{tmp_path}/merged_latest.parquet").count() == 1
    sinks.write_jsonl(df, f"{tmp_path}/j")
    assert json.loads(spark.read.text(f"{tmp_path}/j").first()[0]) == {"data_source": "a", "x": 1, "y": None}


def test_stream_first_per_url(spark, tmp_path):
    args = (spark, f"{tmp_path}/landing", f"{tmp_path}/table", f"{tmp_path}/state")
    put(f"{tmp_path}/landing/batch-1.jsonl", [record("u1"), record("u1", company="B"), record("u2", salary=""), "{bad", record("")])
    stream.ingest_new_postings(*args)
    put(f"{tmp_path}/landing/batch-2.jsonl", [record("u2", company="late"), record("u3")])
    stream.ingest_new_postings(*args)
    stream.ingest_new_postings(*args)
    rows = spark.read.parquet(f"{tmp_path}/table").collect()
    assert sorted(x.job_url for x in rows) == ["u1", "u2", "u3"]
    assert {x.job_url: x.company for x in rows}["u2"] == "Acme"


def test_stream_watermark(spark, tmp_path):
    put(f"{tmp_path}/landing/batch-1.jsonl", [record("u1"), record("u1", company="B"), record("u2")])
    df = stream.within_watermark(stream.stream_lines(spark, f"{tmp_path}/landing"))
    q = df.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


def test_postings_and_counters(spark, lake):
    raw = files.load_history(spark, f"{lake}/processed")
    out = collect.postings_table(raw, 30000.0, 1e6).first()
    assert (out.worksite_state, out.annual_salary, out.estimated_yoe, out.year, out.skills) == ("CA", 175000.0, 4, 2025, ["python"])
    lines = files.read_jsonl(spark, f"{lake}/processed").cache()
    row = collect.scrape_counters(lines, files.BAD, "file_name").first()
    assert (row.total_records, row.invalid_records, row.cleaned_records, row.duplicates_removed, row.files_processed) == (6, 1, 3, 2, 2)
    assert collect.scrape_dedup(files.good_lines(lines), [F.col("file_name"), F.col("line_at")]).count() == 3


@pytest.fixture(scope="module")
def merged(spark, tmp_path_factory):
    """Source files written as a run would find them, merged and written."""
    root = str(tmp_path_factory.mktemp("run"))
    from payspark.verification.bridge import source_tables

    for s, df in source_tables(spark, "/root/testdata/sf0.001").items():
        df.write.parquet(f"{root}/{s}/processed/" + {"h1b": "h1b_ai_salaries", "adzuna": "adzuna_jobs", "linkedin": "linkedin_ai_jobs"}[s] + ".parquet")
    return merge.run_merge(spark, root, f"{root}/out"), root


def test_merge_run(spark, merged):
    df, root = merged
    assert df.count() > 1000 and df.where("annual_salary NOT BETWEEN 35000 AND 600000").count() == 0
    assert r.apply_profile(df, "h1b_only").select("data_source").distinct().count() == 1
    pruned = r.apply_profile(df, "h1b_only")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [data_source" in pruned.replace("isnotnull(", "")
    report = json.loads(spark.read.json(f"{root}/out/merge_report").first()["report"])
    assert report["summary_statistics"]["total_records"] == df.count()
    assert sum(report["source_distribution"].values()) == df.count()


def test_explore(spark, merged):
    reports = explore.explore(merged[0])
    assert len(reports) > 25
    for name in ("table_profile", "missing_report", "salary_by_seniority", "skill_count_histogram", "poly_trend", "type_counts"):
        assert reports[name].count() > 0, name


def test_training_and_scoring(spark, merged, tmp_path):
    ids = ["job_title", "employer_name", "worksite_state", "annual_salary", "job_url", "data_source"]
    small = {"maxIter": 3, "maxDepth": 3}
    model, extra = training.train_pipeline(
        merged[0], ids, str(tmp_path / "models"), "20250101", small, lookback_years=3, ref_year=2025, date_col=None)
    assert set(model.metrics) == {"train", "validation", "test"} and model.metrics["test"]["mae"] > 0
    again = m.load_model(spark, str(tmp_path / "models"))
    assert again.features == model.features and again.rmse == pytest.approx(model.rmse)
    requests = spark.createDataFrame([("Senior ML Engineer", "ca", 5, "Google", ["nlp"]), ("Dev", "OH", 3, None, None)],
                                     "job_title string, location string, experience_years int, company string, skills array<string>")
    a, b = (training.score_requests(x, requests).orderBy("job_title").collect() for x in (model, again))
    assert a == b and all(x.salary_low <= x.predicted_salary <= x.salary_high for x in a)
    assert m.importance_table(spark, model).count() == len(model.features)


def test_cross_validation_and_tuning(spark):
    df = spark.range(300).select("id", (F.col("id") % 10).alias("x"), ((F.col("id") % 10) * 1000 + 50000).alias("y"))
    cv = m.cross_validate(df, ["x"], "y", ["id"], 2, {"maxIter": 2, "maxDepth": 2})
    assert len(cv["r2"]["scores"]) == 2 and cv["mae"]["mean"] > 0
    best = m.tune(df, ["x"], "y", ["id"], {"maxDepth": (1, 3), "maxIter": (2,)}, 2)
    assert best["best_params"] == {"maxDepth": 3, "maxIter": 2} and len(best["cv_results"]) == 2


def test_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_job_cards_quotes_entities_and_nested_lists(spark):
    page = """<ul><li class='card'><a class='base-card__full-link' href='https://x/1?a=1&amp;b=2'></a>
      <h3 class='base-search-card__title'>Caf&eacute; &#8211; Analyst</h3><h4 class=base-search-card__subtitle>Acme</h4>
      <ul><li>one</li><li>two</li></ul><span class='job-search-card__location'>Austin, TX</span><br/></li>
      <li><h3 class="base-search-card__title">Open item</h3><h4 class="base-search-card__subtitle">B<li>last</ul>"""
    rows = html.extract_job_cards(spark.createDataFrame([(1, page), (2, None)], "page_id int, html string")).collect()
    assert [(r.position, r.company, r.location, r.job_url) for r in rows] == [
        ("Caf\u00e9 \u2013 Analyst", "Acme", "Austin, TX", "https://x/1?a=1&b=2"), ("Open item", "B", "", "")]


def test_plain_markup_reads_as_the_parser_reads_it():
    """Plain pages take one regex, any other page the parser; both must give the handlers the same."""
    rng = random.Random(11)
    plain = [
        "<li>", "</li>", "<ul>", "</ul>", "<br>", "<br/>", "text", "&amp;", "&copy x", "\n", "é𝒳", "<!-- c -->", "<!---->", "</i>", "</i>",
        '<time datetime="d">', "</time>", "<time datetime>", '<a class="base-card__full-link" href="x&amp;y">', "</a>", '<p class="a  salary">',
        '<img class="artdeco-entity-image" data-delayed-url="u"/>', '<b class="salary" >', "</b >", "Seniority level", "</p>",
        '<li class="description__job-criteria-item">', '<i class="description__job-criteria-text">', '<i class="description__text">',
    ] + [f'<i class="{c}">' for c in rules.CARD_CLASSES.values()]
    odd = ["<", ">", "&am", "<!DOCTYPE html>", "<!-->", "<script>", "</script>", "<DIV>", "<p class=salary>", '<a href="a>b">', "</>", "<b\x0b>", "<?pi?>"]
    for i in range(2000):
        page = "".join(rng.choice(plain if i % 2 else plain + odd) for _ in range(rng.randint(1, 14)))
        assert i % 2 == 0 or html._tokens(page, {}) is not None
        items, text = html._ListItems(), html._ClassText()
        for parser in (items, text):
            parser.feed(page)
            parser.close()
        ours, detail = html._ListItems(), html._ClassText()
        for parser in (ours, detail):
            html._read(parser, page, {})
        assert ours.items == items.items and detail.found == text.found, page


def test_no_whole_record_is_sorted_before_its_url_is_chosen(spark):
    columns = "k int, collectedAt string, position string, company string, location string, date string, jobUrl string, salary string, " \
        "seniorityLevel string, employmentType string, jobFunction string, industries string, applicantCount int, experienceYears string, " \
        "education string, skills array<string>, companyLogo string, description string"
    def row(k, url, name):
        return (k, "t", name, "c", "l", "d", url, None, None, None, None, None, 1, None, None, None, None, "x" * 600)

    df = spark.createDataFrame([row(2, "u", "b"), row(1, "u", "a"), row(1, "u", "a"), row(None, "v", "n"), row(3, "v", "m"), row(7, None, "z"), row(8, None, "y")], columns)
    out = r.project_scrape_record(df, [F.col("k")])
    assert sorted((x.job_url or "", x.position, len(x.description)) for x in out.collect()) == [("", "z", 500), ("u", "a", 500), ("v", "n", 500)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan  # the windows over all rows see the url and the order alone, and end in a written table


def test_a_plain_tag_is_read_once_and_gives_what_the_parser_gives(monkeypatch):
    rng = random.Random(5)
    parts = [
        "<ul>", "</ul>", "<li>", "</li>", "<li/>", "<div>", "</div>", "<br>", "5+ years", "&amp;", " ", "<!-- c -->", '<time datetime="d">', "<time>", "</time>",
        '<a class="base-card__full-link" href="x&amp;y">', '<a class="base-card__full-link">', "</a>", '<img class="artdeco-entity-image" data-delayed-url="u">',
        '<i class="salary"/>', '<i class="description__text salary">', '<b class="num-applicants__caption">', "</b>", '<li class="description__job-criteria-item">',
        "Industries", '<i class="description__job-criteria-text">', "</i>", "<p class=odd>",
    ] + [f'<i class="{c}">' for c in rules.CARD_CLASSES.values()]
    pages = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(500)] + [None, ""]

    def read():
        known, cards = {}, []
        for page in pages:
            parser = html._ListItems()
            html._read(parser, page, known)
            cards.append([html._card(item) for item in parser.items])
        return cards, [html._detail(page or "", known) for page in pages]

    seen, tag = [], html._tag
    monkeypatch.setattr(html, "_tag", lambda raw: seen.append(raw) or tag(raw))
    ours = read()
    plain = [raw for raw in seen if tag(raw) is not None]
    assert len(plain) == len({*plain})  # however often a tag comes, it is taken apart once
    monkeypatch.setattr(html, "_tokens", lambda page, known: [] if not page else None)
    assert ours == read()
